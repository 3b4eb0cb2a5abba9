"""The small labelled table of `personal`: sentences with marked items, and the values that are put into the marks.

`{nome}` `{telefono}` `{email}` `{identita}` `{indirizzo}` are items; `{strada}` is a street without a number, `{ditta}` a
firm, `{luogo}` a place, `{ufficio}` an office, `{parola}` a common word, `{data}` `{numero}` `{importo}` `{codice}` `{rione}` are no items. About half
of the given names are made by rule and stand in no list, so that context and shape are learned, not the list.
"""

from __future__ import annotations

import random

from scrivano.llm.name_variants import GIVEN, SHORT

SENTENCES = """
Con istanza del {data} {nome}, abitante in {indirizzo}, domanda l'esonero dal pagamento.
Il richiedente sig. {nome}, domiciliato in {indirizzo}, allega la ricevuta.
Compare il sig. {nome}, residente in {indirizzo}, che firma per accettazione.
Compare la sig.ra {nome}, nata a {luogo} il {data} e residente in {indirizzo}, che rinuncia.
Esaminata la richiesta di {nome} (C.F. {identita}) registrata con n. {numero};
Letta la nota di {nome}, codice fiscale {identita}, arrivata il {data};
Si assegna a {nome}, codice fiscale {identita}, la somma di € {importo}.
Beneficia del sussidio {nome} (C.F. {identita}) per un totale di € {importo}.
La quota spetta a {nome}, nato il {data}.
Direttore operativo: geom. {nome} - cell. {telefono}.
Progettista incaricato: ing. {nome} - tel. {telefono}.
Chi ha bisogno di aiuto può rivolgersi a {nome}, tel. {telefono} oppure {email}.
Chi ha bisogno di aiuto chiami {nome}, tel. {telefono}, o scriva a {email}.
Lo sportello risponde a {email} e al {telefono} nei giorni feriali.
I curriculum si mandano a {email} non oltre il {data}.
Le offerte arrivano a {email} prima del {data}, altrimenti sono nulle.
Scrivere all'indirizzo {email} o telefonare al {telefono}.
Proponente {nome}, cellulare {telefono}, indirizzo elettronico {email}, abitazione {indirizzo}.
Proponente {nome}, recapito {telefono}, posta {email}, domicilio {indirizzo}.
ORDINA Proponente {nome}, recapito {telefono}, posta {email}, domicilio {indirizzo}.
Il messo consegni il plico a {nome} presso {indirizzo}.
Copia del verbale va a {nome} presso {indirizzo}. Restano salvi i diritti dei terzi.
AVVISA Copia del verbale va a {nome} presso {indirizzo}.
Il fabbricato di {indirizzo} appartiene a {nome} e agli eredi.
Il terreno di {indirizzo} è intestato per un terzo a {nome} per successione.
Il {data} la sig.ra {nome} ha lamentato buche in {strada}.
Nella lettera della sig.ra {nome} sullo sfalcio di {strada} mancano le firme.
Nella lettera del sig. {nome} sullo sfalcio mancano le firme.
La dott.ssa {nome} cura l'istruttoria della pratica.
La dott.ssa {nome} è {parola} {parola} della {parola}.
{Parola} la dott.ssa {nome} e il dott. {nome}.
La prof.ssa {nome} {parola} il {parola}.
{parola} dott.ssa {nome}
dott.ssa {nome}
{Parola} al numero {telefono} l'{parola} del {parola} di {parola}.
{Parola} il numero {telefono} per {parola}.
Iscrizione al notiziario di {luogo} per {parola} gli {parola}
{PAROLA} {Parola} al {parola} di {luogo} per {parola} i {parola}
{PAROLA} {Parola} {parola}: CIG {codice} e CUP {codice}.
Al dott. {nome} spetta la direzione dell'ufficio {ufficio}.
Il dott. {nome} è incaricato della vigilanza.
Firmato da {nome} al termine della verifica a {luogo}.
Redatto da {nome} a chiusura dei controlli.
Idonei: {nome}, {nome}, {nome}; non idoneo {nome} per assenza alla prova.
Vincitori: {nome}, {nome}; riserve {nome}, {nome} secondo l'ordine di arrivo.
Sono presenti {nome} e {nome}; assente {nome}.
Al numero {telefono} si trova il custode della palestra di {luogo}.
Componendo il {telefono} si parla con l'operatore.
Passaporto n. {identita} emesso il {data} a {nome}.
Titolare del documento n. {identita} rilasciato il {data} a {nome}.
Si è fatto riconoscere con carta n. {identita} a nome di {nome}.
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{nome}
{ditta}
{ditta}
{ditta}
{ditta}
{ditta}
{ditta}
{ditta}
{ditta}
{nome}, {indirizzo}
{nome}, {indirizzo}
{nome} {email}
{nome} - {email}
{nome} tel. {telefono}
{nome} tel. {telefono}
{nome} tel {telefono}
Sig. {nome}
DOTT. {nome}
avv. {nome}
ing. {nome}
arch. {nome}
geom. {nome}
rag. {nome}
{nome} tel. {telefono}
{nome} {telefono}
{nome} ({email})
{nome} - C.F. {identita}
{nome} - C.F. {identita}
{nome}, {indirizzo}
{nome}, {indirizzo}
{nome}, {indirizzo}
{nome} - {indirizzo}
{nome} {indirizzo} c.f. {identita}
{nome} {indirizzo} c.f. {identita}
{nome} cod.fisc.:{identita} {telefono}
{nome} cod.fisc.:{identita} {telefono}
{ditta}
{ditta}
{ditta}
{ditta}
{ditta}
{ditta}
{ditta}
Ditta {ditta}
{ditta} - {indirizzo}
{ditta} - {indirizzo}
{ditta} {email}
{ditta} tel {telefono}
{ditta} tel. {telefono}
DIVERSI
creditori diversi
La registrazione n. {numero} del {data} si conserva in archivio.
Protocollo di {luogo} n. {numero}
Registro automatico del Comune di {luogo} {numero}
Alla gara corrisponde il CIG {codice}, al progetto il CUP {codice}.
Con lettera n. {numero} del {data} la Regione chiede integrazioni.
L'onere di € {importo} grava sul capitolo 2.04.11 del bilancio 2025.
Si paga l'importo di € {importo} della fattura n. {numero} del {data} alla ditta {ditta}.
La fornitura è affidata a {ditta} per € {importo}.
Non si può parcheggiare in {strada} dalle ore 8 alle ore 18 del {data}.
Gli scavi in {strada} dureranno 20 giorni, salvo maltempo.
Il traffico del {rione} passa per {strada}, come da ordinanza n. {numero}.
Il mercato si sposta dal {rione} in località {luogo} fino al {data}.
Durante la riunione del {data} si è letto il resoconto.
Chi abita a {luogo} entra con il permesso n. 31.
L'ufficio {ufficio} provvede entro il {data}.
Il concorso riguarda n. 4 posti presso {ufficio}, con colloquio il {data}.
La direzione {ufficio} ha istruito la pratica con relazione del {data}.
Il cantiere della scuola di {luogo} è aperto in via provvisoria.
Oggetto: Liquidazione di spesa per la scuola di {luogo} presso {strada}
Comune di {luogo} - Delibera n. 44: Restauro della fontana di {strada}
COMUNE DI {LUOGO} - RESTAURO DELLA FONTANA DI {LUOGO}
VistoContabile n. 98 del {data}. Oggetto: Lavori di {luogo} nel {rione}
Tutti i contenuti appartengono al Comune di {luogo} 2023
Pagina letta 87 volte dal giorno della pubblicazione
Fascicolo del settore {ufficio} per gli uffici di {strada}.
Hanno scritto 14 famiglie del {rione}, alle quali si è data risposta.
L'obbligazione n. 77 pesa sull'esercizio 2025 per € {importo}.
Torna alla pagina iniziale - Cerca nel sito - Contatti
Notiziario di {luogo}: Segui i nostri avvisi
Il gestore del servizio ha inviato il programma dei lavori a {luogo}.
Per urgenza la Regione ha mandato il piano delle strade.
La mozione passa a maggioranza - argomento rinviato alla prossima seduta.
Udito il parere; Ciò premesso, si rimanda alla perizia.
Chi possiede fondi agricoli deve tagliare le siepi entro 30 giorni.
Di conseguenza la segreteria {ufficio} inoltra copia degli atti.
La relazione idro-geologica è della Regione, quella tecnico-contabile del Comune.
TUTTI I CONTENUTI APPARTENGONO AL COMUNE DI {LUOGO} 2023
SCARICA | CONDIVIDI | SCRIVI ALLA REDAZIONE
SECONDO LA LEGGE GLI ATTI SONO LIBERAMENTE CONSULTABILI
Debito verso il gestore della piscina e della mensa nel {rione}.
Il Consorzio irriguo e l'Agenzia del territorio hanno firmato l'intesa n. 12.
{Parola} {nome}, {parola} {telefono}, {parola} elettronica {email}, {parola} {indirizzo}.
{Parola} {nome}, {parola} {telefono}, {parola} elettronica {email}, {parola} {indirizzo}.
{PAROLA} {Parola} {nome}, {parola} {telefono}, {parola} elettronica {email}, {parola} {indirizzo}.
{PAROLA} {Parola} {parola} a {nome} presso {indirizzo}.
{PAROLA} La {parola} della sig.ra {nome} è {parola}.
{PAROLA} Il {parola} di {indirizzo} è in capo a {nome} per intero.
{Parola} {parola}: {nome}, {nome}, {nome}, {nome}.
{Parola}: {nome}, {nome}; {parola} {nome}, {nome} per {parola} dei {parola}.
{Parola} dei {parola}: ing. {nome} - tel. {telefono}.
{Parola} del {parola}: geom. {nome} - cell. {telefono}.
{Parola} {parola} {nome} (C.F. {identita}) {parola};
{Parola} la {parola} di {nome}, codice fiscale {identita}, {parola} il {data};
Il {parola} è {parola} a {nome} (C.F. {identita}) per € {importo}.
Il {parola} è {parola} a {nome}, codice fiscale {identita}, con {parola} di € {importo}.
Così {parola} e {parola} da {nome} a {parola} delle {parola}.
{Parola} con {parola} n. {identita} {parola} il {data} a {nome}.
{Parola} al numero {telefono} il {parola} del {parola}.
Per {parola} {parola} a {nome}, tel. {telefono} oppure {email}.
Per {parola} scrivere a {email} o chiamare il {telefono}.
Il sig. {nome}, residente in {indirizzo}, ha {parola} per {parola} {parola}.
La {parola} dell'{parola} di {indirizzo} risulta in {parola} a {nome} per la {parola}.
{Parola} {parola} per {parola} nel {rione}
{Parola} {parola} di {parola} {parola}, {parola} {luogo}
{Parola} {parola}, la {parola} del {parola} di {luogo} è {parola}.
{Parola} {parola} di {parola} in {strada} e {parola} dal {data}.
{PAROLA} La {parola} {parola} dei {parola} presso {ufficio}.
{PAROLA} {Parola} {parola} dell'ufficio {ufficio}.
{PAROLA} {PAROLA} {PAROLA} {PAROLA}
{PAROLA} {PAROLA}, {PAROLA} DI {LUOGO}
LA {PAROLA} È {PAROLA} E {PAROLA}
{PAROLA} A FINI DI {PAROLA} {PAROLA}; {PAROLA} L'{PAROLA} AGLI {PAROLA}
{PAROLA} {PAROLA} DEL {PAROLA} {PAROLA} A OGNI {PAROLA}, {PAROLA} E {PAROLA}
Il {parola} {nome} ha {parola} la {parola}.
La {parola} {nome} ha {parola} il {parola}.
{Parola} {parola} {nome} al {parola} con {nome}.
I {parola} sono {nome}, {nome}, {nome} e {nome}.
{Parola} {parola} a {nome}, nata il {data}.
Nella {parola} di {nome}, codice fiscale {identita}, manca la {parola}.
Il {parola} per la {parola} è {nome} (C.F. {identita}).
{Parola} {parola} che {nome} {parola} in {indirizzo};
Di {parola} si occupa {nome}, tel. {telefono}.
{parola} {nome} {parola}
{parola} {nome}, {parola}
{parola}, {nome} {parola}
Il {parola} è {parola} da {nome} e {parola}.
Si {parola} {nome} per il {parola}.
{Parola} si {parola} con {nome}.
{Parola} in {parola}: {nome}
{Parola} {nome} e {nome} per {parola}.
{Parola} {nome} e {nome}.
{parola}, agli {parola}, {parola} in € {importo} a {parola}.
{parola}, salvo {parola} {parola}; {Parola} {parola}, il {parola} è {parola}.
Dalle ore 9 i {parola} in {strada}. La {parola} del {parola} è {parola}.
{Parola} dei {parola} in {strada}. {Parola} il {parola} {parola}.
{Parola} in {strada} e {strada}, {parola} da {strada}.
{Parola} {parola} in {indirizzo}. {Parola} il {parola}.
{parola} a {nome} presso {indirizzo}.
{parola} {indirizzo} {parola} in {parola} a {nome}.
{PAROLA} {Parola} all'{parola} degli {parola} in {parola}
{Parola} {nome} e {nome} in qualità di {parola}.
{Parola} {nome} con {nome}, {nome} e {nome} per la {parola}.
Alla {parola} {parola} {nome}, {nome} ed {nome}.
La {parola} viene {parola} dal sig. {nome} e dalla sig.ra {nome}.
Il sig. {nome} {parola} la {parola} del {parola}.
{parola} sentita {nome}, tel. {telefono}.
Per {parola} {parola} {nome}, cell. {telefono}.
{parola} a {luogo} e in località {luogo}, presso {ufficio}
Il {parola} di {luogo} {parola} da {luogo} a {luogo}.
{Parola} per {parola} dell'ufficio {ufficio} di {luogo}.
DETERMINA {Parola} {parola} la {parola}.
DETERMINA Inoltre, i {parola} sono {parola}.
DELIBERA {Parola} al {parola} per {parola} gli {parola}
DELIBERA Infine la {parola} {parola} il {parola}.
DECRETA {Parola}, gli {parola} {parola}.
AVVISA {Parola} {parola}, con {parola} n. {numero} del {data}
ORDINA {Parola} {parola} della {parola}.
RENDE NOTO {Parola} {parola} il {parola}.
RENDE NOTO
{Parola} {parola}: {Parola} {parola} per {parola} {parola}
{luogo} Inoltre, il {parola} della {parola} è {parola}.
{PAROLA} Inoltre, la {parola} dei {parola} è {parola}.
{PAROLA} Infine il {parola} di {luogo} {parola} la {parola}.
{PAROLA} Pertanto, i {parola} della {parola} sono {parola}.
{PAROLA} Ogni {parola} si {parola} a cura della {parola}.
{Parola} {nome}, {parola} {telefono}, {parola} {email}.
{parola} di {luogo} {Parola} {nome}, {parola} {telefono}, {parola} {email}.
{Parola}: {nome}, {nome}, {nome}, {nome}; {parola} {nome} per {parola}.
{Parola}: {nome}, {nome}, {nome}; {parola} {nome}, {nome}.
{Parola} {numero}/2024 - {ufficio}, sede di {luogo}
{parola} presso {ufficio}, sede di {luogo}
{parola} di {luogo}, per {parola} la {parola} {parola}.
{Parola} {Parola} - {Parola} {parola} - {Parola}
{Parola} {parola} presso {ufficio}, con {parola} il {data}.
Comune di {luogo} - {Parola} n. {numero}: {Parola} {parola} di {luogo}
{Parola}Pubblica {numero}/2025 - {Parola} di {parola}, zona {luogo}
La {parola} {ufficio} ha {parola} il {parola}. {Parola} {parola}, il {parola} è {parola}.
La circolazione nel {rione} è {parola} su {strada} per 35 {parola}.
Il {parola} di {luogo} e la {Parola} hanno {parola}. Sono {parola} i {parola} di {parola} {luogo}.
{Parola} {ufficio} - {luogo}
{Parola} di {Parola} del Comune di {luogo} - p. 1
"""

ENDS = "etti oni ardi ucci elli asco erio olla enti ara isi igno occa uri aldi este anzo umbo idro osca".split()
STARTS = "Bar Cor Dal Fer Gar Lom Mar Nar Per Ros San Tor Val Ver Zan Cal Bel Pol Tre Sca Bru Fra Gri Sto".split()
FIRM = "Tornex Balmor Girolma Ventibia Caldesis Surotex Fandimor Belgaro".split()
TRADE = "Costruzioni|Impianti|Servizi Ambientali|Forniture Scolastiche|Vivai|Manutenzioni Stradali|Informatica|Legnami|Energia|Pulizie Industriali|Scavi|Carpenteria|Noleggi".split("|")
LAW = "SPA|SRL|COOP|SAS|S.r.l.|S.p.A.|SNC|Soc. Coop.|s.a.s.|Società per Azioni|srl|Srl unipersonale|Società Cooperativa".split("|")
BODIES = "Consorzio Rifiuti Valverde|Banca di Credito Roccabruna|Croce Soccorso Pianalta|Gas Metano Collina Verde|Istituto Comprensivo Mulino Nord|Unione dei Borghi|Poste Montane|Pro Loco Roccabruna|Azienda Speciale Trasporti Valverde|N.D.".split("|")
KINDS = "via|Via|VIA|viale|piazza|P.zza|largo|corso|V.le|vicolo|contrada|C.so".split("|")
STREETS = "della Posta Vecchia|della Rocca|del Lago Grande|dei Mulini|della Fonte|delle Acacie|degli Aceri|del Borgo Alto|dell'Orologio|Garibasco|Dormelli|della Pieve Nuova|dei Cedri".split("|")
PLACES = "Roccabruna|Pian del Lago|Sant'Alberto|Colle Verde|Valverde|Borgo dei Pini".split("|")
# Places that count as known where the table is marked, some of them two words that could be a name.
KNOWN = PLACES + [f"{a}{b} {c}{d}" for a, b, c, d in zip("Mar Sel Bru Tor Gal Nor Ver Fos Lun Pra Cam Ros".split(), "ana ivo eta oro ine ula".split() * 2, "No Be Ri Sa Lo Ve".split() * 2, "va lla no rda nte ssa va la ra no sta mo".split())]
QUARTERS = "rione Piano di Sotto|rione La Torre|rione Fontana Vecchia|rione Orto Grande".split("|")
OFFICES = "Vigilanza Urbana|Opere Pubbliche|Area Finanziaria|Servizi Sociali|Tributi|Settore Edilizia|Anagrafe|Patrimonio e Demanio|Istruzione|Settore Urbanistico".split("|")
HEADS = "Area Settore Servizio Ufficio Polizia Gestione Sportello Centro".split()
STEMS = "form cost regol stim contr prest cert vers assist conven deliber lavor istr assegn tratt sped cond port coll serv dispon sosten ammin proced richied propon rilev".split()
FINALS = "azione amento ale ivo ico atura anza enza aggio ista abile ato ata ati ente enti ario izia oria ure ezza".split()
SPOTS = "Borgo Colle Casale Rupe Ponte Torre Castel Monte San Santa Rocca Villa Pian Piano Poggio Pieve Vico Campo Valle Val Fonte Porto Costa Bosco Serra".split()
TURNS = "Alto|Vecchio|Nuova|Bassa|di Sopra|di Mezzo|Grande|Piccolo".split("|")
GIVEN_PARTS = ("Gia Pa Ma Clau Ric Si Mo Ste Ti Ger Fa Ne Lo Al Ro Da".split(), "co tri ssi ber car ni fa zi ra bri lle nie du".split(), "mo zia na to dio do lla nia ldo zio no rto sa ne".split())
MONTHS = "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre".split()


def values(r: random.Random) -> dict[str, str]:
    n = lambda a, b: str(r.randint(a, b))
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    up = lambda k: "".join(r.choice("BCDFGLMNPRSTVZ") for _ in range(k))
    made = lambda: "".join(r.choice(x) for x in GIVEN_PARTS)
    first = lambda: made() if r.random() < 0.45 else r.choice(DOUBLE) if r.random() < 0.25 else r.choice(SHORTS if r.random() < 0.1 else NAMES).title()
    sounds = lambda k: "".join(r.choice("b c d f g l m n p r s t v z br cr dr gr pr tr st sc sp".split()) + r.choice(["a", "e", "i", "o", "u", "an", "er", "il", "os"]) for _ in range(k))
    last = lambda: r.choice(STARTS) + r.choice("aeiou") + r.choice("lmnrst") + r.choice("aeiou") + r.choice(ENDS) if r.random() < 0.4 else (sounds(r.randint(2, 4)) + r.choice("aeio")).title()
    brand = lambda: r.choice(FIRM) if r.random() < 0.3 else (sounds(r.randint(1, 3)) + r.choice("x r s n m co ia is dia or um".split())).title()

    def name() -> str:
        a, b, k = first(), last(), r.random()
        if k < 0.12:
            a = a[0] + "."
        elif k < 0.2:
            a += " " + r.choice("ABCDEFGLMPRST") + "."
        k = r.random()
        out = f"{a} {b}" if k < 0.42 else f"{b} {a}" if k < 0.75 else f"{b.upper()} {a}" if k < 0.88 else f"{b}, {a}" if k < 0.94 else f"{a} {b.upper()}"
        k = r.random()
        return out.upper() if k < 0.2 else out.lower() if k < 0.3 else out

    phone = r.choice([f"3{d(2)}{s}{d(7)}" for s in ("", "", "", " ", "-", "/")] + [f"3{d(2)}.{d(3)}.{d(4)}", f"3{d(2)} {d(2)} {d(2)} {d(3)}", f"+39 3{d(2)} {d(3)} {d(4)}", f"00393{d(9)}", f"00393{d(9)}", f"00393{d(9)}", f"0{d(3)} {d(6)}", f"0{d(3)}/{d(6)}", f"(0{d(3)}) {d(6)}", f"+39 0{d(3)}.{d(6)}"])
    code = f"{up(6)}{d(2)}{r.choice('ABCDEHLMPRST')}{d(2)}{r.choice('AFLYZ')}{d(3)}{r.choice('ABCDEFGXYZ')}"
    ident = r.choice([code, code, code.lower(), f"{code[:3]} {code[3:6]} {code[6:11]} {code[11:]}", f"C{r.choice('ABCDEF')}{d(5)}{up(2)}", f"A{r.choice('XYVS')}{d(5)}{up(2)}", f"Y{r.choice('ABC')}{d(7)}"])
    a, b = r.choice(NAMES), last().lower()
    host = r.choice([f"studio.{b}.example", "posta.example", "mail-valverde.example", "pec.valverde.example", "cittadini.example"])
    local = r.choice([f"{a}.{b}", f"{a[0]}.{b}", f"{a}_{b}{n(1, 99)}", f"{b}-{a}", f"{b}{a[0]}", f"{a}{n(1, 2000)}", "info", "protocollo"])
    at = r.choices(["@", " @ ", "[chiocciola]", "(at)"], [16, 2, 1, 1])[0]
    mail = local + at + host
    k = r.random()
    street = f"{r.choice(KINDS)} {r.choice(STREETS) if k < 0.4 else last() if k < 0.7 else r.choice(['del ', 'della ', 'dei ']) + sounds(2).title() + ' ' + sounds(2).title()}"
    number = r.choice([f" {n(1, 150)}", f", {n(1, 150)}", f" n. {n(1, 150)}", f", n. {n(1, 150)}", f" n.{n(1, 150)} int. {n(1, 9)}", f" {n(1, 99)}/{r.choice('ABC')}", f", {n(1, 99)}/{r.choice('ABC')}", f" {n(1, 150)} bis", f", {n(1, 150)} bis"])
    place = r.choice(["", "", f", 00{d(3)} {r.choice(PLACES)}", f" - 00{d(3)} {r.choice(PLACES)}"])
    address = (street.upper() if r.random() < 0.12 else street) + number + place
    firm = r.choice(BODIES) if r.random() < 0.35 else f"{brand()} {r.choice(TRADE)} {r.choice(LAW)}" if r.random() < 0.6 else r.choice([f"{r.choice(TRADE)} {brand()}", f"{brand()} {r.choice(TRADE)}", f"{brand()} {r.choice(LAW)}", brand()])
    firm = firm.upper() if r.random() < 0.3 else firm.lower() if r.random() < 0.08 else firm
    date = r.choice([f"{n(10, 28)}/{n(10, 12)}/20{n(20, 26)}", f"0{n(1, 9)}.0{n(1, 9)}.20{n(20, 26)}", f"{n(1, 28)} {r.choice(MONTHS)} 20{n(20, 26)}"])
    spot = r.choice(KNOWN) if r.random() < 0.35 else r.choice([f"{r.choice(SPOTS)} {last()}", last(), f"{r.choice(SPOTS)} {r.choice(TURNS)}", f"{last()} {r.choice(TURNS[:4])}"])
    lane = r.choice(["del ", "della ", "dei ", "degli ", "delle ", ""]) + r.choice([last(), f"{sounds(2).title()} {sounds(2).title()}", f"{made()} {sounds(2).title()}", f"{last()} {r.choice(TURNS)}"])
    word = r.choice(STEMS) + r.choice(FINALS)
    office = r.choice(OFFICES) if r.random() < 0.4 else f"{r.choice(HEADS)} {(r.choice(STEMS) + r.choice(FINALS)).title()}"
    return {
        "nome": name(), "telefono": phone, "email": mail.upper() if r.random() < 0.1 else mail, "identita": ident, "indirizzo": address, "strada": f"{r.choice(KINDS[:8])} {r.choice(STREETS) if r.random() < 0.4 else lane}", "ditta": firm, "data": date,
        "numero": r.choice([d(7), n(1, 1400)]), "importo": f"{n(1, 300)}.{d(3)},{d(2)}", "codice": "".join(r.choice("ABCDEFGHJKLMNPRSTUVXYZ0123456789") for _ in range(r.choice([10, 15]))), "rione": r.choice(QUARTERS), "luogo": spot, "LUOGO": spot.upper(), "ufficio": office, "parola": word, "Parola": word.title(), "PAROLA": word.upper(),
    }


DOUBLE = ["Maria Grazia", "Anna Rita", "Pier Paolo", "Gian Luca"]
NAMES, SHORTS = sorted(GIVEN - {"gian", "pier", "grazia"}), sorted(SHORT)
ITEMS = ("email", "telefono", "identita", "indirizzo", "nome")


def table(copies: int = 7, seed: int = 3) -> list[list[tuple[str, str]]]:
    """Labelled sentences: (text, kind or '') pieces. Each sentence stands `copies` times with other values."""
    r, out = random.Random(seed), []
    for line in SENTENCES.strip().split("\n"):
        for _ in range(copies):
            pieces, rest = [], line
            while "{" in rest:
                head, _, rest = rest.partition("{")
                kind, _, rest = rest.partition("}")
                pieces += [(head, ""), (values(r)[kind], kind if kind in ITEMS else "")]
            out.append([p for p in [*pieces, (rest, "")] if p[0]])
    return out
