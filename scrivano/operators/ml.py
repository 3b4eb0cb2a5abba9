"""Training of a text classifier and use of its labels."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IDF, CountVectorizer, IndexToString, NGram, Normalizer, RegexTokenizer, SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivano.operators.incremental import updated

TEXT_COLUMNS = ("text", "text_preview", "oggetto")
REVIEW = "Da_Revisionare_Manualmente"


def text_column(df: DataFrame) -> str:
    """First of the known text columns that the frame has."""
    return next(c for c in TEXT_COLUMNS if c in df.columns)


def split_stratified(df: DataFrame, label: str, key: str, share: float = 0.8) -> DataFrame:
    """Adds `train`: the same share of each label, chosen by a hash of the key, so that it stays the same on every run.

    The hash is compared with the label's own share, not ranked in one task; within a label the share is met closely."""
    bucket = F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(1000))
    return df.withColumn("train", bucket < int(share * 1000))


def oversampled(df: DataFrame, label: str, key: str) -> DataFrame:
    """Rows of each label repeated until it has as many as the largest. Adds `copy`. Ranks are counted in salted groups."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    most = counts.agg(F.max("_n").alias("_most"))
    salt = F.pmod(F.xxhash64(key), F.lit(32))
    sized = df.withColumn("_salt", salt)
    groups = sized.groupBy(label, "_salt").agg(F.count("*").alias("_k"))
    before = Window.partitionBy(label).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.withColumn("_from", F.coalesce(F.sum("_k").over(before), F.lit(0))).drop("_k")
    rank = F.row_number().over(Window.partitionBy(label, "_salt").orderBy(key))
    ranked = sized.withColumn("_own", rank).join(offsets, [label, "_salt"]).join(counts, label).join(most, F.lit(True))
    ranked = ranked.withColumn("_rank", F.col("_own") + F.col("_from"))
    times = F.expr("_most div _n") + F.when(F.col("_rank") <= F.col("_most") % F.col("_n"), 1).otherwise(0)
    return ranked.select(*df.columns, F.explode(F.sequence(F.lit(1), times.cast("int"))).alias("copy"))


def text_forest(text: str, label: str, words: int = 3000, trees: int = 200, seed: int = 42, depth: int = 12) -> Pipeline:
    """TF-IDF over single words and pairs, and a random forest."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="_y", handleInvalid="skip"), RegexTokenizer(inputCol=text, outputCol="_w", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False), NGram(n=2, inputCol="_w", outputCol="_2"),
            SQLTransformer(statement="SELECT *, concat(_w, _2) AS _t FROM __THIS__"), CountVectorizer(inputCol="_t", outputCol="_c", vocabSize=words, minDF=2, maxDF=0.8), IDF(inputCol="_c", outputCol="_i"), Normalizer(inputCol="_i", outputCol="_x"),
            RandomForestClassifier(labelCol="_y", featuresCol="_x", predictionCol="_p", probabilityCol="_prob", numTrees=trees, seed=seed, maxDepth=depth, featureSubsetStrategy="sqrt", maxMemoryInMB=48),
        ]
    )


def fitted_balanced(forest: Pipeline, rows: DataFrame, label: str, key: str) -> PipelineModel:
    """`forest` with its words fitted on `rows` as they are, and its trees on the rows of each label repeated until all labels have as many."""
    words = Pipeline(stages=forest.getStages()[:-1]).fit(rows)
    balanced = oversampled(words.transform(rows).select(key, label, "_y", "_x"), label, key)
    return PipelineModel([*words.stages, forest.getStages()[-1].fit(balanced)])


def predicted(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Label and its probability for each row, seen labels or not."""
    labels = model.stages[0].labels
    for stage in model.stages[1:]:
        df = stage.transform(df)
    out = IndexToString(inputCol="_p", outputCol="predicted", labels=labels).transform(df)
    return out.select(*keep, "predicted", F.array_max(vector_to_array("_prob")).alias("predicted_confidence"))


def relabelled(label: str | Column, confidence: str | Column, least: float = 0.5) -> Column:
    """The predicted label where it is sure enough, else the mark for review."""
    c = F.col(confidence) if isinstance(confidence, str) else confidence
    return F.when(c >= least, F.col(label) if isinstance(label, str) else label).otherwise(REVIEW)


def class_report(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Precision, recall, F1 and support of each label; 0 where nothing can be divided."""
    pairs = df.filter(F.col(truth).isNotNull() & F.col(guess).isNotNull()).groupBy(truth, guess).agg(F.count("*").alias("n"))
    one = pairs.select(F.col(truth).alias("label"), F.when(F.col(truth) == F.col(guess), F.col("n")).otherwise(0).alias("tp"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("named"))
    two = pairs.select(F.col(guess).alias("label"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("named"))
    s = one.unionByName(two).groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("named").alias("named"))
    div = lambda a, b: F.when(b == 0, 0.0).otherwise(F.round(a / b, 6))
    return s.select("label", div(F.col("tp"), F.col("named")).alias("precision"), div(F.col("tp"), F.col("support")).alias("recall"), div(2 * F.col("tp"), F.col("named") + F.col("support")).alias("f1"), F.col("support").cast("bigint").alias("support"))


def written_back(df: DataFrame, predicted: DataFrame, key: str, order: str, label: str = "category", confidence: str = "classification_confidence", least: float = 0.5) -> DataFrame:
    """`df` with the sure predictions (`key`, `order`, `label`, sure) put in and marked `high_ml`; of several for a key the last in `order` counts."""
    sure = predicted.filter((F.col("sure") >= least) & F.col(label).isNotNull() & F.col(key).isNotNull())
    return updated(df, sure.select(key, order, label, F.lit("high_ml").alias(confidence)), key, order, [label, confidence])
