"""scrivano: document analytics for collections of published acts, on PySpark."""
