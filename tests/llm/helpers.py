"""Small fixtures for the llm operator tests."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def docs(spark, texts, first=0, ids=None, lang="en", source="src0"):
    rows = [(ids[i] if ids else first + i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def with_extra(df):
    """Columns whose names clash with what operators use inside."""
    from pyspark.sql import functions as F
    out = df
    for name in ("id", "shard", "size", "row", "_part", "_w", "start", "key", "digest", "score", "words", "pos"):
        out = out.withColumn(name, F.lit("clash"))
    return out
