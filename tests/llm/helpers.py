"""Small tables of awkward documents."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "word " * 3000),
    (6, "x" * 5000),
    (7, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (7, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (None, "a row without an id"),
    (8, "Éàü \U0001f600 emoji   spaces\r\n\r\nnew lines\x0b\x0c end"),
]


def docs(spark, rows=None, **extra):
    """A documents table, with further columns of clashing names if asked."""
    rows = AWKWARD if rows is None else rows
    df = spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOCS)
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in extra.items()})
