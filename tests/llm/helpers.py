"""Small tables with the awkward rows every operator must take."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # Names that operators might use inside.
        T.StructField("id", T.StringType()),
        T.StructField("hash", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)


def docs(spark, texts, first_id=0):
    """Rows from texts, or from (id, text) pairs."""
    pairs = [t if isinstance(t, tuple) else (first_id + i, t) for i, t in enumerate(texts)]
    rows = [(i, t, "en", "s", "x", None, "y", 1) for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA)


LONG = "lorem ipsum dolor sit amet " * 20_000
AWKWARD = [
    None,
    "",
    " ",
    "One",
    "été \U0001f600 naïve",
    (100, "tie"),
    (100, "tie"),
    (101, "tie"),
    (None, "no id"),
    (102, LONG),
]
