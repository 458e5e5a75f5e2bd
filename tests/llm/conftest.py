import pytest


@pytest.fixture
def documents(spark):
    """(id, text) rows as a documents table with extra columns of clashing names."""
    from pyspark.sql import types as T

    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                         T.StructField("n_chars", T.LongType()), T.StructField("key", T.StringType()), T.StructField("score", T.StringType()), T.StructField("node", T.StringType()),
                         *(T.StructField(n, T.StringType()) for n in ("size", "copies", "target", "base", "all", "family", "part", "_k0", "_toxicity", "start"))])

    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None, "k", "z", "n", *"abcdefghij") for r in rows], kind)

    return make


#: Rows that every operator has to bear.
ODD = [(1, None), (2, ""), (3, "   \n"), (4, "one"), (5, "one two"), (5, "one two"), (None, "a b c d e f"), (6, "a b c d e f"), (7, "wörd " * 5000), (8, "x" * 60000), (9, "\u0001\u0002 é퟿ 𝄞")]
