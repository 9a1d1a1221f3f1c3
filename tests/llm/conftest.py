import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
LONG = "word%d other%d thing%d. "


@pytest.fixture(scope="session")
def sf():
    return SF


def docs_frame(spark, rows, extra=()):
    """Documents (doc_id, text, source) with any extra columns of long."""
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("source", T.StringType()), *((c, T.LongType()) for c in extra)]
    return spark.createDataFrame([(*r, *([None] * (3 - len(r))), *([7] * len(extra))) for r in rows], T.StructType([T.StructField(n, t) for n, t in fields]))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, odd characters."""
    long = " ".join(LONG % (i, i * 7, i % 13) for i in range(15000))
    rows = [(1, "A b c."), (2, None), (3, ""), (None, "No id here."), (None, None), (5, "A b c."), (5, "A b c."), (6, long), (7, " \t\n\r "), (8, "ünï   cödé 😀 x y\nline two\n\nline two"), (9, "a\u0000b c")]
    return docs_frame(spark, rows, ("n_lines", "score", "size", "kept", "c1"))
