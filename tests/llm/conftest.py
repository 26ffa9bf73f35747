import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("key", T.StringType()), T.StructField("tokens", T.IntegerType())])


@pytest.fixture
def docs(spark):
    """Build documents of (id, text[, lang]) with extra columns of clashing names."""
    def build(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 0, "k", 1) for r in rows], DOCS)

    return build


LONG = " ".join(f"w{i}" for i in range(30_000))
EDGE_ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG), (5, LONG), (None, "a b c d e f"), (7, "short"), (8, "a b c d e f"), (9, None, None)]
