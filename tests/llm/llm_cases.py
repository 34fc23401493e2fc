import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that the operators use inside or for their results.
CLASHES = ["id", "hash", "node", "shard", "bucket", "slot", "piece", "n", "order", "cell", "place", "halo", "score", "kinds", "rows", "row", "n_words", "bands"]


def docs_of(spark, texts, ids=None, clash=False):
    ids = list(range(len(texts))) if ids is None else ids
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)], DOCS)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in CLASHES})
    return df


LONG = "word and another word follow here " * 4000
#: Nulls, empties, no letters, copies, wide characters, a very long text.
EDGES = [None, "", " \n\t", "12345", "a", "a", "It is a text of some words.", "It is a text of some words.", "ÄÖÜ straße 東京 \U0001f600 ñ", LONG, "x\x00y", None]


@pytest.fixture(scope="session")
def edges(spark):
    """Ids with a null and a repeat; extra columns with clashing names."""
    return docs_of(spark, EDGES, [0, 1, 2, 3, 4, 5, 6, 6, 8, 9, None, 11], clash=True)


@pytest.fixture(scope="session")
def no_docs(spark):
    return docs_of(spark, [], clash=True)
