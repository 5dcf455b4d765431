import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("score", T.StringType()),  # names that operators use themselves
        T.StructField("features", T.StringType()),
        T.StructField("node", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table with extra, clashing columns from (doc_id, text) pairs."""

    def make(rows):
        full = [(i, t, None, "s", None if t is None else len(t), "x", None, "n") for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def words():
    def make(seed, n, size=400):
        import random

        r = random.Random(seed)
        syllables = "an er in the on th re ha ti es ou ng ly st nd wh".split()
        vocabulary = ["".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(size)]
        return " ".join(r.choice(vocabulary) for _ in range(n))

    return make
