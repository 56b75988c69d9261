import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # names that helper columns of the operators could have
                     T.StructField("key", T.StringType()), T.StructField("score", T.StringType()), T.StructField("row_", T.StringType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        """rows: (doc_id, text[, lang[, source]])"""
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(i, t, la, s, len(t or ""), "k", "s", "r") for i, t, la, s in full], DOCS)
    return make


def sentence(rng, n):
    return " ".join("".join(rng.choice(list("abcdeé")) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def messy():
    """Odd rows that every operator must take: null, empty, blank, copies, a long text."""
    import random
    rng = random.Random(7)
    base = [sentence(rng, 120) for _ in range(6)]
    near = base[0].split()
    near[60] = "zzz"
    rows = [(1, base[0], "en", "b"), (2, base[0], "en", "a"), (3, " ".join(near), "de", None), (4, None, None, None), (5, "", "en", ""),
            (6, " \t\n", None, "a"), (None, base[1], "en", "a"), (7, base[2] + " " + base[3], "fr", "é"), (8, base[4] + " " + base[3], "fr", "b"),
            (9, "one", "de", "b"), (9, "one", "de", "b"), (10, sentence(rng, 6000), "en", "a"), (11, "A b  c d", "en", "a"), (12, "123 456 !", None, "a")]
    return rows
