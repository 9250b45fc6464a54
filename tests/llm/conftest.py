import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def documents(spark):
    """DataFrame of documents from (doc_id, text) pairs."""

    def make(pairs, lang="en"):
        return spark.createDataFrame([(i, t, lang, "s", len(t) if t is not None else None) for i, t in pairs], SCHEMA)

    return make


@pytest.fixture
def clashing():
    """Adds columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    def add(df):
        names = ("key", "words", "matches", "runs", "spans", "n_lines", "id", "digest", "component", "label", "h", "n", "rank", "piece",
                 "length", "start", "score", "pos", "term", "item", "w", "a", "b", "u", "kept", "n_words")
        return df.select("*", *(F.lit(f"mine {n}").alias(n) for n in names))

    return add


WORDS = "alpha bravo carbon delta echo forest garden hotel island jungle kilo lemon mango north ocean pepper quartz river stone tiger".split()


@pytest.fixture
def prose():
    """Deterministic invented text of ``n`` words."""
    import random

    def make(seed, n):
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) + r.choice(["", "s", "ed", "er", "ly", str(r.randrange(90))]) for _ in range(n))

    return make
