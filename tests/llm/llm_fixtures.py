import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField(n, t) for n, t in (("doc_id", LongType()), ("text", StringType()), ("lang", StringType()), ("source", StringType()), ("n_chars", LongType()))])


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents from (id, text, lang, source), with columns whose names clash with those the operators add."""

    def make(rows, clash=True):
        df = spark.createDataFrame([(i, t, la, s, len(t or "")) for i, t, la, s in rows], DOCS)
        if clash:
            for name in ("size", "held_out", "row", "host", "bits", "_at", "_key", "taken", "position"):
                df = df.selectExpr("*", f"doc_id AS `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """NULLs everywhere, empty and blank texts, a very long one, repeated rows and equal texts."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog near the river bank today", "en", None),
        (2, "the quick brown fox jumps over the lazy dog near the river bank today", "en", None),
        (3, None, None, None),
        (None, "le chat noir dort sur la table de la cuisine", "fr", "b"),
        (None, None, None, None),
        (4, "", "fr", "b"),
        (5, " \t\n ", None, "b"),
        (6, long, "en", "a"),
        (7, long, "en", "c"),
        (8, "Ünï çödé\n\n|| ## $$ 123", "xx", "c"),
    ]
    return make_docs(rows)
