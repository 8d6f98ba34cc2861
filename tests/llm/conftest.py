import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns named like those that operators return or use inside.
CLASH = ("score", "spans", "ids", "kept", "key", "at", "id", "t", "n", "class_id", "leaks", "starts", "__text", "hash")


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of (doc_id, text) rows."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def prose():
    """Texts of random words: seed, words."""

    def make(seed, n, words=400):
        r = random.Random(seed)
        return " ".join(f"w{r.randrange(words)}x{r.randrange(9)}" for _ in range(n))

    return make


@pytest.fixture(scope="session")
def edge_rows(prose):
    """Null and empty texts, null and repeated ids, repeated rows, ties and one very long text."""
    a, b = prose(1, 60), prose(2, 80)
    return [(1, None), (2, ""), (3, a), (4, a), (4, a), (None, b), (None, b), (5, b), (5, a), (6, "\n\n"), (7, " \t "), (8, "one two"),
            (9, "x" * 50_000), (10, prose(3, 40_000)), (11, "\x1c\x85\u3000é\U0001F600 " * 3)]


@pytest.fixture(scope="session")
def clashing(spark, docs, edge_rows):
    df = docs(edge_rows)
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("extra").alias(c) for c in CLASH])
