import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

#: Names that the operators use themselves; a table may have them too.
CLASHING = ["id", "tie", "key", "fp", "node", "score", "kept", "label", "n_words", "_row", "_size", "_source", "_block",
            "_doc", "_id", "group", "place", "packed", "spans", "vector", "at", "first"]

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def with_clashing_columns(frame):
    return frame.withColumns({name: F.lit(f"extra {name}") for name in CLASHING})


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with extra columns of clashing names."""

    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return with_clashing_columns(spark.createDataFrame(full, DOC_SCHEMA))

    return make


@pytest.fixture(scope="session")
def words():
    """Seeded texts of invented words."""

    def text(seed, n, vocabulary=5000):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))

    return text


@pytest.fixture(scope="session")
def odd_rows(words):
    """Nulls, empty and blank texts, repeated rows, equal ids, a long text, characters outside the first plane."""
    long = words(1, 30_000)
    return [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, words(5, 80)), (5, words(5, 80)), (5, words(6, 80)),
            (None, words(7, 90)), (None, None), (8, long), (9, long), (10, "\U0001f600 é ß\n" * 40)]
