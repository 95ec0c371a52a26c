import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, place string"


@pytest.fixture(scope="session")
def documents(spark):
    """documents([(doc_id, text), ...]) -> a documents table; more values go to lang and source."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], *(r[2:] or ("en", "a"))[:2], len(r[1] or ""), "clash", "clash") for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions) if full else spark.createDataFrame([], SCHEMA)

    return make


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n) -> n invented words."""

    def make(seed, n):
        r = random.Random(seed)
        return " ".join("".join(r.choice(["an", "der", "ti", "on", "re", "th", "é", "ing"]) for _ in range(r.randint(1, 3))) for _ in range(n))

    return make


EDGE_TEXTS = [None, "", " \t\n ", "a", " ", "x" * 30_000, "word " * 20_000, "a\x00b", "日本語 テキスト", "🙂🙂 é é"]


@pytest.fixture(scope="session")
def edges():
    """Nulls, empty and very long texts, odd characters, repeated rows and a null id."""
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)]
    return rows + [(0, None), (5, EDGE_TEXTS[5]), (None, "a"), (77, "a "), (78, "a")]
