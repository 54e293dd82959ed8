import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from texts; ids from 0."""

    def make(texts, ids=None):
        rows = [(i, t, "en", "s", len(t or "")) for i, t in zip(ids or range(len(texts)), texts)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def words():
    """Seeded random words."""

    def make(n, seed):
        rng = random.Random(seed)
        return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]

    return make


#: Rows that every operator must take: null, empty, blanks, control characters, one word, a tie, non-ASCII and a very long text.
ODD = [None, "", " ", "\n\n", "\x00\x01", "word", "word", "é", "日本語 テキスト", "a" * 5000, "x y " * 40_000]
