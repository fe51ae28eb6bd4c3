"""Helpers for tests of the text operators."""

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def make_docs(spark):
    """Documents out of (doc_id, text[, lang, source]) in a number of partitions."""

    def make(rows, parts=2):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s1",
                 None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.repartition(parts, "doc_id") if full else df

    return make


def words(rng, n, size=2000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.fixture()
def rng():
    return random.Random(5)


@pytest.fixture()
def odd_rows(rng):
    """Nulls, empty and blank texts, one word, a long text, other scripts, ties, repeats."""
    long = " ".join(words(rng, 30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, long), (6, long), (7, "日本語 テキスト éa"),
        (None, "a text without a key " * 20), (8, "same text here " * 30), (8, "same text here " * 30),
        (9, "a\x00b \x1c c"), (10, "line one\nline one\nline two"),
    ]
