"""Helpers for the tests of the llm operators: small frames and the plain ways to the same results."""

from __future__ import annotations

import pytest

#: Cases that every operator on texts must take: null and empty texts, ties, repeats, a very long word and text.
ODD_TEXTS = [
    None, "", " ", "\n\t ", "a", "A", "a b", "one two three four five", "one two three four five six", "Ünï cödé — «ß» ﬁ ①",
    "<|endoftext|> and <s> </s> ▁x", "x" * 5000, "word " * 3000, "  two  blanks\r\n and nbsp em ", "tabs\tand\x0bvt", "'s it's don't ###",
    "one two three four five", "日本語 のテキスト",
]


@pytest.fixture(scope="session")
def docs_of(spark):
    """A frame of documents; ids are given or counted, and extra columns have the names that operators use."""

    def make(texts, ids=None, langs=None, partitions=3):
        ids = range(len(texts)) if ids is None else ids
        langs = langs or ["en"] * len(texts)
        rows = [(i, t, lang, "src0", len(t or ""), 1, "x", 0.5) for i, t, lang in zip(ids, texts, langs)]
        schema = "doc_id long, text string, lang string, source string, n_chars long, n long, word string, score double"
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """The odd texts, with a null id and a repeated row."""
    ids = [*range(len(ODD_TEXTS) - 2), None, 5]
    return docs_of([*ODD_TEXTS, ODD_TEXTS[5]], [*ids, 5])


@pytest.fixture(scope="session")
def no_docs(docs_of):
    return docs_of([])
