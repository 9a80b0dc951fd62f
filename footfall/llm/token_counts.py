"""Token counts: pieces counted once per distinct pre-token, joined to the documents' pre-tokens.

A sentencepiece BPE model whose pieces hold the blank mark only at their beginning never merges
across the place before a blank, so a text's count is the sum over its pre-tokens (a run of
blanks and what follows up to the next blank). No ids are kept.

* Null and empty texts have 0 tokens; a row without an id, and rows that repeat an id, are
  counted each on its own; an empty table gives an empty result.
* A pre-token may be as long as its text. The piece counts of frequent pre-tokens (learnt from
  a sixteenth of the rows) travel to the tasks in a bounded table; which words are in it decides only their
  way, not the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import wordsums
from footfall.llm.common import id_text, pieces_of

MARK = "▁".encode()
_words = re.compile(rb" *[^ ]+| +").findall
_models: dict[str, object] = {}


def pre_tokens(text: bytes) -> list[bytes]:
    """Cuts before each run of blanks; the model itself puts one blank before the text."""
    return _words(b" " + text.replace(MARK, b" ")) if text else []


def model(name: str):
    if name not in _models:
        import sentencepiece

        loaded = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        inner = re.compile("[^▁]▁")
        if any(inner.search(loaded.id_to_piece(i)) for i in range(loaded.vocab_size())):
            raise ValueError(f"{name} has pieces that reach across a blank")
        _models[name] = loaded
    return _models[name]


def piece_counts(words: DataFrame, name: str) -> DataFrame:
    """Adds ``k``, the number of pieces, to distinct pre-tokens (word, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = model(name).encode
        for batch in batches:
            for part in pieces_of(batch, 4096):
                texts = [w[1:].decode() for w in part.column(0).to_pylist()]  # the model adds the first blank again
                ids = [len(x) if t else None for t, x in zip(texts, encode(texts, num_threads=1))]
                ids = [alone(encode) if n is None else n for n in ids]
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array([0.0] * len(ids)), pa.array(ids, pa.int64())],
                    names=["word", "n", "x", "k"],
                )

    def alone(encode) -> int:
        """A single blank: the model gives none for an empty text, so it is taken from two texts' difference."""
        return len(encode("a ", num_threads=1)) - len(encode("a", num_threads=1))

    return words.mapInArrow(count, "word binary, n long, x double, k long")


def token_counts(docs: DataFrame, name: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens), one row for each row of ``docs``."""
    texts = id_text(docs, id_col, text_col)
    some = texts.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(16)) == 0)  # by text too, as ids may be null or all the same
    frequent = wordsums.word_counts(some, pre_tokens).filter("n > 1")
    hot = wordsums.hot_words(wordsums.written(piece_counts(frequent, name), "frequent-pieces"))
    split = wordsums.frequencies(texts, pre_tokens, hot)
    # the row's number is asked for so that this and the join read one exchange
    rest = wordsums.cold_rows(split).groupBy("word").agg(F.sum("f").alias("n"), F.max("row").alias("row"))
    return wordsums.sum_words(split, piece_counts(rest, name)).select("doc_id", "n_bytes", F.col("k").alias("n_tokens"))
