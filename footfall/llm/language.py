"""Language identification by compression with one raw-content dictionary per language.

A dictionary is text of that language: short pieces of training documents. A text is compressed
with every language's dictionary (zstandard) and gets the language with the smallest result.
A narrow margin over the runner-up rejects it, and so does a size that no dictionary makes small (more than
``NOISE_BITS`` a letter): such a text is noise or in no learned language. Repeats in the text make it small by itself
and its margin narrow, so its different words are compressed alone too; their size is looked at where they are ``LONG``
letters, and their margin where the whole text's is too narrow. Texts below ``LONG`` letters are
often stored as they are, in equal sizes; there the dictionaries' letter triples decide, and reject only ties.

Letters only, in lower case, are compressed, in blocks, so that long texts are judged by the
dictionary and not by themselves. Whole texts are used.

* Null texts and texts without a letter are ``und`` with score 0, and rejected.
* Equal in sizes and triples: the alphabetically first language, rejected. One learned language wins always;
  with none, all are ``und``.
* Training rows without text or language are not learnt from; rows that repeat an id count each.
* A dictionary comes from at most ``TRAINING_TEXTS`` documents and ``DICTIONARY`` bytes per language.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINING_TEXTS = 400
PIECE = 320
DICTIONARY = 96 * 1024
BLOCK = 2048
#: Greedy matching of four bytes and more, so that short words of a dictionary count too.
MATCHING = dict(strategy=zstandard.STRATEGY_GREEDY, min_match=4, search_log=3, window_log=17, hash_log=16, chain_log=16)
#: The least lead of the winner over the runner-up, as a share of the runner-up's size; in long texts, and in those below.
LONG = 320
LONG_MARGIN, MARGIN = 0.01, 0.002
#: The most bits a letter in a long text, beyond what each block costs empty.
NOISE_BITS, EMPTY_BITS = 4.9, 100
#: How fast the score falls with the distance in size.
SHARPNESS = 40.0
RESULT = "struct<lang: string, score: double, margin: double, rejected: boolean>"

_other = re.compile(rb"[\x00-\x60\x7b-\x7f]+").sub


def letters(text: str) -> bytes:
    """Lower case, with one blank for each run of ASCII characters that are no letters."""
    return _other(b" ", text.lower().encode())


def triples(raw: bytes) -> list[bytes]:
    padded = b" " + raw.strip() + b" "
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def train(docs: DataFrame, learn: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> dict[str, bytes]:
    """A dictionary for each language of the rows that ``learn`` (over ``doc_id``) names."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang"))
    rows = rows.filter(F.coalesce(learn, F.lit(False)) & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    # a share of each language's rows by hash, then at most the wanted number in the order of the hash
    share = F.create_map(*chain.from_iterable((F.lit(k), F.lit(min(1.0, 1.5 * TRAINING_TEXTS / n))) for k, n in counts.items()))
    place = F.pmod(F.xxhash64("doc_id", F.crc32(F.col("text").cast("binary"))), F.lit(1 << 30))
    at = F.pmod(place, F.greatest(F.length("text") - PIECE, F.lit(0)) + 1).cast("int") + 1
    some = rows.withColumn("place", place).filter(F.col("place") < F.element_at(share, F.col("lang")) * (1 << 30))
    # rows that are alike in id and text give one piece, and a language no more than it may learn from
    some = some.select("lang", "place", F.col("text").substr(at, F.lit(PIECE)).alias("piece")).distinct()
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("place", "piece"))
    found = some.withColumn("nth", nth).filter(F.col("nth") <= TRAINING_TEXTS).collect()
    out = {}
    for lang in sorted(counts):
        pieces = sorted((r.place, r.piece) for r in found if r.lang == lang)
        out[lang] = b" ".join(dict.fromkeys(letters(p) for _, p in pieces))[-DICTIONARY:]
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.compressors = []
        self.triples = [Counter(triples(dictionaries[lang])) for lang in self.langs]
        for lang in self.langs:
            data = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters(write_content_size=False, **MATCHING)
            data.precompute_compress(compression_params=how)
            self.compressors.append(zstandard.ZstdCompressor(compression_params=how, dict_data=data))

    def sizes(self, text: str) -> list[int]:
        return self._sizes(letters(text))

    def _sizes(self, raw: bytes) -> list[int]:
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.compressors]

    def _judged(self, raw: bytes) -> tuple[np.ndarray, int, float, bool]:
        """Sizes, the smallest one's place, its margin, and whether that is wide enough."""
        sizes = np.array(self._sizes(raw), float)
        best = int(sizes.argmin())
        second = np.partition(sizes, 1)[1]
        margin = float((second - sizes[best]) / second)
        return sizes, best, margin, margin >= (LONG_MARGIN if len(raw) >= LONG else MARGIN)

    def __call__(self, text: str | None) -> tuple[str, float, float, bool]:
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0, True
        if len(self.langs) == 1:
            return self.langs[0], 1.0, 1.0, False
        raw = letters(text)
        sizes, best, margin, wide = self._judged(raw)
        rejected = False
        if len(raw) >= LONG:
            once = b" ".join(dict.fromkeys(raw.split()))
            alone = self._judged(once)
            judged, size = (once, alone[0].min()) if len(once) >= LONG else (raw, sizes[best])
            bits = (8 * size - EMPTY_BITS * -(-len(judged) // BLOCK)) / len(judged)
            if not wide and len(once) <= len(raw) // 2:
                sizes, best, margin, wide = alone
            rejected = not wide or bits > NOISE_BITS
        elif not wide:
            known = np.array([sum(math.log1p(own[t]) for t in triples(raw)) for own in self.triples])
            if (known == known.max()).sum() == 1:
                best = int(known.argmax())
            else:
                rejected = True
        score = float(1 / np.exp(-SHARPNESS * (sizes - sizes[best]) / sizes.min()).sum())
        return self.langs[best], score, margin, bool(rejected)


def classifier(docs: DataFrame, dictionaries: dict[str, bytes]) -> Callable[[Column], Column]:
    """A function from a text column to (lang, score, margin, rejected)."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    @F.pandas_udf(RESULT)
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Classifier(shared.value)
        for texts in batches:
            yield pd.DataFrame([own(t) for t in texts], columns=["lang", "score", "margin", "rejected"])

    return identify
