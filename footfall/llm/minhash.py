"""Near-duplicate components by MinHash banding with sequential Bayesian verification.

A document is the set of its distinct 5-word shingles (words lower-cased in A-Z only; fewer
words: the whole sequence). Documents of equal sets form one class, of which one member goes
on. Classes that agree in a band of their signatures share a bucket. Candidate pairs are
compared signature batch by batch: with k of m equal values, a pair goes on only while the
posterior probability of reaching the similarity (uniform prior) is above ``miss``. Survivors
are verified on the full shingle sets.

Only the components are wanted, so a bucket does not list all its pairs. Each round pairs the
members of a bucket with one of them, and members that are already in the same component are
done. In the last round the members of buckets that still hold several components meet over
their rarest shingles: pairs of different components that may reach the similarity are
verified too. So no pair that shares a bucket is left unless it lies within one component or
cannot be similar enough. Large groups are spread over tasks by salting.

* Null and empty texts, and texts without words, have 0 shingles and stay alone.
* Rows that repeat an id are one document, linked to whatever one of its texts is linked to;
  its ``n_shingles`` is the largest. Rows without an id take no part.
* Ties: the component's name is its smallest id. An empty table gives an empty result.
* With the default bands a pair of similarity 0.85 is missed with probability 8e-7.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import PIECE_BYTES, id_text, pieces_of, written
from footfall.llm.components import components
from footfall.llm.textops import factors, mix, shingle_sets

WORDS = 5
BANDS, BAND_ROWS = 24, 5
BATCH = 24
STAR_ROUNDS = 2
MEMBERS_PER_SALT = 2048
HASHES = BANDS * BAND_ROWS
_xor = np.random.default_rng(11).integers(0, 1 << 32, HASHES, dtype=np.uint32)
_times = np.random.default_rng(12).integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def signatures(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over each set; the sets lie end to end in ``flat``."""
    x = (flat >> np.uint64(32)).astype(np.uint32)
    return np.stack([np.minimum.reduceat((x ^ r) * a, starts) for r, a in zip(_xor, _times)], axis=1)


def least_matches(threshold: float, miss: float) -> list[int]:
    """For each number of compared values, the fewest equal ones of a pair worth going on with.

    Values are compared by their low 8 bits, which agree by chance once in 256. With a uniform
    prior, P(similarity >= t | k of m) is the chance that of m + 1 draws at rate t at most k hit.
    """
    t = threshold + (1 - threshold) / 256
    out = []
    for m in range(BATCH, HASHES + 1, BATCH):
        term, total, k = (1 - t) ** (m + 1), 0.0, 0
        while True:
            total += term
            if total > miss:
                break
            term *= (m + 1 - k) / (k + 1) * t / (1 - t)
            k += 1
        out.append(k)
    return out


def signature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table (doc, n, f1, f2, bands, sig); f1 and f2 are a fingerprint of the set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band_factors = factors(BAND_ROWS, 13)
        for batch in chain.from_iterable(pieces_of(b, 256, PIECE_BYTES) for b in batches):
            sets = shingle_sets([(t or b"").lower() for t in batch.column(1).to_pylist()], WORDS)
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            some = n > 0
            starts = (np.cumsum(n) - n)[some]
            f1, f2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
            bands, sig = np.zeros((len(sets), BANDS), np.uint64), np.zeros((len(sets), HASHES), np.uint8)
            if some.any():
                flat = np.concatenate(sets)
                f1[some] = np.add.reduceat(mix(flat), starts)
                f2[some] = np.bitwise_xor.reduceat(mix(flat * np.uint64(0xD6E8FEB86659FD93)), starts)
                values = signatures(flat, starts)
                rows = values.reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
                bands[some] = mix((rows * band_factors).sum(2, dtype=np.uint64))
                sig[some] = values.astype(np.uint8)
            lists = pa.ListArray.from_arrays(np.arange(0, len(sets) * BANDS + 1, BANDS, np.int32), bands.view(np.int64).ravel())
            yield pa.record_batch([
                batch.column(0), pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), lists,
                pa.array([r.tobytes() for r in sig], pa.binary()),
            ], names=["doc", "n", "f1", "f2", "bands", "sig"])

    schema = "doc long, n long, f1 long, f2 long, bands array<long>, sig binary"
    return written(id_text(docs, id_col, text_col).filter("doc_id is not null").mapInArrow(sign, schema), "signatures")


def prune(pairs: DataFrame, least: list[int]) -> DataFrame:
    """Those of ``pairs`` (a, b, sa, sb) whose signatures hold out through all batches."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, HASHES) for i in (2, 3)]
            left, equal = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for i, needed in enumerate(least):
                part = slice(i * BATCH, (i + 1) * BATCH)
                equal = equal + (sides[0][left, part] == sides[1][left, part]).sum(1)
                left, equal = left[equal >= needed], equal[equal >= needed]
            yield batch.select([0, 1]).take(pa.array(left))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long")


def confirm(pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b, ta, tb) whose full sets have 100 * common >= percent * united."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(pieces_of(b, 128, PIECE_BYTES) for b in batches):
            left, right = (shingle_sets([t.lower() for t in batch.column(i).to_pylist()], WORDS) for i in (2, 3))
            keep = []
            for i, (x, y) in enumerate(zip(left, right)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common) > 0:
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return pairs.select("a", "b", "ta", "tb").mapInArrow(compare, "a long, b long")


class Search:
    """The tables that all rounds read."""

    def __init__(self, members: DataFrame, sigs: DataFrame, texts: DataFrame, percent: int, miss: float, same: DataFrame):
        self.members, self.sigs, self.texts, self.percent = members, sigs, texts, percent
        self.least = least_matches(percent / 100, miss)
        self.links = same
        self.tried = None
        self.labelled = members.withColumn("comp", F.col("doc"))

    def verify(self, pairs: DataFrame) -> None:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        self.tried = pairs if self.tried is None else self.tried.union(pairs)
        side = lambda t, name, value: t.select(F.col("doc").alias(name), F.col(value).alias(f"{value[0]}{name}"))
        near = prune(pairs.join(side(self.sigs, "a", "sig"), "a").join(side(self.sigs, "b", "sig"), "b"), self.least).distinct()
        near = written(near, "near-pairs")
        full = near.join(side(self.texts, "a", "text"), "a").join(side(self.texts, "b", "text"), "b")
        links = written(confirm(full, self.percent), "near-links")
        self.links = self.links.union(links)
        self.labels = written(components(self.links), "labels")
        known = self.labels.select(F.col("node").alias("doc"), "component")
        comp = F.coalesce("component", "doc").alias("comp")
        self.labelled = written(self.members.join(known, "doc", "left").select("bucket", "doc", "company", comp), "members")

    def star_pairs(self, number: int) -> DataFrame:
        """Each member of a bucket with one of them: first the one with most company in all its buckets, later any."""
        order = -F.col("company") if number == 0 else F.xxhash64("doc", "bucket", F.lit(number))
        centre = self.labelled.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), "doc", "comp")).alias("c"))
        centre = centre.select("bucket", F.col("c.doc").alias("b"), F.col("c.comp").alias("comp_b"))
        return self.labelled.join(centre, "bucket").filter("comp <> comp_b").select(F.col("doc").alias("a"), "b")

    def rest_pairs(self) -> DataFrame:
        """The pairs of different components, of those that share buckets, that may still be similar enough.

        Shingles are ordered from rare to frequent. The first shingle that two similar sets share
        stands early in both, early enough to leave room for their common part; so only pairs
        that share such a shingle are left. Copies with many edits have many shingles that no
        other text has, and pair with nobody.
        """
        comps = self.labelled.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
        docs = self.labelled.join(comps, "bucket", "left_semi").select("doc", "comp").distinct()
        rows = written(shingle_rows(self.texts.join(docs, "doc")), "open-shingles")
        often = rows.groupBy("h").agg(F.count("*").alias("f")).filter("f > 1")
        order = Window.partitionBy("doc", "set").orderBy("f", "h")
        shared = F.count("*").over(Window.partitionBy("doc", "set"))
        early = rows.join(often, "h").withColumn("place", F.col("n") - shared + F.row_number().over(order))
        early = early.filter(100 * (F.col("n") - F.col("place") + 1) >= self.percent * F.col("n"))
        early = written(early.select("h", "doc", "comp", "n", (F.col("n") - F.col("place") + 1).alias("left")), "early-shingles")

        sizes = early.groupBy("h", "comp").agg(F.count("*").alias("k"))
        open_ = sizes.groupBy("h").agg(
            F.max(F.struct("k", "comp"))["comp"].alias("main"), F.sum("k").alias("k"), F.count("*").alias("comps")
        ).filter("comps > 1").select("h", "main", F.ceil(F.col("k") / MEMBERS_PER_SALT).cast("int").alias("salts"))
        mine = written(early.join(open_, "h"), "open-members")
        minor = mine.filter("comp <> main").select(
            "h", F.col("doc").alias("a"), F.col("comp").alias("comp_a"), F.col("n").alias("n_a"), F.col("left").alias("left_a"),
            F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        )
        salt = F.pmod(F.xxhash64("doc"), F.col("salts")).cast("int").alias("salt")
        others = mine.select("h", F.col("doc").alias("b"), "comp", "n", "left", salt)
        room = (100 + self.percent) * F.least("left_a", "left") >= self.percent * (F.col("n_a") + F.col("n"))
        return minor.join(others, ["h", "salt"]).filter((F.col("comp_a") != F.col("comp")) & room).select("a", "b")


def shingle_rows(texts: DataFrame) -> DataFrame:
    """A row for each shingle (``h``) of each text of ``texts`` (doc, comp, text), with the set's size and a name for it."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(pieces_of(b, 64, PIECE_BYTES) for b in batches):
            sets = shingle_sets([t.lower() for t in batch.column(2).to_pylist()], WORDS)
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            name = np.array([np.add.reduce(mix(s)) for s in sets], np.uint64).view(np.int64)
            owner = pa.array(np.repeat(np.arange(len(sets)), n))
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(name), pa.array(n)]
            yield pa.record_batch([*(c.take(owner) for c in columns), pa.array(flat)], names=["doc", "comp", "set", "n", "h"])

    return texts.select("doc", "comp", "text").mapInArrow(shingle, "doc long, comp long, set long, n long, h long")


def near_duplicates(
    docs: DataFrame, percent: int = 85, miss: float = 1e-6, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document id."""
    table = signature_table(docs, id_col, text_col)
    filled = table.filter("n > 0")
    classes = written(filled.groupBy("f1", "f2").agg(F.min("doc").alias("rep")), "classes")
    rows = written(filled.join(classes, ["f1", "f2"]).select("doc", "n", "rep"), "classes-of-rows")
    again = rows.groupBy("doc").agg(F.min("rep").alias("b"), F.max("rep").alias("hi")).filter("b <> hi").select("doc", "b")
    same = written(rows.join(again, "doc").select(F.col("rep").alias("a"), "b").distinct(), "links-of-repeated-ids")
    of_class = (table.f1 == classes.f1) & (table.f2 == classes.f2)
    reps = filled.join(classes, of_class & (table.doc == classes.rep), "left_semi")
    keys = reps.select("doc", F.posexplode("bands").alias("band", "key")).select(F.xxhash64("band", "key").alias("bucket"), "doc")
    shared = keys.groupBy("bucket").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo <> hi").select("bucket")
    members = written(keys.join(shared, "bucket").distinct(), "bucket-members")
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
    company = members.join(sizes, "bucket").groupBy("doc").agg(F.sum("size").alias("company"))
    members = written(members.join(company, "doc"), "bucket-members")
    involved = written(members.select("doc").distinct(), "involved")
    sigs = written(filled.join(involved, "doc", "left_semi").select("doc", "sig"), "involved-signatures")
    texts = id_text(docs, id_col, text_col).select(F.col("doc_id").alias("doc"), "text")
    texts = written(texts.join(involved, "doc", "left_semi").filter("text is not null"), "involved-texts")
    search = Search(members, sigs, texts, percent, miss, same)
    for number in range(STAR_ROUNDS):
        search.verify(search.star_pairs(number))
    search.verify(search.rest_pairs())

    named = rows.join(search.labels, rows.rep == search.labels.node, "left")
    linked = named.select("doc", "n", F.coalesce("component", "rep").alias("component_id"))
    alone = table.filter("n = 0").select("doc", "n", F.col("doc").alias("component_id"))
    return (
        linked.union(alone)
        .groupBy(F.col("doc").alias("doc_id"))
        .agg(F.max("n").alias("n_shingles"), F.min("component_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
