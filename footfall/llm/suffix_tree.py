"""Language model scoring with a probabilistic suffix tree over words.

The symbols are the words of a text in lower case (A-Z), then one end. The model knows the words of the
training texts; all others are one symbol, the unknown word, as in the base score.

A context is the run of up to ``DEPTH`` symbols before a symbol, the beginning of the text
included. Every run that is followed at least ``OFTEN`` times is tried, level by level. A next symbol's
departure from what the suffix predicts is tested by its gain in code length, at least ``BITS``;
a context is retained if it has symbols that pass. For them it keeps a discounted frequency; what
is left of its probability is spread as its suffix spreads it. The root discounts every word's
count, which leaves the unknown word its share. Each level's distribution sums to one. A symbol
is scored by the longest retained suffix of what comes before.

Both bounds are absolute, so what is learnt grows with the corpus, and all words take part. Levels
are written tables keyed by 64-bit hashes of runs. A symbol's log probability is its root value plus,
for each run before it, that context's spreading factor, plus, where the run and the symbol
passed, what the passing changes; so a text's score is a sum of values of its runs, which a
join brings. Bit filters of fixed size keep most runs without a value out of the shuffles; what
they let through by chance the joins drop. The most frequent runs' values every task holds.

* Null and empty texts are the end alone. Rows without an id belong to no fold and are learnt
  from; rows that repeat an id count, and are scored, each on its own.
* Without training documents every symbol has probability 0.5 and the base score is 0. An empty table gives an empty result.
* Texts of any length are scored whole.
"""

from __future__ import annotations

import gc
import posixpath
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import PIECE_BYTES, ROWS_PER_BATCH, id_text, pieces_of, written
from footfall.llm.textops import mix, word_hashes
from footfall.session import remove_path

DEPTH = 3
#: Symbols of ``contexts`` and of the view of small models: 0 any word that has no number, then words, and the end.
OTHER, END = 0, 0xFFFF
#: A context is tried where so many symbols follow it; a symbol passes with so many bits of gain.
OFTEN, BITS = 2, 20.0
DISCOUNT = 0.5
KEYS_PER_TASK = 250_000
#: Rows of a block, so that it stays below what the JVM's collector takes for a large object, and blocks that are handed over at once.
ROWS_PER_BLOCK, BLOCKS_PER_BATCH = 16_384, 16
ROWS_TO_PYTHON = 1024
#: Runs that a task sorts at once for a join of blocks, and about as many as a range has there.
KEYS_PER_DEAL = KEYS_PER_MEETING = 250_000
#: Runs that are merged at once, and the fewest of a task that are worth a block.
KEYS_PER_RANGE, KEYS_PER_BLOCK = 4_000_000, 16
BYTES_PER_SYMBOL = 6
#: Runs of texts, about, that meet the values of a range in one group.
PAIRS_PER_RANGE = 2_000_000
#: Runs whose values every task holds.
HOT, HOT_BITS = 262_144, 21
FILTER_BITS, BITMAP_BITS = 27, 15
#: Odd, and small enough that no group's multiple leaves 63 bits.
GROUP_STEP = 0x517CC1B7272221
END_HASH, STEP = np.uint64(0x5851F42D4C957F2D), np.uint64(0xD1342543DE82EF95)
END_KEY = int(END_HASH.view(np.int64))


def contexts(stream: np.ndarray, depth: int) -> np.ndarray:
    """For each symbol but the first, its context of that depth: the nearest symbol lowest; 0 where there is none.

    A stream is an end, then texts each closed by an end. A context holds no other words, and reaches back to the last end at most.
    """
    n = len(stream) - 1
    key, whole = np.zeros(n, np.uint64), np.ones(n, bool)
    for d in range(1, depth + 1):
        before = np.zeros(n, np.uint16)
        before[d - 1 :] = stream[: n - d + 1]
        key |= before.astype(np.uint64) << np.uint64(16 * (d - 1))
        whole &= before != OTHER
        if d < depth:
            whole &= before != END
    return np.where(whole, key, 0)


def streams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An end, then each text's word hashes and an end; how far back each symbol's last end is; the sizes of the texts, ends included."""
    flat, first, _, _ = word_hashes([t.lower() for t in texts])
    sizes = np.diff(first[: len(texts)], append=len(flat)) + 1
    stream = np.full(len(flat) + len(texts) + 1, END_HASH, np.uint64)
    stream[np.arange(len(flat)) + np.repeat(np.arange(len(texts)), sizes - 1) + 1] = flat
    since = np.arange(len(stream))
    since[1:] -= np.repeat(np.cumsum(sizes) - sizes, sizes)
    return stream, since, sizes


def run_keys(stream: np.ndarray, order: int) -> list[np.ndarray]:
    """The keys of the runs of 1 to ``order`` symbols that end at each place."""
    out = [stream]
    for _ in range(1, order):
        key = np.zeros(len(stream), np.uint64)
        key[1:] = mix(out[-1][:-1] * STEP + stream[1:])
        out.append(key)
    return out


class Filter:
    """A bit filter over keys: says yes to all of them, and to others by chance."""

    def __init__(self, keys: DataFrame):
        masked = lambda c: c.bitwiseAND((1 << FILTER_BITS) - 1)
        places = F.explode(F.array(masked(F.col("key")), masked(F.shiftrightunsigned("key", 32)))).alias("p")
        bits = keys.select(places).groupBy(F.shiftright("p", BITMAP_BITS).cast("int").alias("at"))
        rows = bits.agg(F.bitmap_construct_agg(F.col("p").bitwiseAND((1 << BITMAP_BITS) - 1)).alias("b")).toArrow()
        size = 1 << (BITMAP_BITS - 3)
        self.bits = np.zeros((1 << (FILTER_BITS - BITMAP_BITS), size), np.uint8)
        for at, raw in zip(rows.column("at").to_pylist(), rows.column("b")):
            self.bits[at] = np.frombuffer(raw.as_py(), np.uint8)
        self.bits = self.bits.ravel()

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        yes = np.ones(len(keys), bool)
        for place in (keys, keys >> np.uint64(32)):
            place = place & np.uint64((1 << FILTER_BITS) - 1)
            yes &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 != 0
        return yes


def signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64))


def summed(keys: list[np.ndarray], counts: list[np.ndarray], groups: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the sum of each one's counts, and the smallest of its groups."""
    k, n, g = (np.concatenate(x) for x in (keys, counts, groups))
    by = np.argsort(k)
    k, n, g = k[by], n[by], g[by]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])[: len(k)])
    return k[first], (np.add.reduceat(n, first) if len(k) else n), (np.minimum.reduceat(g, first) if len(k) else g)


def groups_of(texts: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """The group of each symbol's text: a byte of a hash of the text."""
    return np.repeat(np.fromiter((zlib.crc32(t) & 0xFF for t in texts), np.uint8, len(texts)), sizes)


def named(keys: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """One key for a run and a group."""
    return keys ^ (groups.astype(np.uint64) * np.uint64(GROUP_STEP))


_compressor, _decompressor = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes; high bytes that are mostly zero cost next to nothing."""
    return _compressor.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(_decompressor.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


#: Blocks: many rows of a table as one, a column a binary of ``packed`` numbers; of the first, keys, the differences.
BLOCKS = "kind int, range long, rows long, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary"
BLOCK_NAMES = [c.split()[0] for c in BLOCKS.split(", ")]
BLOCK_COLUMNS = 5
#: What blocks hold, by ``kind``: runs with their parts and counts, counted runs, and the range's slices of two filters.
PARTS, COUNTS, KNOWN, WANTED, WORDS = range(5)
U64, I64, F64 = np.uint64, np.int64, np.float64
COUNTED = (U64, I64, np.uint8)  # key, n, g
PARTED = (U64, U64, U64)  # key, ctx, suf
PARTED_COUNTED = (*PARTED, I64)  # and n
GRADED = (U64, I64, F64)  # key, n, lp
JUDGED = (U64, U64, I64, F64, I64)  # ctx, key, n, lp of the suffix, m


def block(kind: int, name: int, columns: list[np.ndarray]) -> tuple:
    first = np.diff(columns[0], prepend=U64(0))
    cells = [packed(first), *map(packed, columns[1:])]
    return kind, name, len(first), *cells, *[None] * (BLOCK_COLUMNS - len(cells))


def blocks_of(kind: int, name: int, columns: list[np.ndarray]) -> list[tuple]:
    return [block(kind, name, [c[i : i + ROWS_PER_BLOCK] for c in columns]) for i in range(0, len(columns[0]), ROWS_PER_BLOCK)]


def batches_of(blocks: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held = []
    for one in blocks:
        held.append(one)
        if len(held) == BLOCKS_PER_BATCH:
            yield block_batch(held)
            held = []
    if held:
        yield block_batch(held)


def block_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * BLOCK_COLUMNS]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], names=BLOCK_NAMES)


def block_table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([block_batch(rows)])


def opened(table: pa.Table | pa.RecordBatch, kinds: tuple[type, ...]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The range and the columns of each block."""
    cells = [table.column(f"c{i}") for i in range(len(kinds))]
    for at, name in enumerate(table.column("range").to_pylist()):
        columns = [unpacked(c[at].as_py(), t) for c, t in zip(cells, kinds)]
        columns[0] = np.cumsum(columns[0], dtype=U64)
        yield name, columns


def joined(table: pa.Table, kinds: tuple[type, ...]) -> list[np.ndarray]:
    """The columns of all blocks of a table, sorted by the first."""
    parts = [columns for _, columns in opened(table, kinds)]
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, t) for t in kinds]
    by = np.argsort(columns[0])
    return [c[by] for c in columns]


class Slices(Filter):
    """A bit filter of which each range of keys fills a slice of its own."""

    def __init__(self, bits: int, rows: pa.Table):
        self.range_bits, self.bits = bits, np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        size = len(self.bits) >> bits
        for name, raw in zip(rows.column("range").to_pylist(), rows.column("c0")):
            self.bits[name * size : (name + 1) * size] = unpacked(raw.as_py(), np.uint8)

    def __call__(self, keys: np.ndarray, names: np.ndarray | None = None) -> np.ndarray:
        yes = np.ones(len(keys), bool)
        inner = FILTER_BITS - self.range_bits
        at = (keys >> U64(64 - self.range_bits)) << U64(inner) if self.range_bits else U64(0)
        for place in self.places(keys if names is None else names, inner):
            place = place | at
            yes &= (self.bits[place >> U64(3)] >> (place & U64(7)).astype(np.uint8)) & 1 != 0
        return yes

    @staticmethod
    def places(names: np.ndarray, inner: int) -> tuple[np.ndarray, np.ndarray]:
        mask = U64((1 << inner) - 1)
        return names & mask, (names >> U64(32)) & mask

    @staticmethod
    def of(kind: int, name: int, names: np.ndarray, bits: int) -> tuple:
        """The slice of a range whose keys have these ``names``."""
        places = np.sort(np.concatenate(Slices.places(names, FILTER_BITS - bits)))
        at, out = (places >> U64(3)).astype(np.int64), np.zeros(1 << (FILTER_BITS - bits - 3), np.uint8)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        out[at[first]] = np.bitwise_or.reduceat(np.uint8(1) << (places & U64(7)).astype(np.uint8), first) if len(at) else 0
        return kind, name, 0, packed(out), *[None] * (BLOCK_COLUMNS - 1)


def scan(order: int, known, wanted: Filter | None = None, count: bool = True, words: bool = False):
    """A function of record batches of texts that gives, some ``KEYS_PER_TASK`` at a time and sorted by key, with ``words`` (WORDS, keys, counts, 0), with ``count``
    (COUNTS, keys, counts, smallest groups) of the runs of ``order`` symbols whose two shorter runs are in ``known``,
    and with ``wanted`` (PARTS, keys, ctx, suf) of the runs of one symbol less that are in it with the group of their text: the
    runs without their last and without their first symbol. So of the many texts that may have a run, those of one group name its parts.
    """

    def of_counts(parts: list) -> tuple:
        return COUNTS, *summed(*zip(*((k, np.ones(len(k), np.int64), g) for k, g in parts)))

    def of_words(parts: list) -> tuple:
        key, n = np.unique(np.concatenate(parts), return_counts=True)
        return WORDS, key, n, np.zeros(len(n), np.uint8)

    def of_parts(parts: list) -> tuple:
        key, ctx, suf = (np.concatenate(c) for c in zip(*parts))
        by = np.argsort(key)
        by = by[np.append(True, np.diff(key[by]) != 0)[: len(by)]]
        return PARTS, key[by], ctx[by], suf[by]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held = {COUNTS: [], PARTS: [], WORDS: []}
        sizes_ = dict.fromkeys(held, 0)
        ends = {COUNTS: of_counts, PARTS: of_parts, WORDS: of_words}
        for batch in chain.from_iterable(pieces_of(b, 256, PIECE_BYTES) for b in batches):
            raw = [t or b"" for t in batch.column(0).to_pylist()]
            stream, since, sizes = streams(raw)
            runs, groups = run_keys(stream, order), groups_of(raw, sizes)
            yes = known(runs[-2]) if known is not None else None
            if wanted is not None:
                at = 1 + np.flatnonzero((since[1:] >= order - 2) & yes[1:])
                at = at[wanted(runs[-2][at], named(runs[-2][at], groups[at - 1]))]
                held[PARTS].append((runs[-2][at], runs[-3][at - 1], runs[-3][at]))
                sizes_[PARTS] += len(at)
            if words:
                held[WORDS].append(stream[1:])
                sizes_[WORDS] += len(stream) - 1
            if count:
                whole = since[1:] >= order - 1
                at = 1 + np.flatnonzero(whole & yes[1:] & yes[:-1] if yes is not None else whole)
                held[COUNTS].append((runs[-1][at], groups[at - 1]))
                sizes_[COUNTS] += len(at)
            for kind, parts in held.items():
                if sizes_[kind] > KEYS_PER_TASK:
                    yield ends[kind](parts)
                    parts.clear()
                    sizes_[kind] = 0
        for kind, parts in held.items():
            if parts:
                yield ends[kind](parts)

    return chunks


def as_rows(chunks: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    for _, k, n, g in chunks:
        for i in range(0, len(k), ROWS_PER_BATCH):
            part = slice(i, i + ROWS_PER_BATCH)
            yield pa.record_batch([signed(k[part]), pa.array(n[part]), pa.array(g[part].astype(np.int64))], names=["key", "n", "g"])


def count_runs(texts: DataFrame, order: int, shorter: Filter | None, symbols: int = 0, often: int = 1) -> DataFrame:
    """(key, n, g): how often each run of ``order`` symbols is there, of those whose two shorter runs are in ``shorter``, from ``often`` on,
    and the smallest group of the texts that have it.

    Most runs come once, so that counting them in a task saves little. Where ``symbols`` says how many there may
    be, a task sends each range of keys as one block of sorted keys' differences, a third of what rows take, and a range, of
    about ``KEYS_PER_RANGE``, is merged at once. Where ranges are so many that blocks would hold next to nothing, rows are sent.
    """
    shape = "key long, n long, g long"
    bits = range_bits(symbols)
    if symbols and KEYS_PER_TASK >> bits >= KEYS_PER_BLOCK:
        return scanned_level(texts, order, bits, shorter, often=often).filter(F.col("kind") == COUNTS).mapInArrow(rows_of(COUNTED, shape), shape)
    shared = texts.sparkSession.sparkContext.broadcast(shorter)
    rows = texts.select("text").mapInArrow(lambda batches: as_rows(scan(order, shared.value)(batches)), shape)
    return rows.groupBy("key").agg(F.sum("n").alias("n"), F.min("g").alias("g")).filter(F.col("n") >= often)


def rows_of(kinds: tuple[type, ...], shape: str, keep=None):
    """A function that gives the rows of blocks, those for which ``keep`` of the columns is true."""
    names = [c.split()[0] for c in shape.split(", ")]
    column = lambda c: pa.array(c.view(np.int64) if c.dtype == U64 else c.astype(np.int64) if c.dtype == np.uint8 else c)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, columns in opened(batch, kinds):
                if keep is not None:
                    yes = keep(*columns)
                    columns = [c[yes] for c in columns]
                for i in range(0, len(columns[0]), ROWS_PER_BATCH):
                    yield pa.record_batch([column(c[i : i + ROWS_PER_BATCH]) for c in columns], names=names)

    return rows


def scanned_level(
    texts: DataFrame, order: int, bits: int, known, wanted: Filter | None = None, counts: DataFrame | None = None, count: bool = True, often: int = OFTEN, words: bool = False
) -> DataFrame:
    """Written table: blocks of ranges of keys, of one pass over the texts: counted runs of ``order`` symbols with the slices of their filters, and with
    ``counts``, blocks of the runs of one symbol less, these with their counts and their parts, which the pass names by ``wanted``; with ``words`` also all words."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast((known, wanted))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, want = shared.value
        for kind, key, *more in scan(order, of, want, count, words)(batches):
            if kind != PARTS:
                more[0] = more[0].astype(np.uint32)
            yield from batches_of(chain.from_iterable(blocks_of(kind, name, [key[a:b], *(c[a:b] for c in more)]) for name, a, b in ranges_of(key, bits)))

    def merge(group: tuple, have: pa.Table, sent: pa.Table) -> pa.Table:
        kind, name = (x.as_py() for x in group)
        if kind == PARTS:
            key, ctx, suf = joined(sent, PARTED)
            runs, n, _ = joined(have, COUNTED)
            at, here = found(runs, key)
            here &= np.append(True, key[1:] != key[:-1])[: len(key)]
            return block_table(blocks_of(PARTS, name, [key[here], ctx[here], suf[here], n[at[here]]]))
        parts = [(k, n.astype(np.int64), g) for _, (k, n, g) in opened(sent, (U64, np.uint32, np.uint8))]
        key, n, g = summed(*zip(*parts))
        if kind == WORDS:
            return block_table(blocks_of(WORDS, name, [key, n, g]))
        key, n, g = (c[n >= often] for c in (key, n, g))
        if not len(key):
            return block_table([])
        return block_table([*blocks_of(COUNTS, name, [key, n, g]), Slices.of(KNOWN, name, key, bits), Slices.of(WANTED, name, named(key, g), bits)])

    sent = texts.select("text").mapInArrow(send, BLOCKS)
    have = counts.withColumn("kind", F.lit(PARTS)) if counts is not None else sent.limit(0)
    merged = have.groupBy("kind", "range").cogroup(sent.groupBy("kind", "range")).applyInArrow(merge, BLOCKS)
    out = written(merged, "counted-runs", "kind")
    shared.destroy()
    return out


def in_ranges(columns: list[np.ndarray], bits: int) -> Iterator[tuple]:
    """Rows as blocks of ranges of their first column."""
    by = np.argsort(columns[0])
    columns = [c[by] for c in columns]
    for name, a, b in ranges_of(columns[0], bits):
        yield from blocks_of(0, name, [c[a:b] for c in columns])


def dealt(table: DataFrame, columns: list[str], by: str, take: list[str], bits: int) -> DataFrame:
    """The blocks, or rows, of a table, as blocks of ranges of the keys ``by``; ``columns`` names what the blocks have, ``take`` what else goes along."""
    names = [c.split(":")[0] for c in columns]
    kinds = tuple(KINDS[c.split(":")[1]] for c in columns)
    picked = [names.index(c) for c in (by, *take)]
    from_rows = "c0" not in table.columns

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            parts = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            yield from batches_of(in_ranges(parts, bits))

        for batch in batches:
            if from_rows:
                every = [(0, [batch.column(c).to_numpy(zero_copy_only=False).view(t) for c, t in zip(names, kinds)])]
            else:
                every = opened(batch, kinds)
            for _, parts in every:
                held.append([parts[i] for i in picked])
                waiting += len(parts[0])
                if waiting > KEYS_PER_DEAL:
                    yield from out()
                    waiting = 0
        if waiting:
            yield from out()

    return (table.select(*names) if from_rows else table).mapInArrow(deal, BLOCKS)


KINDS = {"key": U64, "count": I64, "log": F64}


def meet(asked: DataFrame, kinds: tuple[type, ...], values: DataFrame, value_kinds: tuple[type, ...], then, bits: int | None = None) -> DataFrame:
    """Blocks of what ``then`` makes of each block of ``asked``: of its columns, and the places of its keys in the sorted columns of ``values``,
    with a mask of those that are there. With ``bits`` they are of ranges of what is now the first column.

    Blocks are worked on one by one, so that a key that many ask for takes no more memory than others.
    """

    def look_up(table: pa.Table, sent: pa.Table) -> pa.Table:
        keys, *rest = joined(table, value_kinds)
        out, held, waiting = [], [], 0
        for name, columns in opened(sent, kinds):
            at, here = found(keys, columns[0])
            made = then(columns, rest, at, here)
            if bits is None:
                out += [block(0, name, made)] if len(made[0]) else []
                continue
            held.append(made)
            waiting += len(made[0])
            if waiting > KEYS_PER_DEAL:
                out += in_ranges([np.concatenate(c) for c in zip(*held)], bits)
                held, waiting = [], 0
        if held:
            out += in_ranges([np.concatenate(c) for c in zip(*held)], bits)
        return block_table(out)

    return values.groupBy("range").cogroup(asked.groupBy("range")).applyInArrow(look_up, BLOCKS)


class SuffixTree:
    """Retained contexts by level: written tables (ctx, m, spread) and (key, n, own, change); logarithms to base 10."""

    def __init__(self, words: DataFrame):
        self.words = words  # (key, n, lp)
        self.tables: list[tuple[DataFrame, DataFrame]] = []

    def values(self) -> DataFrame:
        """(key, n, y) of all retained contexts and of all runs whose last symbol passed."""
        out = self.words.select("key", "n", F.lit(0.0).alias("y")).limit(0)
        for contexts_, passed in self.tables:
            out = out.union(contexts_.select("ctx", "m", "spread")).union(passed.select("key", "n", "change"))
        return out

    # ---- a view of small models, all of them on the driver ----

    @cached_property
    def _numbered(self) -> tuple[np.ndarray, np.ndarray]:
        rows = self.words.orderBy(F.desc("n"), "key").limit(END).toArrow()
        hashes, root = np.zeros(END + 1, np.uint64), np.zeros(END + 1)
        keys = rows.column("key").to_numpy().view(np.uint64)
        end = keys == END_HASH
        n = int((~end).sum())
        hashes[1 : n + 1], root[1 : n + 1] = keys[~end], rows.column("lp").to_numpy()[~end]
        hashes[END], root[END] = END_HASH, rows.column("lp").to_numpy()[end].sum()
        return hashes, root

    @property
    def root(self) -> np.ndarray:
        return self._numbered[1]

    @cached_property
    def levels(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Contexts, their spread, the runs that passed, and what these keep; sorted by key."""
        out = []
        for pair in self.tables:
            for df, (name, value) in zip(pair, (("ctx", "spread"), ("key", "own"))):
                rows = df.select(name, value).toArrow()
                keys, values = rows.column(0).to_numpy().view(np.uint64), rows.column(1).to_numpy()
                order = np.argsort(keys)
                out += [keys[order], values[order]]
        return list(zip(out[0::4], out[1::4], out[2::4], out[3::4]))

    def log10(self, full: list[np.ndarray], symbol: np.ndarray, depth: int) -> np.ndarray:
        """Of each numbered symbol after the contexts ``full``, the nearest ``depth`` levels."""
        hashes, root = self._numbered
        out = root[symbol]
        for (names, spread, entries, kept), key in zip(self.levels[:depth], full):
            at, known = found(names, key)
            out = np.where(known, out + (spread[at] if len(spread) else 0.0), out)
            at, own = found(entries, mix(key * STEP + hashes[symbol]))
            out = np.where(own, kept[at] if len(kept) else 0.0, out)
        return out


def found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in a sorted table each key is, and whether it is there."""
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)


def places_by_first_bits(table: np.ndarray):
    """A function that gives keys' places in a sorted table of hashes, -1 for others: as ``found``, but by a list of where each beginning of a key is."""
    shift = U64(64 - HOT_BITS)
    first = np.full(1 << HOT_BITS, -1, np.int32)
    heads = table >> shift
    first[heads[::-1]] = np.arange(len(table) - 1, -1, -1, dtype=np.int32)
    longest = int(np.bincount((heads - (heads[0] if len(heads) else U64(0))).astype(np.int64)).max()) if len(heads) else 0
    padded = np.append(table, np.repeat(~table[-1:], longest))

    def places(keys: np.ndarray) -> np.ndarray:
        out = first[keys >> shift]
        open_ = np.flatnonzero(out >= 0)
        at, want = out[open_], keys[open_]
        out[open_] = -1
        for _ in range(longest):
            yes = padded[at] == want
            out[open_[yes]] = at[yes]
            no = ~yes
            open_, at, want = open_[no], at[no] + 1, want[no]
        return out

    return places


def release(*tables: DataFrame, below: str = "") -> None:
    """Deletes written tables that nothing reads again, or of each its folder ``below``, and lets Spark drop the exchanges of plans that are done."""
    for df in tables:
        for folder in {posixpath.dirname(f) for f in df.inputFiles()}:
            if folder.endswith(below):
                remove_path(df.sparkSession, folder)
    gc.collect()
    tables[0].sparkSession._jvm.System.gc()


def gain(n: np.ndarray, m: np.ndarray, lp: np.ndarray) -> np.ndarray:
    """Whether a symbol that comes ``n`` times after a context that comes ``m`` times passes, where its suffix predicts 10 to the ``lp``."""
    expected = m * np.power(10.0, lp)
    return (n > expected) & (n * np.log2(n / expected) - (n - expected) / np.log(2) >= BITS)


def grow(learnt: DataFrame, words: DataFrame, level: DataFrame, bits: int) -> SuffixTree:
    """The tree of the texts ``learnt`` over the table ``words`` (key, n, lp); ``level`` has their counted pairs, in blocks of ranges by so many ``bits``.

    A level is one pass over the texts, which names the parts of its runs and counts those of the next, and joins of blocks: runs meet the
    log probability of their suffix, the count of their context, and how the symbols that passed there leave the rest.
    """
    tree, shorter = SuffixTree(words), words.filter(F.col("n") >= OFTEN)
    shorter_rows = shorter.count()
    rows, known, wanted = counted(level, bits)
    for order in range(2, DEPTH + 2):
        if not rows:
            break
        last = order == DEPTH + 1
        counts = level.filter(F.col("kind") == COUNTS)
        scanned, level = level, scanned_level(learnt, order + 1, bits, known, wanted, counts, count=not last)
        release(scanned)
        deal_bits = (max(rows, shorter_rows) // KEYS_PER_MEETING).bit_length()
        graded = dealt(shorter, ["key:key", "n:count", "lp:log"], "key", ["n", "lp"], deal_bits)
        parts, older = level.filter(F.col("kind") == PARTS), [shorter] if order > 2 else []
        runs = dealt(parts, ["key:key", "ctx:key", "suf:key", "n:count"], "suf", ["key", "ctx", "n"], deal_bits)
        runs = meet(runs, (U64, U64, U64, I64), graded, GRADED, lambda c, v, at, here: [c[2][here], c[1][here], c[3][here], v[1][at[here]]], deal_bits)
        runs = suffixed = written(runs, "suffixed-runs")
        release(level, below=f"/kind={PARTS}")
        runs = meet(runs, (U64, U64, I64, F64), graded, GRADED, lambda c, v, at, here: [*(x[here] for x in c), v[0][at[here]]])
        runs = written(runs, "judged-runs")
        release(suffixed)
        shape = "ctx long, key long, n long, lp double, m long"
        passed = written(runs.mapInArrow(rows_of(JUDGED, shape, lambda ctx, key, n, lp, m: gain(n, m, lp)), shape), "passed")
        own = (F.col("n") - DISCOUNT) / F.col("m")
        left = lambda c: F.greatest(1 - F.sum(c), F.lit(1e-9))
        spread = F.log10(left(own) / left(F.pow(F.lit(10.0), "lp")))
        contexts_ = written(passed.groupBy("ctx").agg(F.max("m").alias("m"), spread.alias("spread")), "contexts")
        changed = passed.join(contexts_.select("ctx", "spread"), "ctx").select(
            "key", "n", F.log10(own).alias("own"), (F.log10(own) - F.col("lp") - F.col("spread")).alias("change")
        )
        tree.tables.append((contexts_, written(changed, "passed-runs")))
        if not last:

            def grade(c: list, v: list, at: np.ndarray, here: np.ndarray) -> list:
                ctx, key, n, lp, m = c
                rest = lp + (np.where(here, v[0][at], 0.0) if len(v[0]) else 0.0)
                return [key, n, np.where(gain(n, m, lp), np.log10((n - DISCOUNT) / m), rest)]

            spreads = dealt(contexts_, ["ctx:key", "spread:log"], "ctx", ["spread"], deal_bits)
            shorter, shorter_rows = written(meet(runs, JUDGED, spreads, (U64, F64), grade), "graded-runs"), rows
            rows, known, wanted = counted(level, bits)
        release(passed, runs, *older)
    return tree


def counted(level: DataFrame, bits: int) -> tuple[int, Slices, Slices]:
    """How many runs a level has counted, and the filters over them and over them with their groups."""
    rows = level.filter(F.col("kind") == COUNTS).agg(F.sum("rows")).first()[0] or 0
    return int(rows), *(Slices(bits, level.filter(F.col("kind") == k).select("range", "c0").toArrow()) for k in (KNOWN, WANTED))


def most_frequent(values: DataFrame, limit: int) -> pa.Table:
    """At most ``limit`` rows of ``values`` (key, n, x, y, k) of the highest n, sorted by key."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    lowest, total = None, 0
    for s, rows in sorted(((r.s, r["count"]) for r in values.groupBy(step.alias("s")).count().collect()), reverse=True):
        total += rows
        if total > limit:
            break
        lowest = s
    return values.filter(step >= lowest if lowest is not None else F.lit(False)).select("key", "x", "y", "k").toArrow()


def range_bits(n: int) -> int:
    """How many leading bits of a key name its range, of ranges of about ``KEYS_PER_RANGE`` of ``n`` keys."""
    return max(0, (n // KEYS_PER_RANGE).bit_length())


def ranges_of(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(range, first, end) of each range that sorted ``keys`` have."""
    at = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    yield from zip(at[first].tolist(), first.tolist(), np.append(first, len(keys))[1:].tolist())


#: Blocks of texts' runs: key, text (counted from the block's ``row``), whether the run is a word, how often it comes; and of texts:
#: row, whether there is an id, the id, words, and the sums of what tasks hold.
RUNS, HEADS = 0, 1
OF_RUNS, OF_HEADS = (U64, np.uint32, np.uint8, np.uint32), (U64, np.uint8, I64, I64, F64, F64, I64)
SPLIT = "kind int, range long, row long, " + ", ".join(f"c{i} binary" for i in range(len(OF_HEADS)))
#: Texts whose sums are added up in one group.
ROW_BITS = 13
SUMS = "row long, doc_id long, n_words long, x double, y double, k long"


def split_texts(texts: DataFrame, hot: pa.Table, known: Filter, bits: int) -> DataFrame:
    """Blocks of a head for each text with the sums of what tasks hold, and of the other runs that may have values, by range of keys."""
    keys = hot.column("key").to_numpy().view(U64)
    order = np.argsort(keys)
    keys = keys[order]
    held = (keys, *(hot.column(c).to_numpy()[order] for c in "xyk"))
    shared = texts.sparkSession.sparkContext.broadcast((held, known))

    def sent(kind: int, name: int, base: int, columns: list[np.ndarray]) -> pa.RecordBatch:
        cells = [packed(np.diff(columns[0], prepend=U64(0))), *map(packed, columns[1:])]
        cells += [None] * (len(OF_HEADS) - len(cells))
        numbers = [pa.array([kind], pa.int32()), pa.array([name]), pa.array([base])]
        return pa.record_batch([*numbers, *(pa.array([c], pa.binary()) for c in cells)], names=[c.split()[0] for c in SPLIT.split(", ")])

    def blocks(base: int, cold: list, heads: list) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(c) for c in zip(*heads)]
        yield sent(HEADS, zlib.crc32(str(base).encode()) % (1 << bits), base, columns)
        own, key, word = (np.concatenate(c) for c in zip(*cold))
        by = np.argsort(key, kind="stable")  # a key's texts stay in their order
        own, key, word = own[by], key[by], word[by]
        new = np.flatnonzero((np.diff(key, prepend=~key[:1]) != 0) | (np.diff(own, prepend=-1) != 0))
        own, key, word, f = own[new].astype(np.uint32), key[new], word[new].astype(np.uint8), np.diff(new, append=len(key)).astype(np.uint32)
        for name, a, b in ranges_of(key, bits):
            yield sent(RUNS, name, base, [key[a:b], own[a:b], word[a:b], f[a:b]])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (names, *values), may = shared.value
        hot_place = places_by_first_bits(names)
        row = base = TaskContext.get().partitionId() << 33
        cold, heads, waiting = [], [], 0
        for batch in chain.from_iterable(pieces_of(b, 256, PIECE_BYTES) for b in batches):
            stream, since, sizes = streams([t or b"" for t in batch.column(1).to_pylist()])
            n = len(sizes)
            owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
            last = np.zeros(len(stream) - 1, bool)
            last[np.cumsum(sizes) - 1] = True
            sums = [np.zeros(n) for _ in values]
            for order_, run in enumerate(run_keys(stream, DEPTH + 1), 1):
                # the end as a run of one symbol is the same for all texts
                at = np.flatnonzero(~last if order_ == 1 else since[1:] >= order_ - 1)
                key, own = run[1:][at], owner[at]
                place = hot_place(key)
                here = np.flatnonzero(place >= 0)
                place, of = place[here], own[here]
                # x and k are of words alone
                for total, v in zip(sums, values) if order_ == 1 else [(sums[1], values[1])]:
                    total += np.bincount(of, v[place], n)
                rest = np.ones(len(key), bool)
                rest[here] = False
                rest = np.flatnonzero(rest)
                rest = rest if order_ == 1 else rest[may(key[rest])]
                cold.append((own[rest] + (row - base), key[rest], np.full(len(rest), order_ == 1)))
                waiting += len(rest)
            ids = batch.column(0)
            heads.append((
                np.arange(row, row + n).astype(U64), ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8), ids.fill_null(0).to_numpy(),
                sizes - 1, sums[0], sums[1], np.rint(sums[2]).astype(np.int64),
            ))
            row += n
            if waiting > KEYS_PER_TASK:
                yield from blocks(base, cold, heads)
                cold, heads, waiting, base = [], [], 0, row
        if heads:
            yield from blocks(base, cold, heads)

    return texts.select("doc_id", "text").mapInArrow(split, SPLIT)


def as_sums(sent: pa.Table, i: int) -> pa.RecordBatch:
    """The rows of a block of heads."""
    first, there, ids, *more = (unpacked(sent.column(f"c{j}")[i].as_py(), t) for j, t in enumerate(OF_HEADS))
    names = [c.split()[0] for c in SUMS.split(", ")]
    return pa.record_batch([signed(np.cumsum(first, dtype=U64)), pa.array(ids, mask=there == 0), *map(pa.array, more)], names=names)


def summed_by_row(parts: list[pa.RecordBatch]) -> pa.Table:
    kinds = [(c.split()[0], pa.float64() if c.endswith("double") else pa.int64()) for c in SUMS.split(", ")]
    names = [c for c, _ in kinds]
    table = pa.Table.from_batches(parts, pa.schema(kinds)).group_by("row").aggregate([("doc_id", "max"), *((c, "sum") for c in names[2:])])
    return table.select(["row", "doc_id_max", *(f"{c}_sum" for c in names[2:])]).rename_columns(names)


def looked_up(split: DataFrame, valued: DataFrame, bits: int, word_x: float, word_y: float) -> DataFrame:
    """(row, doc_id, n_words, x, y, k): the heads of ``split`` with what the blocks add to each text, by the values of ``valued``; words without a value have the two given.

    The blocks of a range meet the values of that range, one by one, and are never open together.
    """

    def look_up(values: pa.Table, sent: pa.Table) -> pa.Table:
        keys = values.column("key").to_numpy().view(U64)
        order = np.argsort(keys)
        keys, (x, y, k) = keys[order], (values.column(c).to_numpy()[order] for c in "xyk")
        out = []
        for i, (kind, base) in enumerate(zip(sent.column("kind").to_pylist(), sent.column("row").to_pylist())):
            if kind == HEADS:
                out.append(as_sums(sent, i))
                continue
            first, *rest = (unpacked(sent.column(f"c{j}")[i].as_py(), t) for j, t in enumerate(OF_RUNS))
            first = np.cumsum(first, dtype=U64)
            own, word, f = rest
            at, here = found(keys, first)
            of = lambda v, other: np.where(here, v[at] if len(v) else 0, other) * f
            all_rows = np.bincount(own)
            rows = np.flatnonzero(all_rows)
            sums = [np.bincount(own, of(v, other), len(all_rows))[rows] for v, other in ((x, word * word_x), (y, word * word_y), (k, 0))]
            n = len(rows)
            columns = [pa.array(rows + base), pa.nulls(n, pa.int64()), pa.array(np.zeros(n, np.int64)), *map(pa.array, sums[:2]), pa.array(np.rint(sums[2]).astype(np.int64))]
            out.append(pa.record_batch(columns, names=[c.split()[0] for c in SUMS.split(", ")]))
        # a text has many blocks' sums in a range, and one in what is sent on
        table = summed_by_row(out).sort_by("row")
        row, ids = table.column("row").to_numpy(), table.column("doc_id")
        columns = [row.view(U64), ids.is_valid().to_numpy().astype(np.uint8), ids.fill_null(0).to_numpy(), *(table.column(c).to_numpy() for c in ("n_words", "x", "y", "k"))]
        first = np.flatnonzero(np.diff(row >> ROW_BITS, prepend=-1)).tolist()
        cells = []
        for lo, hi in zip(first, [*first[1:], len(row)]):
            head, *rest = (c[lo:hi] for c in columns)
            cells.append((HEADS, int(row[lo]) >> ROW_BITS, int(row[lo]), packed(np.diff(head, prepend=U64(0))), *map(packed, rest)))
        kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * len(OF_HEADS)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*cells) if cells else [()] * len(kinds), kinds)], names=[c.split()[0] for c in SPLIT.split(", ")])

    def add_up(sent: pa.Table) -> pa.Table:
        return summed_by_row([as_sums(sent, i) for i in range(sent.num_rows)])

    name = F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long")
    left = valued.select(name.alias("range"), "key", "x", "y", "k").groupBy("range")
    parts = left.cogroup(split.groupBy("range")).applyInArrow(look_up, SPLIT)
    return parts.groupBy("range").applyInArrow(add_up, SUMS)


@contextmanager
def small_batches(spark: SparkSession):
    """Meanwhile rows go to Python in batches of ``ROWS_TO_PYTHON``, as batches of long texts take several times their size in the JVM and in Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(ROWS_TO_PYTHON))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each row of ``docs``.

    ``held_out`` is over ``doc_id``; the model and the word counts come from the other rows. The result is a written table.
    """
    with small_batches(docs.sparkSession):
        return written(scores(docs, held_out, id_col, text_col), "scores")


def scores(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    texts = id_text(docs, id_col, text_col)
    learnt = texts.filter(~F.coalesce(held_out, F.lit(False)))
    likely = int(learnt.agg(F.sum(F.octet_length("text") / BYTES_PER_SYMBOL + 1)).first()[0] or 0)
    bits = min(range_bits(likely), max(0, (KEYS_PER_TASK // KEYS_PER_BLOCK).bit_length() - 1), FILTER_BITS - 6)
    level = scanned_level(learnt, 2, bits, None, words=True)
    shape = "key long, n long, g long"
    counts = written(level.filter(F.col("kind") == WORDS).mapInArrow(rows_of(COUNTED, shape), shape).drop("g"), "word-counts")
    row = counts.agg(
        F.count("*").alias("v"), F.sum("n").alias("n"), F.sum(F.when(F.col("key") == END_KEY, F.col("n"))).alias("ends"),
        F.count_if((F.col("n") == 1) & (F.col("key") != END_KEY)).alias("n1"), F.count_if((F.col("n") == 2) & (F.col("key") != END_KEY)).alias("n2"),
    ).first()
    total, distinct, ends = row.n or 0, row.v, row.ends or 0
    below = float(np.log10(total + 0.5 * (distinct + 1)))
    off = (row.n1 + 1) / (row.n1 + 2 * row.n2 + 2)  # the discount of every count, between 0 and 1
    n = F.col("n")
    words = counts.withColumn("lp", F.log10((n - off) / max(1, total)))
    unknown = float(np.log10(off * distinct / total)) if total else float(np.log10(0.5))

    tree = grow(learnt, words, level, bits)
    runs = written(tree.values(), "run-values")
    of_end = runs.filter(F.col("key") == END_KEY).agg(F.sum("y")).first()[0] or 0.0
    root_end = float(np.log10((ends - off) / total)) if ends else unknown
    valued = words.select("key", "n", (F.log10(n + 0.5) - below).alias("x"), F.col("lp").alias("y"), F.lit(1).cast("long").alias("k"))
    valued = valued.union(runs.select("key", "n", F.lit(0.0), "y", F.lit(0).cast("long"))).filter(F.col("key") != END_KEY)
    valued = valued.groupBy("key").agg(F.max("n").alias("n"), *(F.sum(c).alias(c) for c in "xyk"))
    valued = written(valued, "values")

    bits = max(range_bits(4 * valued.count()), (total // (2 * PAIRS_PER_RANGE)).bit_length())
    hot, known = most_frequent(valued, HOT), Filter(runs)
    release(runs)  # what is looked up from here on is in the values; the words and the tree's own tables stay readable
    split = split_texts(texts, hot, known, bits)
    sums = looked_up(split, valued, bits, float(np.log10(0.5)) - below, unknown)
    return sums.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("k") + (1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("x") + float(np.log10(ends + 0.5)) - below).alias("base_score"),
        (F.col("y") + root_end + of_end).alias("score"),
    )
