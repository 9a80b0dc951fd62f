"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

A file holds whole documents in ascending order of their ids, and files follow each other in
that order. Its layout, little-endian throughout:

    magic        8 bytes  FFTOKEN1
    counts       3 x u32  documents, values, ranks
    ranks        u32 each: the token id of each rank; rank 0 is the file's most frequent id
    present      u8 each: 0 for a document without an id
    document ids i64 each
    lengths      u32 each: ids of the document, end id included
    control      u8 for each four values: two bits each, the value's bytes less one
    data         1 to 4 bytes for each value, which is a rank
    before       u64: ids in the earlier files of the same task

Each file ranks its own ids, so one pass over the texts is enough, and each is read alone. Where a file's ids
begin among all follows from ``before`` and the totals of the tasks that wrote the files before it.
Values are decoded by a table that gives the four lengths of each control byte.

* Null and empty texts are the end id alone; rows without an id come first; rows that repeat an
  id are documents of their own, ordered by their text. An empty table gives no files and an empty result.
* A task writes its file under a name of its own and renames it, so that one that runs again
  puts the same file in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import PIECE_BYTES, pieces_of, written
from footfall.session import work_path

MAGIC = b"FFTOKEN1"
#: A file is closed once it has this many ids; a reading task holds one file at a time.
VALUES_PER_FILE = 8_000_000
#: Values that are coded at a time, a multiple of four.
STEP = 1 << 20
#: A file's number is that of the task that wrote it, and below that its place among the task's files.
PART_BITS = 24
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.tobytes(), data.tobytes()


def decode_values(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    size = LENGTHS[control].reshape(-1)[:n]
    end = np.cumsum(size, dtype=np.int64)
    start = end - size
    values = data[start].astype(np.uint32)
    for byte in (1, 2, 3):
        more = np.flatnonzero(size > byte)
        values[more] |= data[start[more] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return values


def file_bytes(doc_ids: list[int | None], ids: list[np.ndarray], before: int = 0) -> bytes:
    flat = np.concatenate(ids)
    counts = sum(np.bincount(flat[i : i + STEP], minlength=int(flat.max()) + 1) for i in range(0, len(flat), STEP))
    ranked = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    rank = np.zeros(len(counts), np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
    coded = [encode_values(rank[flat[i : i + STEP]]) for i in range(0, len(flat), STEP)]
    return b"".join([
        MAGIC, np.array([len(ids), len(flat), len(ranked)], "<u4").tobytes(), ranked.astype("<u4").tobytes(),
        bytes(i is not None for i in doc_ids), np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
        np.array([len(x) for x in ids], "<u4").tobytes(), *(c for c, _ in coded), *(d for _, d in coded),
        before.to_bytes(8, "little"),
    ])


def read_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their lengths, and all ids in a row as unsigned 32-bit values."""
    if content[:8] != MAGIC:
        raise ValueError("not a token file")
    docs, n, ranks = np.frombuffer(content, "<u4", 3, 8).tolist()
    at = 20
    ranked = np.frombuffer(content, "<u4", ranks, at)
    at += 4 * ranks
    present = np.frombuffer(content, np.uint8, docs, at)
    at += docs
    doc_ids = np.frombuffer(content, "<i8", docs, at).tolist()
    at += 8 * docs
    lengths = np.frombuffer(content, "<u4", docs, at).astype(np.int64)
    at += 4 * docs
    control = np.frombuffer(content, np.uint8, -(-n // 4), at)
    at += len(control)
    values = decode_values(control, np.frombuffer(content, np.uint8, offset=at), n)
    return [i if p else None for i, p in zip(doc_ids, present.tolist())], lengths, ranked[values]


def put(folder: str, name: str, content: bytes) -> None:
    """Writes a file in the shared folder through Arrow's file systems; the name appears only when it is whole."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    own = f"{path}/_{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(content)
    if store.type_name != "local" and store.get_file_info(f"{path}/{name}").is_file:
        store.delete_file(f"{path}/{name}")  # of an earlier attempt, with the same bytes
    store.move(own, f"{path}/{name}")


def write_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Writes ``docs`` into ``folder``; returns the written manifest (file, docs, tokens, bytes), one row a file."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    salt = F.monotonically_increasing_id()  # parts rows that are the same in everything
    order = ["doc_id", "tie", "salt"]
    rows = rows.withColumns({"tie": F.xxhash64("text"), "salt": salt}).repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from footfall.llm.tokenizing import encoder

        own, part, files = encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []
        held = done = 0

        def close() -> pa.RecordBatch:
            content, number = file_bytes(doc_ids, ids, done), (part << PART_BITS) + files
            put(folder, f"{number:016d}.tok", content)
            return pa.record_batch([[number], [len(ids)], [held], [len(content)]], names=["file", "docs", "tokens", "bytes"])

        end = np.array([end_id], np.uint16)
        for batch in chain.from_iterable(pieces_of(b, 256, PIECE_BYTES) for b in batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, raw in zip(batch.column(0).to_pylist(), own.encode(texts)):
                doc_ids.append(doc_id)
                ids.append(np.append(np.frombuffer(raw, "<u2"), end))
                held += len(ids[-1])
                if held >= VALUES_PER_FILE:
                    yield close()
                    doc_ids, ids, held, done, files = [], [], 0, done + held, files + 1
        if ids:
            yield close()

    return written(rows.select("doc_id", "text").mapInArrow(write, "file long, docs long, tokens long, bytes long"), "token-file-manifest")


def read_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, in the files' order; ids as unsigned 32-bit values."""
    # one number for each task that wrote files
    parts = manifest.groupBy(F.shiftright("file", PART_BITS).alias("part")).agg(F.sum("tokens").alias("n"))
    totals = sorted((r.part, r.n) for r in parts.collect())
    starts = {part: start for (part, _), start in zip(totals, accumulate((n for _, n in totals), initial=0))}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                whole = content.as_buffer().to_pybytes()
                doc_ids, lengths, ids = read_file(whole)
                number = int(path.as_py().rpartition("/")[2].removesuffix(".tok"))
                begin = starts[number >> PART_BITS] + int.from_bytes(whole[-8:], "little")
                ends = np.cumsum(lengths)
                raw, cuts = ids.astype("<u4").tobytes(), (4 * np.append(0, ends)).tolist()
                for lo in range(0, len(doc_ids), 512):
                    part = slice(lo, lo + 512)
                    yield pa.record_batch([
                        pa.array(doc_ids[part], pa.int64()), pa.array(begin + (ends - lengths)[part]),
                        pa.array(lengths[part]), pa.array([raw[i:j] for i, j in zip(cuts[part], cuts[lo + 1 : lo + 513])], pa.binary()),
                    ], names=["doc_id", "start", "n_tokens", "ids"])

    schema = "doc_id long, start long, n_tokens long, ids binary"
    if not totals:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder).select("path", "content")
    return files.mapInArrow(read, schema)


def round_trip(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Writes the files and gives what they hold; see ``read_files``."""
    folder = folder or work_path(docs.sparkSession, "token-files")
    manifest = write_files(docs, folder, tokenizer, end_id)
    return read_files(docs.sparkSession, folder, manifest)
