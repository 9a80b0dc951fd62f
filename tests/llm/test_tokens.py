"""Token counts, packing and token files against the tokenizers themselves."""

import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from footfall.llm import common, packing, token_counts, token_files, tokenizing
from footfall.llm.tokenizing import CUTS, encoder

RANDOM = st.text(st.sampled_from("abcXYZ éßñ'’.,!#$%&*|-_0123456789²½ \t\n\r\x0b\x1c\x85\xa0   　́ǅ漢字🙂▁<|endoftext|>"), max_size=60)


def plain(name, text):
    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", sorted(CUTS))
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(RANDOM, max_size=4))
def test_ids_equal_the_library(name, texts):
    got = [np.frombuffer(x, "<u2").tolist() for x in encoder(name).encode(texts)]
    assert got == [x.ids for x in encoder(name).tokenizer.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(text=RANDOM)
def test_pre_tokens_add_up(text):
    model = token_counts.model("piece_bpe_32k.model")
    parts = token_counts.pre_tokens(text.encode())
    got = sum(len(model.encode(p[1:].decode())) if len(p) > 1 else 1 for p in parts)
    assert got == len(model.encode(text))


def test_token_counts(odd_docs, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = odd_docs.collect()
    want = sorted((str(r.doc_id), len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in rows)
    got = token_counts.token_counts(odd_docs)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got.collect()) == want
    assert token_counts.token_counts(no_docs).count() == 0


def ids_of(raw):
    return np.frombuffer(bytes(raw), "<u4").tolist()


def test_packing_is_whole_and_gapless(odd_docs, no_docs):
    pieces = packing.pack(odd_docs, length=64)
    rows = sorted(pieces.collect(), key=lambda r: (r.sequence_id, r.offset))
    sequences = {}
    for r in rows:
        assert r.offset == len(sequences.setdefault(r.sequence_id, []))
        sequences[r.sequence_id] += ids_of(r.ids)
    assert sorted(sequences) == list(range(len(sequences)))
    assert all(len(s) == 64 for s in list(sequences.values())[:-1]) and 0 < len(sequences[len(sequences) - 1]) <= 64
    whole, current = [], []
    for r in rows:  # pieces of a document follow each other
        assert r.start == len(current)
        current += ids_of(r.ids)
        if len(current) == r.doc_tokens:
            whole.append((str(r.doc_id), current))
            current = []
    assert sorted(whole) == sorted((str(r.doc_id), plain("word_bpe_49k.json", r.text) + [1]) for r in odd_docs.collect())
    padded = {r.sequence_id: (ids_of(r.ids), r.used) for r in packing.sequences(pieces, 64).collect()}
    assert {k: v[: padded[k][1]] for k, (v, _) in padded.items()} == sequences
    assert all(len(v) == 64 for v, _ in padded.values())
    assert packing.boundary_records(pieces).count() == len(rows) - odd_docs.count()
    assert packing.pack(no_docs).count() == 0


def test_token_files_round_trip(odd_docs, no_docs, monkeypatch, tmp_path):
    monkeypatch.setattr(token_files, "VALUES_PER_FILE", 500)
    got = token_files.round_trip(odd_docs, folder=f"file://{tmp_path}/files").collect()
    assert len(list((tmp_path / "files").glob("*.tok"))) > 1
    got = sorted(got, key=lambda r: r.start)
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(ids_of(r.ids)))
        at += r.n_tokens
    want = sorted((str(r.doc_id), plain("byte_bpe_50k.json", r.text) + [2]) for r in odd_docs.collect())
    assert sorted((str(r.doc_id), ids_of(r.ids)) for r in got) == want
    assert token_files.round_trip(no_docs).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, (1 << 32) - 1), max_size=50))
def test_values_round_trip(values):
    control, data = (np.frombuffer(x, np.uint8) for x in token_files.encode_values(np.array(values, np.uint32)))
    assert len(control) == -(-len(values) // 4)
    assert token_files.decode_values(control, data, len(values)).tolist() == values


def test_file_bytes_rank_by_frequency():
    content = token_files.file_bytes([None, 7], [np.array([9, 9, 5]), np.array([70000, 9])])
    ids, lengths, values = token_files.read_file(content)
    assert (ids, lengths.tolist(), values.tolist()) == ([None, 7], [3, 2], [9, 9, 5, 70000, 9])
    assert np.frombuffer(content, "<u4", 3, 20)[0] == 9
    assert zlib.crc32(values[:3].astype("<u4").tobytes()) == zlib.crc32(np.array([9, 9, 5], "<u4").tobytes())


def test_long_texts_are_worked_on_a_few_at_a_time():
    texts = ["a " * 90_000, None, "b " * 90_000, "", "c " * 90_000, "d " * 400_000, "e"]
    for kind, of in ((pa.string(), lambda t: t), (pa.binary(), lambda t: t and t.encode())):
        batch = pa.record_batch([pa.array(range(7)), pa.array([of(t) for t in texts], kind)], names=["doc_id", "text"])
        parts = list(common.pieces_of(batch, 256, common.PIECE_BYTES))
        assert [p.num_rows for p in parts] == [2, 2, 1, 1, 1]
        assert pa.Table.from_batches(parts).combine_chunks() == pa.Table.from_batches([batch]).combine_chunks()
        assert [p.num_rows for p in common.pieces_of(batch.slice(1, 4), 2, common.PIECE_BYTES)] == [2, 2]
    assert [p.num_rows for p in common.pieces_of(batch, 3)] == [3, 3, 1]
    assert not list(common.pieces_of(batch.slice(0, 0), 256))


def test_known_pieces_take_little_memory():
    own = tokenizing.TextEncoder("word_bpe_49k.json")
    words = [" ".join(f"{a}q{b}" for b in range(400)) for a in range(250)]
    want = [np.array(own.tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in words[:3]]
    tracemalloc.start()
    try:
        assert own.encode(words[:3]) == want
        for i in range(3, 250, 10):
            own.encode(words[i : i + 10])
        assert tracemalloc.get_traced_memory()[0] < 6_000_000
    finally:
        tracemalloc.stop()
    assert own.pieces >= 100_000 and own.encode(words[:3]) == want
