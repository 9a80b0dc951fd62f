"""The corpus pipeline: every stage against its operator's plain version, and odd inputs."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline as cp
import public_tokenizers
from footfall.llm import queries
from .test_near_duplicates import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), [spark.read.parquet(f"{SF}/documents.parquet")]
    for i, (_, stage) in enumerate(cp.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_registered():
    names = set(entry_points.queries())
    assert {"pipeline", *queries.RUNS} <= names and len([n for n in names if n.startswith("op")]) == 13
    assert set(queries.ORACLES) == {"op1_topk_search", "op6_near_duplicates", "op12_fill_in_middle", "op13_resampling"} and "pipeline" not in entry_points.oracle_sql()


def test_columns_stay(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns


def test_filters_keep_clean_documents(spark, steps):
    good = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    clean = steps[0].join(good, "doc_id", "left_semi")
    assert steps[1].join(clean, "doc_id", "left_semi").count() >= 0.97 * clean.count()
    bad = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0")
    assert steps[1].join(bad, "doc_id", "left_semi").count() <= 2
    assert steps[2].count() >= 0.98 * steps[1].count()


def test_one_of_each_group_stays(spark, steps):
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    for percent, kept in ((80, steps[3]), (85, cp.keep_one_of_each(spark, steps[2], SF, 85))):
        assert ids(kept) == sorted({component for _, component in brute(rows, percent).values()})


def test_the_row_of_a_repeated_id_is_chosen_by_rule(spark, docs_of):
    docs = docs_of(["a b c d e f", "a b c d e f g", "x y", None, "zz", "", None], [1, 1, 2, 2, 3, 3, None])
    want = [(1, "a b c d e f g"), (2, "x y"), (3, "zz")]
    for n in (1, 3, 7):
        rows = cp.keep_one_of_each(spark, docs.repartition(n), SF).collect()
        assert sorted((r.doc_id, r.text) for r in rows if r.doc_id is not None) == want and len(rows) == 4


def test_no_test_item_is_left(spark, steps):
    plain = lambda t: f" {' '.join(''.join(c if c.isalnum() else ' ' for c in t.lower()).split())} "
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r.doc_id: plain(r.text) for r in steps[3].collect()}
    holding = {i for i, t in texts.items() if any(x in t for x in items)}
    assert holding and ids(steps[4]) == sorted(set(texts) - holding)


def test_all_that_is_left_is_packed(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: np.array(tokenizer.encode(r.text, add_special_tokens=False).ids + [1], "<u4") for r in steps[4].collect()}
    covered = dict.fromkeys(texts, 0)
    for r in steps[5].collect():
        assert r.ids_crc32 == zlib.crc32(texts[r.doc_id][r.start : r.start + r.length].tobytes())
        covered[r.doc_id] += r.length
    assert covered == {i: len(t) for i, t in texts.items()}


def test_run_is_the_stages(spark, steps):
    assert cp.run(spark, SF).select("doc_id", "ids_crc32").exceptAll(steps[-1].select("doc_id", "ids_crc32")).count() == 0


def test_odd_and_empty_input(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in cp.STAGES[:-1]:
            kept = stage(spark, docs, SF)
            assert kept.columns == docs.columns
            assert kept.exceptAll(docs).count() == 0
        assert cp.STAGES[-1][1](spark, docs, SF).filter("start = 0").count() == docs.count()
    named = cp.keep_one_of_each(spark, odd_docs, SF).filter("doc_id is not null")
    assert named.count() == named.select("doc_id").distinct().count()
    assert cp.keep_one_of_each(spark, odd_docs, SF).filter("doc_id is null").count() == odd_docs.filter("doc_id is null").count()
