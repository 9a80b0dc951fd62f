"""The registered queries of this package, with SQL where SQL can give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    decontaminate, fim, language, minhash, packing, privacy, quality, resampling, ring, suffix_tree, token_counts, token_files, topk,
)
from footfall.llm.common import fold, table

RUNS = {}
ORACLES = {}
CONTEXT_LENGTH = 4096
SHARDS = 40
QUALITY_AT_LEAST = 0.3


def query(run):
    RUNS[run.__name__] = run
    return run


@query
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


ORACLES["op1_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, fold("doc_id", 5) != 0)
    score = quality.scorer(docs, model)(F.col("text"))
    return docs.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= QUALITY_AT_LEAST).cast("int")
    )


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > CONTEXT_LENGTH)


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_crc(packing.pack(table(spark, sf_dir, "documents")))


def with_crc(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_crc(token_files.round_trip(table(spark, sf_dir, "documents")))


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op6_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 5 THEN [array_to_string(t, ' ')]
    ELSE list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' ')) END) AS sh FROM w
), n AS (SELECT doc_id, len(sh) AS n FROM s),
x AS (SELECT doc_id, unnest(sh) AS g FROM s),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT c.a, c.b FROM c JOIN n na ON na.doc_id = c.a JOIN n nb ON nb.doc_id = c.b
  WHERE 100 * k >= 85 * (na.n + nb.n - k)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
), m AS (SELECT a, min(b) AS component_id FROM r GROUP BY 1)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, m.component_id, n.doc_id = m.component_id AS kept
FROM n JOIN m ON m.a = n.doc_id
"""


@query
def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"), fold("doc_id", 5) == 1)


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring.assign(table(spark, sf_dir, "documents"), SHARDS, F.col("text"))
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = language.train(docs, fold("doc_id", 4) != 2)
    found = language.classifier(docs, dictionaries)(F.col("text"))
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    rows = docs.select("doc_id", held_out.alias("held_out"), found.alias("found"))
    return rows.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.margin", "found.rejected")


@query
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(privacy.counted("base", kind).alias(f"n_{kind}") for kind in privacy.PATTERNS),
        F.sha2(privacy.listed("base"), 256).alias("base_sha256"), F.concat_ws(",", *(F.nullif(privacy.listed(a), F.lit("")) for a in ("base", "added"))).alias("spans"),
    )


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.restore(fim.fill_in_middle(table(spark, sf_dir, "documents")))
    digest = lambda c: F.sha2(c, 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output").alias("output_sha256"), digest("restored").alias("restored_sha256"))


ORACLES["op12_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
), u AS (
  SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
    CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d
), c AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (
  SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:n], '') AS suf FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


@query
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_resampling"] = r"""
WITH steps AS (
  SELECT list(list_reduce(range(0, 8), lambda c, i: xor(c >> 1, CAST(3988292384 AS BIGINT) * (c & 1)), v) ORDER BY v) AS t FROM (SELECT unnest(range(0, 256)) AS v)
), d AS (
  SELECT doc_id, text, row_number() OVER () AS nth FROM documents
), w AS (
  SELECT nth, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM d
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), k AS (
  SELECT word, xor(list_reduce(list_transform(range(1, octet_length(encode(word)) + 1),
    lambda i: CAST('0x' || hex(encode(word))[2 * i - 1:2 * i] AS BIGINT)),
    lambda c, x: xor(t[1 + (xor(c, x) & 255)], c >> 8), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) AS crc
  FROM (SELECT word FROM w UNION SELECT word FROM b), steps
), s AS (SELECT crc % 10000 AS bucket, count(*) AS n FROM w JOIN k USING (word) GROUP BY 1),
g AS (SELECT crc % 10000 AS bucket, count(*) AS n FROM b JOIN k USING (word) GROUP BY 1),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(g.n, 0) + 1) * ((SELECT count(*) FROM w) + 10000) AS DOUBLE)
    / CAST((s.n + 1) * ((SELECT count(*) FROM b) + 10000) AS DOUBLE))) AS BIGINT) AS x FROM s LEFT JOIN g USING (bucket)
), m AS (
  SELECT nth, count(*) AS n, CAST(sum(x) AS BIGINT) AS total FROM w JOIN k USING (word) JOIN gain ON gain.bucket = crc % 10000 GROUP BY 1
), r AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
    CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) AS h FROM d LEFT JOIN m USING (nth)
), z AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM r),
o AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight DESC, n_features DESC) AS place,
    (SELECT 10 * count(*) // 100 FROM z WHERE n_features >= 20) AS k FROM z
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN n_features >= 20 AND place <= k THEN CAST(place AS BIGINT) END AS rank FROM o
"""
