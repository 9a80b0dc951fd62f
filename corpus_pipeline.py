"""A corpus from raw documents to packed sequences: five operators in a row.

Each stage takes the Parquet that the stage before has written and works on all of it. All but
the last return the columns of documents, whatever these are. What each stage does with odd input:

* Null and empty texts are scored as empty, are in no language and so go at the second stage.
* Rows without an id are judged each on its own; the near-duplicate stage keeps them all.
* Of rows that repeat an id one stays after the near-duplicate stage (``keep_one_of_each``), ties included.
* Very long texts are read whole by every stage and cut into as many pieces as they need.
* Columns beyond those of documents are carried along; names that operators use inside do not clash with them.
* An empty table gives empty tables at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm import decontaminate, language, minhash, packing, quality
from footfall.llm.common import fold, table
from footfall.llm.queries import QUALITY_AT_LEAST, with_crc
from footfall.session import written

#: A trained model and components of a graph are beyond SQL.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is high enough; the model learns from the labelled documents of the table."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return docs.filter(quality.scorer(docs, model)(docs["text"]) >= QUALITY_AT_LEAST)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that can be told; the dictionaries come from the table's documents."""
    dictionaries = language.train(table(spark, sf_dir, "documents"), fold("doc_id", 4) != 2)
    return docs.filter(~language.classifier(docs, dictionaries)(docs["text"])["rejected"])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str, percent: int = 80) -> DataFrame:
    """One document of each component of near copies (five-word shingles, similarity ``percent`` or more).

    Of a repeated id the row with the longest text stays, of these the one with the smallest hash of all its
    columns (rows that tie are alike); rows without an id stay.
    """
    away = minhash.near_duplicates(docs, percent).filter("not kept").select("doc_id")
    named = docs.filter(docs["doc_id"].isNotNull()).join(away, "doc_id", "left_anti")
    order = [F.octet_length("text").desc_nulls_last(), F.xxhash64(*docs.columns)]
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(*order))
    named = named.withColumn("_nth", first).filter("_nth = 1").drop("_nth")
    return docs.filter(docs["doc_id"].isNull()).unionByName(named)


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item; a row without an id is dropped if its text holds one."""
    return docs.filter(~decontaminate.marker(docs, table(spark, sf_dir, "benchmark"))(docs["text"]))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens, with the crc32 of each piece's ids."""
    return with_crc(packing.pack(docs))


STAGES = [
    ("quality classifier", keep_good),
    ("language id", keep_known_language),
    ("minhash near-dedup", keep_one_of_each),
    ("benchmark decontamination", keep_unseen),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
