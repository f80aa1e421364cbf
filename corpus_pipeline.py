"""A corpus pipeline: quality rules, near-duplicate removal, secret masking, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; its result is written as
Parquet to the shared folder and read again. All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from compoundry.llm import minmax, packing, quality, queries, secrets
from compoundry.llm.common import documents, durable


#: Hundredths of common shingles (of five words) from which documents are near copies here; op6 has a figure of its own.
NEAR = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the cascade reject go; the others stay as they are."""
    return quality.kept_rows(quality.judge(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays (of one id the text with the least hash; without
    ids likewise); rows that repeat an id and its text stay once.

    Near copies have a Jaccard similarity of NEAR hundredths or more (op6: ``minmax.PERCENT``). Documents without words are copies of nothing and all stay.
    """
    gone = minmax.linked(docs, percent=NEAR).filter("not survivor").select("doc_id", "text_hash").distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
    left = rows.join(gone, rows["_id"].eqNullSafe(gone["doc_id"]) & (rows["_hash"] == gone["text_hash"]), "left_anti")
    wordless = ~F.coalesce(F.col("_row.text"), F.lit("")).rlike(quality.WORD)
    alone = left.withColumn("_alone", F.when(wordless, F.monotonically_increasing_id()))
    return alone.dropDuplicates(["_id", "_hash", "_alone"]).select("_row.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret values are masked; texts without secrets stay as they are."""
    return secrets.masked(secrets.scan(docs, secrets.train(secrets.labelled(docs))))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, queries.tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: Tokens can't be made in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name)
    return docs
