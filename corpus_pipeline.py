"""Corpus pipeline: five stages from raw documents to a training mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet in the shared folder and rereads it as the next one's
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.llm.decontaminate import keep_clean
from martflow.llm.frames import written
from martflow.llm.mixing import mixed
from martflow.llm.pii import redacted
from martflow.llm.quality import keep_good
from martflow.llm.simhash import keep_one
from martflow.sources.tables import read_table


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, and so do common lines of the
    others; n_chars follows the new text."""
    return _measured(keep_good(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that of the smallest doc_id."""
    return keep_one(docs, shingle=4, distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with the benchmark go."""
    return keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the new text."""
    return _measured(redacted(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shuffled mixture: the documents' columns, replica and shuffle_key."""
    return mixed(docs).select("doc.*", "replica", "shuffle_key")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("mixing", mixing),
]

# fingerprints (XXH64) can't be expressed in DuckDB SQL: tested by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
