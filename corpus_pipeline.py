"""Training-corpus pipeline: five stages over documents, each written and read again.

1. quality: the classifier is fitted to the labels of the input's folder; rejected documents go.
2. near_duplicates: one document of each group of SimHash fingerprints within 3 bits stays.
3. decontamination: documents that contain a benchmark item go.
4. mixing: sources get their target weights; documents are repeated or left out accordingly.
5. sharding: k-d tree shards of near equal bytes; adds ``shard`` and ``slot``.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but
the last return the columns of documents. ``run`` lands every stage in the shared folder, so a
lost executor repeats tasks of one stage only. Nulls, empty texts, ties, repeated rows and empty
tables are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import decontaminate, mixing, quality, sharding, simhash
from cohortflow.llm.common import land, table

SHARDS, OVERHEAD = 40, 16


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs, shingle=3, radius=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs, weights=(5, 2, 1), total_share=1.5, max_epochs=2.0, seed=42)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs, sharding.byte_size(F.col("text"), OVERHEAD), SHARDS)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: A fitted classifier and 64-bit fingerprints are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
