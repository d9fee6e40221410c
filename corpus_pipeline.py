"""The corpus pipeline: quality, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns the documents that stay, with the
columns of ``documents``; the last returns the placement of every row.  ``run`` writes
each stage as Parquet to the shared scratch folder and reads it again as the next one's
input, so a lost executor costs no more than the stage at work.

Empty input passes as empty output.  Null and empty texts: scored like any other by the
quality stage, never duplicates, never contaminated, and sampled with size 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import decontam, minhash, mixing, quality, sharding
from shelfline.llm.common import staged, table

SHARDS = 24


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut.  The classifier learns from ``docs``."""
    return quality.keep_good(docs, quality.fitted(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at similarity 0.8 or more."""
    return minhash.keep_one(docs, words=5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0 to 2 times), repeats as rows."""
    return mixing.repeat_mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, shard and slot of every row of the mix."""
    rows = sharding.shard_rows(docs.select("doc_id", "source"), sharding.fleet(SHARDS))
    return sharding.with_slots(rows, docs.count(), tie=[F.col("source")]).select("doc_id", "source", "shard", "slot")


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage), ("sharding", sharding_stage)]

#: SQL cannot express the compression classifier; ``tests/llm/test_pipeline.py`` compares every stage
#: with a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return staged(STAGES[-1][1](spark, docs, sf_dir), f"stage-{STAGES[-1][0]}")
