"""A training corpus from raw documents: toxic documents go, of near duplicates one
stays, documents with benchmark passages go, sources are mixed to their weights, and
what is left is cut into shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep
the columns of `documents`.  Between stages the rows are written as Parquet on the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import decontamination, mixing, sharding, simhash, toxicity
from orderloom.llm.scratch import staged

# Classifier thresholds and the mix's rows follow no SQL; the tests hold each stage
# against brute force.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose toxicity reaches their language's threshold."""
    return toxicity.clean_documents(docs, _table(spark, sf_dir, "labels"), held_out=(3, 1))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash neighbours: 3-word shingles, 3 bits."""
    return simhash.first_of_groups(docs, shingle=3, radius=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold 10 consecutive words of a benchmark item."""
    return decontamination.clean_documents(docs, _table(spark, sf_dir, "benchmark"), span=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of nearly equal bytes, with each row's shard and slot."""
    return sharding.sharded_documents(docs, shards=8)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from `documents`."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
