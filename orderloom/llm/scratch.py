"""Intermediate tables on the shared folder.

A staged table cuts lineage: it lies in the folder that `spark.checkpoint.dir`
names, so a lost executor costs a re-read and no recomputation.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

# Shuffle files of a staging job go when the job ends, as its rows are stored.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Whole texts go to Python in batches of so many bytes, which bounds a task's buffers.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = str(8 << 20)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Hold a runtime setting for a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df`, written once below the shared folder and read from there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with setting(spark, CLEANUP, "true"), setting(spark, BATCH, BATCH_BYTES):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
