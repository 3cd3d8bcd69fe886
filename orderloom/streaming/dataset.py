"""Continuous normalising of a whole dataset.

One stream reads a mixed export and lands every entity and child table of it, batch by
batch: `<target>/<table>/batch_id=<n>`.  A batch that is repeated after a failure replaces
what it wrote, in all tables.  Beside the tables, `_lines` holds which version of every
line a batch brought.  Readers take, for each line, the newest version of all batches, and
of every table the rows that came with it.  So a changed order also replaces its child
rows, fewer ones too, and a version that arrives late changes nothing.

Most lines come once, in a batch and in all.  Bare hashes of the keys tell which may have come
again; only these are compared, and other rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.loads import latest_per_key
from ..operators.reshape import PARENT_LINK
from ..plans.normalise import contract_keys, normalise, stage
from ..schemas import dataset_schema
from ..session import scratch_path
from ..sinks.outputs import remove

LINES, BATCH, LINE, NEWEST, HASH = "_lines", "batch_id", "line_", "newest_", "hash_"


def line_key(df: DataFrame) -> list[str]:
    """What tells the lines of an export apart: a linked line may hang on several owners."""
    return [c for c in ("id", PARENT_LINK) if c in df.columns]


def newest_lines(batch: DataFrame, newest: str) -> DataFrame:
    """One version of every line: the newest, of equally new ones always the same.  Lines
    without an id are no versions of each other."""
    order = [F.col(newest).desc_nulls_last(), F.to_json(F.struct("*")).desc()]
    known = latest_per_key(batch.where(F.col("id").isNotNull()), line_key(batch), order)
    return known.unionByName(batch.where(F.col("id").isNull()))


def stored(spark: SparkSession, df: DataFrame, name: str, kept: list[str] | None = None) -> DataFrame:
    """A short frame on the shared folder: joins with it are planned by its measured size."""
    path = scratch_path(spark, name)
    if kept is not None:
        kept.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_newest(spark: SparkSession, batch: DataFrame, name: str, newest: str, kept: list[str]) -> DataFrame:
    """The batch staged, one version of every line.  Lines are staged as they come; if some
    came in several versions, these are reduced and the rest is staged again with them."""
    lines = stage(spark, batch, name, kept)
    hashed = lines.withColumn(HASH, F.when(F.col("id").isNotNull(), F.xxhash64(*line_key(lines))))
    counts = hashed.where(F.col(HASH).isNotNull()).groupBy(HASH).agg(F.count(F.lit(1)).alias("n"))
    repeated = stored(spark, counts.where("n > 1").select(HASH), f"repeated-{name}", kept)
    if repeated.isEmpty():
        return lines
    once = hashed.join(repeated, HASH, "left_anti").select(*lines.columns)
    several = hashed.join(repeated, HASH, "left_semi").select(*lines.columns)
    whole = kept[0]
    lines = stage(spark, once.unionByName(newest_lines(several, newest)), name, kept)
    remove(spark, whole)
    return lines


def land_batch(spark: SparkSession, batch: DataFrame, batch_id: int, name: str, target: str, newest: str = "updatedAt") -> list[str]:
    """Land one batch of lines of a fixed dataset; gives the tables that it has rows for."""
    kept: list[str] = []
    try:
        lines = stage_newest(spark, batch, name, newest, kept)
        keys = contract_keys(name, lines)
        entities = normalise(lines, name, keys, children=False)
        tables = normalise(lines, name, keys)
        parent = F.col(PARENT_LINK) if PARENT_LINK in lines.columns else F.lit(None).cast("string")
        versions = lines.where(F.col("id").isNotNull()).select("id", parent.alias("parent_id"), F.col(newest).alias(NEWEST))
        folder = f"{BATCH}={batch_id}"
        versions.write.mode("overwrite").parquet(f"{target}/{LINES}/{folder}")
        for table, df in tables.items():
            line = F.col("id" if table in entities else "parent_id")
            df.withColumn(LINE, line).write.mode("overwrite").parquet(f"{target}/{table}/{folder}")
        for table in set(landed_tables(spark, target)) - set(tables):  # of an attempt before
            remove(spark, f"{target}/{table}/{folder}")
        return list(tables)
    finally:
        for path in kept:
            remove(spark, path)


def land_dataset(
    spark: SparkSession,
    source: str,
    name: str,
    target: str,
    checkpoint: str,
    newest: str = "updatedAt",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Land what has arrived in the folder `source` since the last time, and stop.  A line
    that does not fit the dataset's contract fails the stream."""
    reader = spark.readStream.schema(dataset_schema(name)).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def land(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch.sparkSession, batch, batch_id, name, target, newest)

    writer = reader.json(source).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def newest_versions(lines: DataFrame) -> DataFrame:
    """Of each line the version that counts, with its batch."""
    order = [F.col(NEWEST).desc_nulls_last(), F.col(BATCH).desc()]
    return latest_per_key(lines, ["id", "parent_id"], order)


def changed_lines(spark: SparkSession, target: str) -> DataFrame | None:
    """(id, parent_id, batch_id) of the ids that several batches brought, for each line the
    batch of its newest version; None if there are none."""
    lines = spark.read.parquet(f"{target}/{LINES}").withColumn(HASH, F.xxhash64("id"))
    batches = lines.groupBy(HASH).agg(F.min(BATCH).alias("first"), F.max(BATCH).alias("last"))
    several = stored(spark, batches.where("first < last").select(HASH), "several")
    if several.isEmpty():
        return None
    return stored(spark, newest_versions(lines.join(several, HASH, "left_semi")).select("id", "parent_id", BATCH), "changed")


def landed_rows(spark: SparkSession, target: str, table: str, changed: DataFrame | None) -> DataFrame:
    """A table's rows of the newest lines, with the columns it was landed with."""
    rows = spark.read.parquet(f"{target}/{table}")
    if changed is None:
        return rows
    newest = changed.select(F.col("id").alias("of_"), F.col("parent_id").alias("below_"), F.col(BATCH).alias("in_"))
    same: Column = (F.col(LINE) == F.col("of_")) & (F.col(BATCH) == F.col("in_"))
    if linked(rows):
        same = same & F.col("parent_id").eqNullSafe(F.col("below_"))
    unchanged = rows.join(newest.select("of_").distinct(), F.col(LINE) == F.col("of_"), "left_anti")
    return unchanged.unionByName(rows.join(newest, same, "left_semi"))


def linked(rows: DataFrame) -> bool:
    """Whether a table's own lines hang on others; a child table has its line's id there."""
    return "parent_id" in rows.columns and bool(rows.schema["parent_id"].metadata.get("linked"))


def read_dataset(spark: SparkSession, target: str, tables: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Landed tables as they are now, all or some.  What has changed is looked up once, at the call."""
    changed = changed_lines(spark, target)
    names = landed_tables(spark, target) if tables is None else tables
    return {table: landed_rows(spark, target, table, changed).drop(LINE, BATCH) for table in names}


def read_dataset_table(spark: SparkSession, target: str, table: str) -> DataFrame:
    """A landed table as it is now."""
    return read_dataset(spark, target, [table])[table]


def landed_tables(spark: SparkSession, target: str) -> list[str]:
    """The tables that batches have landed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(target)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    names = [status.getPath().getName() for status in found]
    return sorted(n for n in names if n != LINES)


def compact_dataset(spark: SparkSession, target: str, folded: str, tables: Sequence[str] | None = None) -> None:
    """Write what readers see to a new folder, where the stream can go on.  Rows keep their
    batch, so that a version which arrives late is still told from a new one."""
    changed = changed_lines(spark, target)
    for table in tables or landed_tables(spark, target):
        landed_rows(spark, target, table, changed).write.partitionBy(BATCH).parquet(f"{folded}/{table}")
    newest_versions(spark.read.parquet(f"{target}/{LINES}")).write.partitionBy(BATCH).parquet(f"{folded}/{LINES}")
