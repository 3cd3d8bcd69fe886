"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job here relies on.  All are runtime settings, so `tune` can
# apply them to a session that somebody else created.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Tables and staged copies hold ids and names that repeat.
    "spark.sql.parquet.compression.codec": "zstd",
    # A task that writes few folders, as `stage` does, need not sort its rows by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

_folders: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(scratch: str, cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine; `scratch` takes its intermediate data."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orderloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.checkpoint.dir", scratch)
        .config("spark.ui.enabled", "false")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Hold runtime settings for a block; `__` in a name stands for a dot."""
    wanted = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def use_shared_dir(spark: SparkSession, folder: str) -> None:
    """Name the shared folder of an application that was started without one."""
    _folders[spark.sparkContext.applicationId] = folder


def has_shared_dir(spark: SparkSession) -> bool:
    return bool(spark.conf.get("spark.checkpoint.dir", None)) or spark.sparkContext.applicationId in _folders


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by `spark.checkpoint.dir` or, where
    that is unset, by `use_shared_dir`.  Local mode, which has no other executors, may
    go without either and uses its warehouse folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _folders.get(spark.sparkContext.applicationId)
    if not folder and spark.sparkContext.master.partition("[")[0] == "local":
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/orderloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application wrote below `scratch_path`."""
    folder = f"{shared_dir(spark)}/orderloom/{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
