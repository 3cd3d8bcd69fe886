"""Typed manifests: one row per column of an output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import manifest_type


def manifest(
    df: DataFrame,
    name: str,
    key: Sequence[str] = (),
    incremental: bool = True,
    rows: bool = True,
) -> DataFrame:
    """Columns of an output with position, type, key flag and load type.

    With `rows`, also the number of rows and of nulls per column, from one
    aggregate over the data.
    """
    fields = df.schema.fields
    if rows:
        counts = df.agg(
            F.count(F.lit(1)).alias("__rows"),
            *[F.count(F.col(f"`{f.name}`")).alias(f"__filled_{i}") for i, f in enumerate(fields)],
        )
    else:
        counts = df.sparkSession.range(1)
    entries = []
    for i, field in enumerate(fields):
        entry = [
            F.lit(name).alias("dataset"),
            F.lit(i + 1).alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(manifest_type(field.dataType)).alias("type"),
            F.lit(field.name in key).alias("is_key"),
            F.lit(incremental).alias("incremental"),
            F.lit(True).alias("header"),
        ]
        if rows:
            nulls = F.col("__rows") - F.col(f"__filled_{i}")
            entry += [F.col("__rows").alias("rows"), nulls.alias("nulls")]
        entries.append(F.struct(*entry))
    return counts.select(F.inline(F.array(*entries)))
