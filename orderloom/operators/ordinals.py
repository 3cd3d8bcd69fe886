"""Ordinals of rows within a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def occurrence(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column | str],
    block: Column | None = None,
    name: str = "row_number",
) -> DataFrame:
    """Number the rows of every key from 1, in the given order.

    Without `block` this is one window per key: right when keys are known to be
    small.  A key that may be large needs `block`, an expression that never
    falls as the order rises (say `floor(line / 1000)`).  Rows are then sorted
    per (key, block), so a hot key spreads over as many tasks as it has blocks,
    and the ordinal of a block's first row comes from the block sizes, which are
    counted before any shuffle.
    """
    if block is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))

    blocked = df.withColumn("__block", block)
    sizes = blocked.groupBy(*key, "__block").agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.partitionBy(*key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(k).alias(f"__of_{k}") for k in key],
        F.col("__block").alias("__of_block"),
        F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"),
    )
    same = F.col("__block").eqNullSafe(F.col("__of_block"))
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    within = Window.partitionBy(*key, "__block").orderBy(*order)
    numbered = blocked.join(starts, same).withColumn(name, F.row_number().over(within) + F.col("__before"))
    return numbered.select(*df.columns, name)
