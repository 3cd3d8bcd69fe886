"""Mixed-entity frames: which types are there, and one frame per type."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import entity_type, snake
from .filters import STAGED_TYPE, of_entity


def entity_types(df: DataFrame, field: str = "id") -> DataFrame:
    """Distinct entity types as rows."""
    found = df.select(entity_type(F.col(field)).alias("entity_type"))
    return found.where(F.col("entity_type").isNotNull()).distinct()


def list_entity_types(df: DataFrame, field: str = "id") -> list[str]:
    """Distinct entity types on the driver: each becomes a table, so a plan there."""
    return sorted(row["entity_type"] for row in entity_types(df, field).collect())


def present_types(df: DataFrame, field: str = "id") -> set[str | None]:
    """The entity types of all rows, None among them if rows without a global id occur.
    On a staged frame this reads folder names only."""
    kind = F.col(STAGED_TYPE) if STAGED_TYPE in df.columns else entity_type(F.col(field))
    return {row["entity_type"] for row in df.select(kind.alias("entity_type")).distinct().collect()}


def prune_columns(df: DataFrame, keys: set[str] | list[str]) -> DataFrame:
    """Keep the columns whose key occurs for the entity."""
    wanted = set(keys)
    return df.select(*[c for c in df.columns if c in wanted])


def split_entities(
    df: DataFrame, keys: dict[str, list[str]] | None = None, app: str | None = None
) -> dict[str, DataFrame]:
    """One frame per entity type, named in snake_case.

    `keys` gives the types and the fields of each; without it the types are
    looked up and every frame keeps all columns.
    """
    types = list(keys) if keys else list_entity_types(df)
    frames = {}
    for kind in types:
        rows = of_entity(df, kind, app=app)
        frames[snake(kind)] = prune_columns(rows, keys[kind]) if keys else rows
    return frames


def write_split(df: DataFrame, path: str, field: str = "id", fmt: str = "parquet") -> None:
    """One folder per entity type, in one pass and without a shuffle: a type that
    holds most rows is simply written by all tasks."""
    typed = df.withColumn("entity_type", entity_type(F.col(field)))
    typed.write.mode("overwrite").partitionBy("entity_type").format(fmt).save(path)
