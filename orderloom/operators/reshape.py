"""Renames, serialisation and child tables.  All row-local: nothing shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import is_nested, json_text, snake

PARENT_LINK = "__parentId"


def rename_snake(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case."""
    return df.toDF(*[snake(c) for c in df.columns])


def parent_link(df: DataFrame) -> DataFrame:
    """Expose the link of connection children as `parent_id`, marked as a link."""
    for linked in (PARENT_LINK, snake(PARENT_LINK)):
        if linked in df.columns:
            df = df.withColumnRenamed(linked, "parent_id").withMetadata("parent_id", {"linked": True})
    return df


def is_linked(df: DataFrame) -> bool:
    """Whether the rows are connection children, as against a child table."""
    return "parent_id" in df.columns and bool(df.schema["parent_id"].metadata.get("linked"))


def nested_to_json(df: DataFrame) -> DataFrame:
    """Turn every struct, list and map column into JSON text."""
    return df.select(
        *[
            json_text(F.col(f"`{f.name}`")).alias(f.name) if is_nested(f.dataType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def tidy(df: DataFrame) -> DataFrame:
    """The shape every output table has: snake_case, `parent_id`, JSON text for nested values."""
    return nested_to_json(parent_link(rename_snake(df)))


def flatten(df: DataFrame, fields: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Pull nested fields up: `fields` maps an output name to a dotted path."""
    kept = [F.col(c) for c in (keep or [])]
    return df.select(*kept, *[F.col(path).alias(name) for name, path in fields.items()])


def object_child(df: DataFrame, column: str, key: str = "id") -> DataFrame:
    """1:1 child table of a struct column: `parent_id` and the struct's fields."""
    present = df.where(F.col(column).isNotNull())
    return tidy(present.select(F.col(key).alias("parent_id"), f"{column}.*"))


def array_child(df: DataFrame, column: str, key: str = "id", first: Column | None = None) -> DataFrame:
    """1:n child table of a list column: `parent_id`, `row_number` from 1, and the
    element's fields, or `item` when the elements are plain values.

    `first` is the ordinal before the first element, for owners whose list is
    spread over several documents.
    """
    start = F.lit(0) if first is None else F.coalesce(first, F.lit(0))
    rows = df.select(
        F.col(key).alias("parent_id"),
        start.alias("__start"),
        F.posexplode(F.col(column)).alias("__position", "item"),
    )
    ordinal = (F.col("__start") + F.col("__position") + 1).cast("bigint").alias("row_number")
    element = rows.schema["item"].dataType
    if isinstance(element, T.StructType):
        return tidy(rows.select("parent_id", ordinal, "item.*"))
    return nested_to_json(rows.select("parent_id", ordinal, "item"))


def child_table(df: DataFrame, column: str, key: str = "id") -> DataFrame | None:
    """Child table of any nested column; None for plain columns and maps."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType):
        return object_child(df, column, key)
    if isinstance(kind, T.ArrayType):
        return array_child(df, column, key)
    return None


def non_empty(df: DataFrame, column: str) -> DataFrame:
    """Rows whose list has elements."""
    return df.where(F.size(F.col(column)) > 0)


def first_n(df: DataFrame, column: str, n: int) -> DataFrame:
    """Keep the first n elements of a nested list."""
    return df.withColumn(column, F.slice(F.col(column), 1, n))


def named_elements(df: DataFrame, column: str, names: list[str], field: str = "name") -> DataFrame:
    """Keep the elements of a list whose name is one of `names`."""
    return df.withColumn(column, F.filter(F.col(column), lambda e: e[field].isin(names)))


def drop_sections(df: DataFrame, **sections: bool) -> DataFrame:
    """Leave out the optional columns whose flag is off.  Applied before any use,
    so the scan never reads them."""
    return df.drop(*[name for name, wanted in sections.items() if not wanted])
