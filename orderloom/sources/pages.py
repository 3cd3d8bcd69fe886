"""Landed API pages and JSON array documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.filters import cap
from .spanning import json_records


def scan_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Page envelopes, one page per line: `{<key>: {pageInfo, edges}}`."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def flatten_pages(
    pages: DataFrame, key: str, max_items: int | None = None, order: list[Column | str] | None = None
) -> DataFrame:
    """The nodes of all pages.  A page without edges gives nothing."""
    nodes = pages.select(F.explode(F.col(f"`{key}`.edges")).alias("__edge")).select("__edge.node.*")
    return cap(nodes, max_items, *(order or []))


def scan_json_array(spark: SparkSession, path: str, schema: str, pretty: bool = False) -> DataFrame:
    """Records of JSON arrays.

    By default every line holds one array, which keeps files splittable.
    `pretty` reads arrays that spread over lines: one array per file, each file
    read by one task; `scan_json_split` reads large ones.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return reader.option("multiLine", pretty).json(path)


def scan_json_split(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of files that hold one list of objects each, or objects one after the other,
    over any lines.  Every split of a file is read by a task of its own, twice."""
    return json_records(spark, path, schema)


def array_records(df: DataFrame, column: str, element: str) -> DataFrame:
    """Records of a text column that holds JSON arrays; `element` is the struct type."""
    parsed = F.from_json(F.col(column), f"array<{element}>", {"mode": "FAILFAST"})
    return df.select(F.inline(parsed))
