"""Bulk exports: JSON lines with several entity types in one folder."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import entity_type, json_text
from ..operators.filters import STAGED_TYPE
from ..operators.inference import promote_types
from ..operators.lattice import join_all
from ..schemas import ddl
from ..session import scratch_path


def scan_bulk(spark: SparkSession, path: str | Sequence[str], schema: str | None = None) -> DataFrame:
    """Typed scan of JSON lines.

    With a schema the lines are read once and a line that does not fit fails the
    job.  Without one they are parsed once and staged, types are inferred from all of
    them (not a sample, so keys that first occur late are kept) and date and timestamp
    text is promoted.
    """
    if schema:
        return typed_scan(spark, path, schema)
    return promote_types(scan_inferred(spark, path)[0].drop(STAGED_TYPE))


def typed_scan(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


# Types of variants as the schema language has them.  Names in backticks are passed over.
VARIANT_TYPE = re.compile(r"`(?:[^`]|``)*`|OBJECT<")


def variant_schema(found: str) -> T.StructType:
    """The schema of variants that are objects, from its description.  Void and variant
    stay as they are, for schemas to be joined."""
    if not found.startswith("OBJECT<"):
        raise ValueError("an export holds one JSON object per line")
    text = VARIANT_TYPE.sub(lambda m: "STRUCT<" if m.group() == "OBJECT<" else m.group(), found)
    return T.StructType([]) if text == "STRUCT<>" else T.StructType.fromDDL(text)


def read_as(kind: T.DataType) -> T.DataType:
    """How an inferred type is read: text for what has no single type and for objects
    without fields, doubles for fractions."""
    if isinstance(kind, (T.NullType, T.VariantType)) or kind == T.StructType([]):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, read_as(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(read_as(kind.elementType))
    return T.DoubleType() if isinstance(kind, T.DecimalType) and kind.scale else kind


def type_text(kind: T.DataType) -> str:
    """A type in the schema language, all names quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{type_text(f.dataType)}" for f in kind.fields) + ">"
    return f"array<{type_text(kind.elementType)}>" if isinstance(kind, T.ArrayType) else kind.simpleString()


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Lines parsed once: `record`, a variant, and its entity type."""
    parsed = lines.select(F.parse_json("value").alias("record"))
    return parsed.select(entity_type(F.try_variant_get("record", "$.id", "string")).alias(STAGED_TYPE), "record")


def stage_records(spark: SparkSession, path: str | Sequence[str], staged: list[str] | None = None) -> DataFrame:
    """The lines of an export as variants on the shared folder, by entity type.  The text is
    read once and parsed once, while it is written; schema, keys and typed columns come
    from the variants.  The folder is added to `staged`."""
    stored = scratch_path(spark, "records")
    if staged is not None:
        staged.append(stored)
    records = parsed_lines(scan_lines(spark, path))
    records.write.partitionBy(STAGED_TYPE).parquet(stored)
    return spark.read.schema(records.schema).parquet(stored)


def infer_schema(records: DataFrame) -> tuple[T.StructType, dict[str, list[str]]]:
    """Schema of an export, and the keys of each entity type in it.

    One pass over the variants of `stage_records`; the types of each entity type are merged
    before the shuffle, one row per entity type comes back, and their join is the whole's.
    """
    found = records.groupBy(STAGED_TYPE).agg(F.schema_of_variant_agg("record").alias("type")).collect()
    found = [row for row in found if row["type"] != "VOID"]
    schemas = {row[STAGED_TYPE]: variant_schema(row["type"]) for row in found}
    whole = join_all(schemas[kind] for kind in sorted(schemas, key=lambda kind: kind or ""))
    fields = sorted(whole.fields, key=lambda f: f.name)
    keys = {kind: schemas[kind].names for kind in sorted(k for k in schemas if k is not None)}
    return T.StructType([T.StructField(f.name, read_as(f.dataType)) for f in fields]), keys


def typed_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The variants as columns, with their entity type."""
    if not schema.fields:
        return records.select(STAGED_TYPE)
    record = F.variant_get("record", "$", type_text(schema)).alias("record")
    return records.select(STAGED_TYPE, record).select(STAGED_TYPE, "record.*")


def scan_inferred(
    spark: SparkSession, path: str | Sequence[str], staged: list[str] | None = None
) -> tuple[DataFrame, dict[str, list[str]]]:
    """An export by inferred types, and the keys of each of its entity types.  The frame
    has the staging column of entity types."""
    records = stage_records(spark, path, staged)
    schema, keys = infer_schema(records)
    return typed_records(records, schema), keys


def scan_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Raw lines as one column `value`."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths)


def scan_by_entity(
    spark: SparkSession, path: str | Sequence[str], contracts: dict[str, dict[str, str]]
) -> dict[str, DataFrame]:
    """One typed frame per entity, for exports in which two entities give one
    field different shapes: lines are told apart first and typed afterwards."""
    lines = scan_lines(spark, path).withColumn("__entity", entity_type(F.get_json_object("value", "$.id")))
    frames = {}
    for entity, contract in contracts.items():
        parsed = F.from_json("value", ddl(contract), {"mode": "FAILFAST"})
        frames[entity] = lines.where(F.col("__entity") == entity).select(parsed.alias("r")).select("r.*")
    return frames


def entity_keys(lines: DataFrame) -> DataFrame:
    """(entity_type, key): the keys seen per entity type.  Lines without a global
    id are ignored.  The pairs are made distinct before they are shuffled."""
    typed = lines.select(entity_type(F.get_json_object("value", "$.id")).alias("entity_type"), "value")
    keys = typed.where(F.col("entity_type").isNotNull()).select(
        "entity_type", F.explode(F.json_object_keys("value")).alias("key")
    )
    return keys.distinct()


def list_entity_keys(lines: DataFrame) -> dict[str, list[str]]:
    """The same on the driver, entity type -> sorted keys: each becomes a column of a
    table.  An export whose keys are data should be read as maps, with a schema."""
    found: dict[str, list[str]] = {}
    for row in sorted(entity_keys(lines).collect()):
        found.setdefault(row["entity_type"], []).append(row["key"])
    return found


def keep_raw(spark: SparkSession, path: str | Sequence[str], target: str) -> None:
    """Copy the raw lines for later inspection."""
    scan_lines(spark, path).write.mode("overwrite").option("compression", "gzip").text(target)


def to_lines(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """Rows as JSON lines; null fields are left out unless kept."""
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select((json_text(record) if keep_nulls else F.to_json(record)).alias("value"))
