"""JSON text, lists and manifest types."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def json_text(value: Column) -> Column:
    """Nested value as JSON text; null fields are kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def json_path(text: Column, path: str) -> Column:
    """Text at a path such as `$.node.variant.id`."""
    return F.get_json_object(text, path)


def join_list(items: Column, separator: str = ",") -> Column:
    """List to text; null stays null."""
    return F.when(items.isNotNull(), F.array_join(items, separator))


def split_list(text: Column, separator: str = ",") -> Column:
    """Separated text to a list of trimmed, non-empty parts."""
    parts = F.transform(F.split(text, f"\\Q{separator}\\E"), lambda part: F.trim(part))
    return F.filter(parts, lambda part: part != "")


def is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType))


def manifest_type(kind: T.DataType) -> str:
    """Type name written to a manifest."""
    if isinstance(kind, T.IntegralType):
        return "INTEGER"
    if isinstance(kind, T.DecimalType):
        return "INTEGER" if kind.scale == 0 else "NUMERIC"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "FLOAT"
    if isinstance(kind, T.BooleanType):
        return "BOOLEAN"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(kind, T.DateType):
        return "DATE"
    return "STRING"
