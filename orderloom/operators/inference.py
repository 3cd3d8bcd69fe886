"""Promotion of text columns to dates and timestamps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .filters import STAGED_TYPE

DATE_TEXT = r"^\d{4}-\d{2}-\d{2}$"
INSTANT_TEXT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:?\d{2})?$"
# A kind's text; the first that fits is taken.
KINDS = {"date": DATE_TEXT, "timestamp": f"{DATE_TEXT}|{INSTANT_TEXT}"}


def text_values(df: DataFrame) -> dict[tuple[str, str | None], Callable]:
    """The text values of a frame: (column, None) for a text column, (column, field) for
    a text field of a struct or of a list's structs, (column, "item") for a list of
    text.  Each takes a test of a value and tells whether all values of a row pass it;
    null if there are none."""
    values: dict[tuple[str, str | None], Callable] = {}

    def single(value: Column) -> Callable:
        return lambda test: F.when(value.isNotNull(), test(value))

    def listed(items: Column, pick: Callable) -> Callable:
        return lambda test: F.when(
            F.exists(items, lambda e: pick(e).isNotNull()), F.forall(items, lambda e: pick(e).isNull() | test(pick(e)))
        )

    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.StringType):
            values[field.name, None] = single(column)
        elif isinstance(kind, T.StructType):
            for inner in kind.fields:
                if isinstance(inner.dataType, T.StringType):
                    values[field.name, inner.name] = single(column.getField(inner.name))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            for inner in kind.elementType.fields:
                if isinstance(inner.dataType, T.StringType):
                    values[field.name, inner.name] = listed(column, lambda e, name=inner.name: e.getField(name))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            values[field.name, "item"] = listed(column, lambda e: e)
    return values


def nested_text_kinds(df: DataFrame) -> dict[tuple[str, str | None], str]:
    """Which text values, in columns and one level below, are only dates, or only dates and
    timestamps, which makes them timestamps: what a column is then follows from what its
    parts are.  One aggregate over everything; a single row comes back.  Other text,
    such as times of day or amounts, stays text."""
    values = {k: v for k, v in text_values(df).items() if (k[1] or k[0]) not in ("id", "parent_id", STAGED_TYPE)}
    if not values:
        return {}
    tests = []
    for i, passes in enumerate(values.values()):
        for kind, pattern in KINDS.items():
            valid = passes(lambda text, kind=kind, pattern=pattern: text.rlike(pattern) & text.try_cast(kind).isNotNull())
            tests.append(F.bool_and(valid).alias(f"{kind}_{i}"))
    found = df.agg(*tests).first()
    kinds = {}
    for i, key in enumerate(values):
        for kind in reversed(KINDS):
            if found[f"{kind}_{i}"]:
                kinds[key] = kind
    return kinds


def text_kinds(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """Which text columns hold only dates, or only dates and timestamps."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)]
    return {name: kind for (name, _), kind in nested_text_kinds(df.select(*[F.col(f"`{n}`") for n in names])).items()}


def cast_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.select(
        *[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns]
    )


def promote_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast the text columns whose every non-null value is a date, or a date or timestamp."""
    return cast_columns(df, text_kinds(df, columns))
