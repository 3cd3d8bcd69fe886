"""Row filters.  Each is a plain predicate on a column, so it reaches the scan."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import entity_type, is_entity


# Partition column of a frame that was staged by entity type.
STAGED_TYPE = "__entity"


def date_window(
    df: DataFrame,
    field: str,
    since: str | date | None = None,
    to: str | date | None = None,
    closed: bool = False,
) -> DataFrame:
    """Rows in a window of dates; either side may be open.

    Half-open by default (`since` included, `to` excluded).  `closed` includes
    the whole day `to`.  The bounds are compared with the bare column, never
    with a function of it, so that the predicate can be pushed down.
    """
    kind = df.schema[field].dataType
    as_type = kind.simpleString() if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) else "date"
    column = F.col(field)
    if since is not None:
        df = df.where(column >= F.lit(str(since)).cast("date").cast(as_type))
    if to is not None:
        end = F.lit(str(to)).cast("date")
        df = df.where(column < (F.date_add(end, 1) if closed else end).cast(as_type))
    return df


def spellings(words: list[str]) -> list[str]:
    """Each word as given, in capitals, in small letters and capitalised: literals that
    a scan can compare with the bare column."""
    return sorted({form for w in words for form in (w, w.upper(), w.lower(), w.capitalize())})


def status_in(df: DataFrame, statuses: list[str], field: str = "status") -> DataFrame:
    """Rows with one of the statuses, in any of its usual spellings; no status, no rows."""
    return df.where(F.col(field).isin(spellings(statuses)))


def of_entity(df: DataFrame, entity: str, field: str = "id", app: str | None = None) -> DataFrame:
    """Rows of one entity type, of any app unless one is given.

    A staged frame reads only the folder of the type.  Otherwise, with the app
    known, the test is a prefix, which the scan understands.
    """
    if field == "id" and STAGED_TYPE in df.columns:
        return df.where(F.col(STAGED_TYPE) == entity)
    return df.where(is_entity(F.col(field), entity, app))


def event_filter(
    df: DataFrame,
    verbs: list[str] | None = None,
    resources: list[str] | None = None,
    verb_field: str = "action",
    resource_field: str = "subject",
) -> DataFrame:
    """Events by verb and by the entity type of their resource; none given means all."""
    if verbs:
        df = df.where(F.col(verb_field).isin(spellings([v.strip() for v in verbs])))
    if resources:
        if resource_field not in df.columns:
            raise ValueError(f"a filter by resource needs the field {resource_field}")
        wanted = [r.strip().lower().replace("_", "") for r in resources]
        df = df.where(F.lower(entity_type(F.col(resource_field))).isin(wanted))
    return df


def lookup(df: DataFrame, field: str, value: object) -> DataFrame:
    """The rows whose field equals a value: one entity, or the children of one parent."""
    return df.where(F.col(field) == F.lit(value))


COMPARISONS = {
    "=": lambda column, value: column == value,
    "!=": lambda column, value: column != value,
    ">": lambda column, value: column > value,
    ">=": lambda column, value: column >= value,
    "<": lambda column, value: column < value,
    "<=": lambda column, value: column <= value,
    "in": lambda column, value: column.isin(list(value)),
    "prefix": lambda column, value: column.startswith(value),
    "contains": lambda column, value: column.contains(value),
}


def search(df: DataFrame, conditions: list[tuple[str, str, object]]) -> DataFrame:
    """Rows that meet all `(field, comparison, value)` conditions."""
    tests: list[Column] = [COMPARISONS[how](F.col(field), value) for field, how, value in conditions]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def cap(df: DataFrame, n: int | None, *order: Column | str) -> DataFrame:
    """At most n rows: the first in `order`, or any when no order is given."""
    if n is None:
        return df
    return df.orderBy(*order).limit(n) if order else df.limit(n)
