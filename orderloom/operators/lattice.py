"""A lattice of column types, and frames brought to the join of their types.

The join of two types is the least type that both turn into without loss:

    void  <  boolean                                   <  text
    void  <  byte < short < int < long < decimal       <  text
                  (long, decimal, float) < double      <  text
    void  <  date < timestamp                          <  text
    void  <  binary                                    <  text
    structs by field, lists by element, maps by value;  anything else  <  text

So schemas can be merged in any order and grouping, as exports of different days or
parts of one export are: what comes out is what the whole would have given.  Void is the
type of a column without values.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import is_nested, json_text

# Digits that an integer type may have.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
INTEGERS = list(DIGITS)
MAX_DIGITS = 38


def digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point, of exact numbers."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (DIGITS[type(kind)], 0) if type(kind) in DIGITS else None


def join_numbers(a: T.DataType, b: T.DataType) -> T.DataType:
    if type(a) in DIGITS and type(b) in DIGITS:
        return max(a, b, key=lambda kind: DIGITS[type(kind)])
    exact = digits(a), digits(b)
    if None in exact:
        return T.DoubleType()
    whole, fraction = (max(x) for x in zip(*exact))
    return T.DecimalType(whole + fraction, fraction) if whole + fraction <= MAX_DIGITS else T.DoubleType()


def settled(kind: T.DataType) -> T.DataType:
    """The type as joins have it: nullable throughout, text for variants."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, settled(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(settled(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, settled(kind.valueType))
    return T.StringType() if isinstance(kind, T.VariantType) else kind


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that values of both turn into."""
    a, b = settled(a), settled(b)
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        kinds = {field.name: field.dataType for field in a.fields}
        for field in b.fields:
            kinds[field.name] = join_types(kinds.get(field.name, T.NullType()), field.dataType)
        return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join_types(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, join_types(a.valueType, b.valueType))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return join_numbers(a, b)
    instants = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, instants) and isinstance(b, instants):
        # A local date or time joined to an instant is one in the session's zone.
        return T.TimestampType() if T.TimestampType() in (a, b) else T.TimestampNTZType()
    return T.StringType()


def join_schemas(a: T.StructType, b: T.StructType) -> T.StructType:
    """All fields of both, each of the join of its types; those of `a` come first."""
    return join_types(a, b)


def join_all(schemas: Iterable[T.StructType]) -> T.StructType:
    return reduce(join_schemas, schemas, T.StructType([]))


def instant_text(value: Column) -> Column:
    """An instant as text, in the form that exports have: `2024-01-31T10:00:00Z`, with a
    fraction of a second if there is one.  The session's zone is UTC."""
    return F.concat(F.replace(value.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def convert(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of one type as one of a type that is above it."""
    if have == want:
        return value
    if isinstance(have, T.NullType):
        return F.lit(None).cast(want)
    if isinstance(want, T.StringType):
        if isinstance(have, T.TimestampType):
            return instant_text(value)
        return json_text(value) if is_nested(have) else value.cast("string")
    if isinstance(want, T.StructType):
        known = {field.name: field.dataType for field in have.fields}
        fields = [
            (convert(value.getField(f.name), known[f.name], f.dataType) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda element: convert(element, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        return F.transform_values(value, lambda _, held: convert(held, have.valueType, want.valueType))
    return value.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with the columns of `schema`, in its order; a column it lacks is null."""
    have = {field.name: field for field in df.schema.fields}
    columns = []
    for field in schema.fields:
        own = have.get(field.name)
        value = F.lit(None).cast(field.dataType) if own is None else convert(F.col(f"`{field.name}`"), own.dataType, field.dataType)
        columns.append(value.alias(field.name, metadata=own.metadata) if own is not None and own.metadata else value.alias(field.name))
    return df.select(*columns)


def without_values(df: DataFrame, columns: list[str]) -> set[str]:
    """Those of the columns that are null in every row.  Each is looked for alone, which ends
    at the first value found and passes over blocks of nulls by their statistics."""
    return {c for c in columns if df.where(F.col(f"`{c}`").isNotNull()).select(F.lit(1)).isEmpty()}


def evident_schemas(a: DataFrame, b: DataFrame) -> list[T.StructType]:
    """The schemas of two frames, with void for text columns without values where the other
    frame has another type: text is what a reader takes for a column it saw no value of."""
    schemas = []
    for df, other in ((a, b), (b, a)):
        kinds = {field.name: field.dataType for field in other.schema.fields}
        doubtful = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and kinds.get(f.name, f.dataType) != f.dataType]
        void = without_values(df, doubtful)
        schemas.append(T.StructType([T.StructField(f.name, T.NullType() if f.name in void else f.dataType) for f in df.schema.fields]))
    return schemas


def brought_together(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with all columns of either, each of the join of its types."""
    if dict(a.dtypes) == dict(b.dtypes):
        return a, b
    known = evident_schemas(a, b)
    joined = join_all(known)
    # What neither frame has a value of stays text.
    joined = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType) for f in joined.fields])
    void = [{f.name for f in schema.fields if isinstance(f.dataType, T.NullType)} for schema in known]
    frames = [df.select(*[F.lit(None).alias(c) if c in own else F.col(f"`{c}`") for c in df.columns]) for df, own in zip((a, b), void)]
    return conform(frames[0], joined), conform(frames[1], joined)
