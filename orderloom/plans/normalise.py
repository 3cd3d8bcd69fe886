"""The normaliser: one scanned export in, flat tables out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import entity_type, is_nested, snake
from ..operators.entities import present_types, prune_columns
from ..operators.filters import STAGED_TYPE, of_entity
from ..operators.inference import cast_columns, nested_text_kinds
from ..operators.reshape import child_table, tidy
from ..schemas import DATASETS
from ..session import scratch_path


def rows_of(df: DataFrame, types: Sequence[str]) -> DataFrame:
    """Rows of some entity types, without the staging column.  On a staged frame
    this reads only the folders of these types."""
    if len(types) == 1:
        return of_entity(df, types[0]).drop(STAGED_TYPE)
    kind = F.col(STAGED_TYPE) if STAGED_TYPE in df.columns else entity_type(F.col("id"))
    return df.where(kind.isin(list(types))).drop(STAGED_TYPE)


def without_type(df: DataFrame) -> DataFrame:
    """Rows without a global id."""
    kind = F.col(STAGED_TYPE) if STAGED_TYPE in df.columns else entity_type(F.col("id"))
    return df.where(kind.isNull()).drop(STAGED_TYPE)


def normalise(
    df: DataFrame,
    name: str,
    keys: dict[str, list[str]] | None = None,
    children: bool = True,
    promote: bool = False,
) -> dict[str, DataFrame]:
    """Entity tables and child tables of an export, by output name.

    `keys` holds the fields of each entity type: the contract for a fixed
    dataset, or the key scan of a custom one.  An export of one type gives one
    table under the dataset's name, with all lines; several types give one table each,
    the only type of a contract still under the dataset's name.  Every nested column also becomes a
    child table `<name>_<column>`.  No line is lost: a type that `keys` does not name
    gets a table with all columns, and lines without a global id then go to
    `<name>_rest`.  `promote` turns date and timestamp text into dates
    and timestamps, in child tables too; one job looks at all text, so the frame is
    best staged.
    """
    kinds = nested_text_kinds(df) if promote else {}
    df = cast_columns(df, {column: kind for (column, field), kind in kinds.items() if field is None})
    types, named = list(keys or ()), dict(keys or {})
    present = present_types(df) if "id" in df.columns else set()
    types += sorted(t for t in present if t is not None and t not in named)
    whole = df.drop(STAGED_TYPE)
    outputs = {}
    if len(types) > 1:
        for kind in types:
            rows = rows_of(df, [kind])
            output = name if len(named) == 1 and kind in named else snake(kind)
            output = output if output not in outputs else f"{name}_{kind}"
            outputs[output] = tidy(prune_columns(rows, named[kind]) if kind in named else rows)
        if None in present:
            outputs[f"{name}_rest"] = tidy(without_type(df))
    else:
        outputs[name] = tidy(whole)
    if children and "id" in df.columns:
        for field in whole.schema.fields:
            if not is_nested(field.dataType):
                continue
            owners = [t for t in types if keys and field.name in keys.get(t, whole.columns)]
            child = child_table(rows_of(df, owners) if len(types) > 1 and owners else whole, field.name)
            if child is not None:
                own = {snake(inner): kind for (column, inner), kind in kinds.items() if column == field.name and inner}
                outputs[f"{name}_{snake(field.name)}"] = cast_columns(child, own)
    return outputs


def contract_keys(name: str, df: DataFrame) -> dict[str, list[str]]:
    """Fields per entity of a fixed dataset, less the sections left out of `df`."""
    return {
        entity: [field for field in contract if field in df.columns] for entity, contract in DATASETS[name].items()
    }


def normalise_fixed(df: DataFrame, name: str) -> dict[str, DataFrame]:
    """Normalise a fixed dataset by its contract, and what else is in the data as it is."""
    return normalise(df, name, contract_keys(name, df))


def stage(spark: SparkSession, df: DataFrame, name: str, staged: list[str] | None = None) -> DataFrame:
    """Write a frame to the shared folder as Parquet, by entity type, and read it back.

    JSON is parsed once for all outputs, each output reads only its columns and
    the folders of its entities, and a lost executor costs a re-read, not a
    re-parse.  The write has no shuffle.  The folder is added to `staged`.
    """
    path = scratch_path(spark, f"stage-{name}")
    if staged is not None:
        staged.append(path)
    if "id" not in df.columns:
        df.write.parquet(path)
        return spark.read.parquet(path)
    if STAGED_TYPE not in df.columns:
        df = df.withColumn(STAGED_TYPE, entity_type(F.col("id")))
    df.write.partitionBy(STAGED_TYPE).parquet(path)
    # The schema is known; an export without rows leaves no file to read it from.
    return spark.read.schema(df.schema).parquet(path)
