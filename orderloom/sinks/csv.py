"""Fully quoted CSV with a header.

Two forms.  The portable form goes through the CSV writer and marks NULL with a
token; text that is the token itself is refused.  The exact form writes NULL as an
unquoted empty field and empty text as `""`, byte for byte as a quote-all exporter
does; NULL in a table of one column would be an empty line, which readers skip, and is
refused.  So what is written comes back whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.reshape import nested_to_json
from ..sources.spanning import csv_records, typed

NULL_TOKEN = "\\N"
# Never occurs in the exact form, so that the reader takes no text for NULL.
UNUSED_TOKEN = "\uffffNULL\uffff"
# Not a character.  The reader would otherwise treat NUL as an escape and drop it.
UNUSED_ESCAPE = "\uffff"


def quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def csv_line(df: DataFrame) -> Column:
    """A row as one exact CSV record; its text may contain line breaks."""
    return F.concat_ws(",", *[F.coalesce(quoted(F.col(f"`{c}`").cast("string")), F.lit("")) for c in df.columns])


def csv_lines(df: DataFrame) -> DataFrame:
    flat = nested_to_json(df)
    return flat.select(csv_line(flat).alias("value"))


def refused(df: DataFrame, bad: Callable[[Column], Column], what: str) -> DataFrame:
    """The rows; a text column with a bad value fails the job."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType) or len(df.columns) == 1:
            failed = F.raise_error(F.lit(f"this form of CSV can't hold {what}")).cast(field.dataType)
            column = F.when(bad(column.cast("string")), failed).otherwise(column).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def write_csv(df: DataFrame, path: str, exact: bool = False) -> None:
    """Write all columns; nested ones as JSON text.

    Every output file starts with the header.  The rows are written by the tasks
    that produce them, without a shuffle.
    """
    flat = nested_to_json(df)
    if exact and len(flat.columns) == 1:
        flat = refused(flat, lambda c: c.isNull(), "NULL in a table of one column")
    if not exact:
        flat = refused(flat, lambda c: c == NULL_TOKEN, f"text {NULL_TOKEN}, which stands for NULL")
        (
            flat.write.mode("overwrite")
            .options(header=True, quoteAll=True, escape='"', nullValue=NULL_TOKEN)
            .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
            .csv(path)
        )
        return
    header = ",".join('"' + c.replace('"', '""') + '"' for c in flat.columns)
    row_in_task = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    line = csv_line(flat)
    first = F.concat(F.lit(header + "\n"), line)
    lines = flat.select(F.when(row_in_task == 0, first).otherwise(line).alias("value"))
    lines.write.mode("overwrite").options(lineSep="\n", maxRecordsPerFile=0).text(path)


def read_options(exact: bool) -> dict[str, str]:
    """How values of either form are told apart."""
    return {
        "escape": '"', "emptyValue": "", "mode": "FAILFAST", "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false", "charToEscapeQuoteEscaping": UNUSED_ESCAPE,
        "nullValue": UNUSED_TOKEN if exact else NULL_TOKEN,
    }


def read_csv(spark: SparkSession, path: str, schema: str, exact: bool = False) -> DataFrame:
    """Read either form back without loss.  Records may span lines, so a file is
    read by one task; the writers above give one file per task."""
    reader = spark.read.schema(schema).options(header=True, multiLine=True, lineSep="\n", **read_options(exact))
    return reader.csv(path)


def read_csv_split(spark: SparkSession, path: str, schema: str, exact: bool = False) -> DataFrame:
    """The same of files that are too large for one task each: every split of a file is
    read by a task of its own.  The files are read twice."""
    return typed(csv_records(spark, path), F.from_csv("value", schema, {"multiLine": "true", **read_options(exact)}))
