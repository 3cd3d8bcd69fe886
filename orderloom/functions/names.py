"""Column and dataset names."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# --- fixed values: the two camelCase boundaries, applied in this order ------
WORD_START = "(.)([A-Z][a-z]+)"
CASE_CHANGE = "([a-z0-9])([A-Z])"
# --- end of fixed values ----------------------------------------------------


def snake(name: str) -> str:
    for boundary in (WORD_START, CASE_CHANGE):
        name = re.sub(boundary, r"\1_\2", name)
    return name.lower()


def snake_text(names: Column) -> Column:
    """`snake` over a column of names."""
    for boundary in (WORD_START, CASE_CHANGE):
        names = F.regexp_replace(names, boundary, "$1_$2")
    return F.lower(names)


def dataset_name(title: str) -> str:
    """Dataset name from a title: trimmed, lower case, blanks and dashes to `_`."""
    return re.sub("[ -]", "_", title.strip().lower())


def clean_name(names: Column) -> Column:
    """`dataset_name` over a column of titles."""
    return F.translate(F.lower(F.trim(names, F.lit(" \t\n\r\f\v"))), " -", "__")
