"""Keys of texts and rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two hashes with different seeds, 128 bits in all: rows of equal text share them.
TEXT_KEY = ("text_key_1", "text_key_2")


def text_key(text: str | Column = "text") -> list[Column]:
    """The key columns of a text; null counts as empty."""
    whole = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return [F.xxhash64(whole).alias(TEXT_KEY[0]), F.xxhash64(F.lit(1), whole).alias(TEXT_KEY[1])]


def utf8_bytes(text: str = "text") -> Column:
    """Bytes of a text in UTF-8; null counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
