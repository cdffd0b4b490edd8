"""Text forms of metric values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_text(m: Column) -> Column:
    """``{k=v, k2=v2}``"""
    pairs = F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def list_text(a: Column) -> Column:
    """``[a, b]``"""
    return F.concat(F.lit("["), F.array_join(a, ", ", "null"), F.lit("]"))


def range_text(low: Column, high: Column) -> Column:
    return F.concat(low.cast("string"), F.lit("-"), high.cast("string"))


# how text starts that Spark reads as a double; of ranges (``1.5-2.0``) the start would do
_NUMBER_LIKE = r"(?is)^[\x00-\x20]*[+-]?(?:[0-9.](?!.*[0-9.]-)|nan|inf)"


def number_of(text: Column) -> Column:
    """Text as a double, null for other text. What cannot be one is not parsed: each failed parse costs an exception."""
    return F.when(text.rlike(_NUMBER_LIKE), text.try_cast("double"))
