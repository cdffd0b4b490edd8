"""Reading JSON values whose shape and presence matter.

SQL NULL stands for a missing field, the variant null for an explicit JSON null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed_once(**columns: Column) -> Column:
    """A generator giving one row of ``columns``.

    Filters on what is read from them stay above it; pushed below, they would parse the text again for
    every field they mention.
    """
    return F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))


def get(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def text(v: Column, path: str = "$") -> Column:
    """Text of a scalar; missing and null give SQL NULL."""
    return F.try_variant_get(v, path, "string")


def text_or_empty(v: Column, path: str = "$") -> Column:
    return F.coalesce(text(v, path), F.lit(""))


def type_of(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_text(v: Column) -> Column:
    return F.coalesce(type_of(v) == "STRING", F.lit(False))


def is_number(v: Column) -> Column:
    kind = type_of(v)
    number = (kind == "BIGINT") | (kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL")
    return F.coalesce(number, F.lit(False))


def present(v: Column) -> Column:
    """There and not null."""
    return v.isNotNull() & ~F.is_variant_null(v)


def truthy(v: Column) -> Column:
    """Neither missing, null, false, zero nor the empty string. The type matters to few texts only."""
    as_text = text(v)
    doubtful = F.coalesce(as_text.isin("", "false", "0", "-0", "0.0", "-0.0"), F.lit(False))
    return present(v) & F.when(doubtful, is_text(v) & (as_text != "")).otherwise(True)


def if_truthy(v: Column) -> Column:
    return F.when(truthy(v), v)


def number(v: Column) -> Column:
    """Numbers and numeric text; anything else that is there gives zero, missing gives SQL NULL."""
    return F.when(v.isNotNull(), F.coalesce(F.try_variant_get(v, "$", "double"), F.lit(0.0)))


def elements(v: Column) -> Column:
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.expr("cast(array() as array<variant>)"))


def empty_object() -> Column:
    return F.parse_json(F.lit("{}"))


def null_value() -> Column:
    return F.parse_json(F.lit("null"))


def object_of(**fields: Column) -> Column:
    """A variant object without its missing fields."""
    return F.parse_json(F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])))
