"""Texts against a table of patterns, each a piece of text that may occur anywhere, by an index of short pieces.

A pattern is filed under one of its pieces of up to ``WIDTH`` characters. A text has a pattern's piece if it has the
pattern, so texts and patterns meet by an equality join on pieces; the few that meet are verified. Tables of any
length stay tables, and no text is held against every pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 5


def _pieces(text: Column, width: Column | int) -> Column:
    """All pieces of a width, none if the text is shorter."""
    width = F.lit(width) if isinstance(width, int) else width
    last = F.length(text) - width + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substr(text, i, width))


def matches(texts: DataFrame, text: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """Distinct texts with each pattern row they contain, without regard to case. Empty patterns match nothing."""
    low = F.lower(F.col(pattern))
    filed = patterns.where(F.length(pattern) > 0).withColumn("_low", low)
    # the piece with the smallest hash: frequent beginnings do not all meet in one place
    pieces = F.transform(_pieces(F.col("_low"), F.least(F.length("_low"), F.lit(WIDTH))), lambda p: F.struct(F.xxhash64(p).alias("h"), p.alias("p")))
    filed = filed.withColumn("_piece", F.array_min(pieces)["p"]).withColumn("_width", F.length("_piece"))
    widths = sorted(r[0] for r in filed.select("_width").distinct().collect())  # WIDTH of them at most

    asked = texts.select(F.col(text).alias("_text")).where(F.col("_text").isNotNull()).distinct().withColumn("_of", F.lower("_text"))
    every = F.concat(F.array().cast("array<string>"), *[_pieces(F.col("_of"), w) for w in widths])
    asked = asked.select("_text", "_of", F.explode(F.array_distinct(every)).alias("_piece"))
    met = asked.join(filed, "_piece").where(F.contains(F.col("_of"), F.col("_low")))
    return met.select("_text", *patterns.columns).distinct()
