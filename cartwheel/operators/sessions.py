"""Sessions of a key: stretches of events with no gap longer than the limit.

Events of a key less than a gap apart always share a session, so they are first combined by (key, block of
one gap's width), map-side; only those block rows are put in order and stitched together. A key that holds
a third of all events costs one row per block from there on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.timeline import BLOCK, block_of, micros, position

OPS = {"sum": F.sum, "min": F.min, "max": F.max}


def session_blocks(
    df: DataFrame,
    key: str,
    ts: str,
    gap_seconds: int,
    measures: Mapping[str, tuple[str, Column]],
    split: Sequence[str] = (),
) -> DataFrame:
    """Block rows with ``session_no``; ``measures`` maps a name to (sum | min | max, column).

    ``split`` keeps further columns apart inside a block.
    """
    gap = micros(gap_seconds)
    pos = position(ts)
    blocks = df.groupBy(key, block_of(pos, gap).alias(BLOCK), *split).agg(
        F.min(pos).alias("_from"),
        F.max(pos).alias("_to"),
        *[OPS[op](c).alias(n) for n, (op, c) in measures.items()],
    )
    order = Window.partitionBy(key).orderBy("_from", *split)
    reached = F.max("_to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(reached.isNull() | (F.col("_from") - reached > gap), 1).otherwise(0)
    return (
        blocks.withColumn("_starts", starts)
        .withColumn("session_no", F.sum("_starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("_starts")
    )


def session_features(
    df: DataFrame,
    key: str,
    ts: str,
    gap_seconds: int,
    measures: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """One row per session: key, session_start, last_ts, close_ts (last + gap) and the measures."""
    blocks = session_blocks(df, key, ts, gap_seconds, measures)
    out = blocks.groupBy(key, "session_no").agg(
        F.min("_from").alias("_from"),
        F.max("_to").alias("_to"),
        *[OPS[op](n).alias(n) for n, (op, _) in measures.items()],
    )
    return out.select(
        key, *session_bounds(gap_seconds), *measures
    )


def session_bounds(gap_seconds: int) -> list[Column]:
    return [
        F.timestamp_micros("_from").alias("session_start"),
        F.timestamp_micros("_to").alias("last_ts"),
        F.timestamp_micros(F.col("_to") + micros(gap_seconds)).alias("close_ts"),
    ]


def with_session_start(
    df: DataFrame,
    key: str,
    ts: str,
    gap_seconds: int,
    measures: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Events with the start of their session (and session-wide measures), joined by (key, block).

    With it any aggregate at all can run per session: ``groupBy(key, "session_start")``.
    """
    measures = measures or {}
    blocks = session_blocks(df, key, ts, gap_seconds, measures)
    whole = Window.partitionBy(key, "session_no")
    starts = blocks.select(
        key,
        BLOCK,
        F.timestamp_micros(F.min("_from").over(whole)).alias("session_start"),
        *[OPS[op](n).over(whole).alias(n) for n, (op, _) in measures.items()],
    )
    return df.withColumn(BLOCK, block_of(position(ts), micros(gap_seconds))).join(starts, [key, BLOCK]).drop(BLOCK)
