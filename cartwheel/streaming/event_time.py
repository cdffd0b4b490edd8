"""Watermarks beyond a fixed delay: moving on while a source is idle, and counting late rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.operators.branches import keep
from cartwheel.sources.events import with_event_time

IDLE_SECONDS = 3
POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


@contextmanager
def larger_watermark(spark: SparkSession) -> Iterator[None]:
    """Queries started inside take the larger of their watermarks; those started later are as before.

    A query reads the policy once, at its start, and keeps it in its checkpoint.
    """
    before = spark.conf.get(POLICY)
    spark.conf.set(POLICY, "max")
    try:
        yield
    finally:
        spark.conf.set(POLICY, before)


def with_idle_advance(events: DataFrame, delay: str = "5 seconds", idle_seconds: int = IDLE_SECONDS) -> DataFrame:
    """Events whose watermark follows the clock when nothing arrives, so that open windows still close.

    A once-a-second beat carries a second watermark, ``idle_seconds`` behind the clock; start the query inside
    ``larger_watermark``. Only for live sources: replayed history would count as late.
    """
    spark = events.sparkSession
    beats = spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(
        *[
            (F.col("timestamp") if f.name == "ts" else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in events.schema.fields
        ]
    )
    joined = with_event_time(events, delay=delay).unionByName(
        beats.withWatermark("ts", f"{idle_seconds} seconds")
    )
    return keep(joined, F.col("event_type").isNotNull())


def rows_dropped_as_late(query: StreamingQuery) -> int:
    """Rows that stateful operators dropped, over the progress reports still kept."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
