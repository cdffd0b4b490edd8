"""Reading events, from streams or tables, as rows with a JSON text column ``value``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import WATERMARK_DELAY


def topic_stream(spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A Kafka topic from its earliest offset; later starts go on from the query's checkpoint."""
    return text_value(
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**(options or {}))
        .load()
    )


def file_events(spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int | None = None) -> DataFrame:
    """Files of one JSON object per line."""
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def text_value(df: DataFrame) -> DataFrame:
    """Any source with a ``value`` column, binary or text."""
    return df.select(F.col("value").cast("string").alias("value"))


def with_event_time(df: DataFrame, ts: str = "ts", delay: str = WATERMARK_DELAY) -> DataFrame:
    """Event time with a bound on how late rows may be; session time zone must be UTC for zone-less input."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
