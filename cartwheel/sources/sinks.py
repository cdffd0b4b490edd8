"""Where streams end: console, JSON topics or files, good and bad rows, external key-value stores."""

from __future__ import annotations

import time
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from concurrent.futures import TimeoutError as FutureTimeout
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from cartwheel.config import CHECKPOINT_INTERVAL, DEFAULT_TTL_SECONDS

MAX_RETRIES = 3
RETRY_DELAY_SECONDS = 1.0
IN_FLIGHT = 100
TIMEOUT_SECONDS = 1.0


def print_sink(df: DataFrame, name: str, checkpoint: str) -> DataStreamWriter:
    return (
        df.writeStream.format("console")
        .queryName(name)
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def as_json_rows(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON object per row in ``value``, as topics and text files take it."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def topic_sink(rows: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Rows with ``value`` to a Kafka topic (needs the Kafka connector on the class path)."""
    return (
        rows.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=CHECKPOINT_INTERVAL)
    )


def file_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "json") -> DataStreamWriter:
    return (
        df.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(processingTime=CHECKPOINT_INTERVAL)
    )


def put_all(
    rows: Iterator[Row],
    connect: Callable[[], Any],
    default_ttl: int = DEFAULT_TTL_SECONDS,
    retries: int = MAX_RETRIES,
    delay: float = RETRY_DELAY_SECONDS,
) -> None:
    """``client.setex(name, ttl, value)`` per row; a failed call reconnects and tries again, then fails."""
    client = None
    try:
        for row in rows:
            ttl = default_ttl if row["ttl_seconds"] is None else row["ttl_seconds"]
            for attempt in range(retries + 1):
                try:
                    client = client or connect()
                    client.setex(row["name"], ttl, row["value"])
                    break
                except Exception:
                    _close(client)
                    client = None
                    if attempt == retries:
                        raise
                    time.sleep(delay)
    finally:
        _close(client)


def put_in_flight(
    rows: Iterator[Row],
    connect: Callable[[], Any],
    default_ttl: int = DEFAULT_TTL_SECONDS,
    retries: int = MAX_RETRIES,
    delay: float = RETRY_DELAY_SECONDS,
    in_flight: int = IN_FLIGHT,
    timeout: float = TIMEOUT_SECONDS,
) -> None:
    """As ``put_all``, with up to ``in_flight`` calls under way at a time.

    Names are dealt out to lanes, each with a connection of its own that makes one call at a time: calls of a name
    stay in their order, also when one is tried again. Rows are taken in only as calls complete, the oldest first. A
    call that takes longer than ``timeout`` counts as failed once: the lane's connection is closed, so that its
    retry goes over a new one.
    """
    lanes = [_Lane(connect, retries, delay) for _ in range(in_flight)]
    under_way: deque[tuple[_Lane, Future]] = deque()

    def complete() -> None:
        lane, call = under_way.popleft()
        try:
            call.result(timeout)
        except FutureTimeout:
            lane.drop()
            call.result((retries + 1) * (timeout + delay))

    pools = [ThreadPoolExecutor(1) for _ in lanes]
    try:
        for row in rows:
            if len(under_way) >= in_flight:
                complete()
            ttl = default_ttl if row["ttl_seconds"] is None else row["ttl_seconds"]
            number = zlib.crc32(row["name"].encode()) % in_flight
            under_way.append((lanes[number], pools[number].submit(lanes[number].put, row["name"], ttl, row["value"])))
        while under_way:
            complete()
    finally:
        for pool, lane in zip(pools, lanes):
            pool.shutdown(wait=False, cancel_futures=True)
            lane.drop()


class _Lane:
    """One connection, made when it is needed."""

    def __init__(self, connect: Callable[[], Any], retries: int, delay: float) -> None:
        self.connect, self.retries, self.delay, self.client = connect, retries, delay, None

    def put(self, name: str, ttl: int, value: str) -> None:
        for attempt in range(self.retries + 1):
            try:
                self.client = self.client or self.connect()
                self.client.setex(name, ttl, value)
                return
            except Exception:
                self.drop()
                if attempt == self.retries:
                    raise
                time.sleep(self.delay)

    def drop(self) -> None:
        client, self.client = self.client, None
        _close(client)


def _close(client: Any) -> None:
    if client is not None:
        try:
            client.close()
        except Exception:  # a broken connection cannot always be closed
            pass


def external_store_writer(connect: Callable[[], Any], put: Callable[..., None] = put_in_flight, **options: Any) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: newest value per name, then the calls of each partition."""

    def write(metrics: DataFrame, batch_id: int) -> None:
        rank = F.struct("emit_ts", "value", "ttl_seconds")
        latest = metrics.groupBy("name").agg(F.max(rank).alias("_r")).select("name", "_r.value", "_r.ttl_seconds")
        latest.foreachPartition(lambda rows: put(rows, connect, **options))

    return write
