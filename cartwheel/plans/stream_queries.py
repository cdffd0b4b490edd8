"""The registered stream queries: the events table read as a stream until its end.

Results are what the watermark had passed when the input ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import WATERMARK_DELAY
from cartwheel.operators import branches
from cartwheel.operators.repeats import without_repeats
from cartwheel.plans.pipeline import located
from cartwheel.plans.queries import EMIT, GAP, GRID_KEYS, WINDOWS, places, shop_with_address, table
from cartwheel.plans.session import prepare_streaming
from cartwheel.sources.events import with_event_time
from cartwheel.sources.table_events import shop_events_from_table
from cartwheel.sources.workspace import new_folder
from cartwheel.streaming import native, open_sessions, panes, stateful


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return with_event_time(shop_events_from_table(files), delay=WATERMARK_DELAY)


def finish(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Run to the end of the input into files, and read those; again in the same folder it goes on from there."""
    spark = df.sparkSession
    folder = folder or new_folder(spark, name)
    query = (
        df.writeStream.format("parquet")
        .queryName(folder)
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


def all_sizes(spark: SparkSession, sf: str, features: Callable[..., DataFrame], name: str) -> DataFrame:
    """One query holds all window sizes, as in the job."""
    return finish(features(events_stream(spark, sf), WINDOWS), name)


def stream_cart(spark, sf):
    return all_sizes(spark, sf, panes.cart_features, "stream_cart").withColumn("cart_value", F.round("cart_value", 6))


def stream_product(spark, sf):
    out = all_sizes(spark, sf, panes.product_features, "stream_product")
    viewed = F.coalesce(F.aggregate(F.map_values("views"), F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).alias("view_count")
    return out.select(*GRID_KEYS, "unique_product_count", F.round("average_price", 6).alias("average_price"), "min_price", "max_price", F.size("views").alias("viewed"), viewed)


def stream_category(spark, sf):
    out = all_sizes(spark, sf, panes.category_features, "stream_category")
    return out.select(*GRID_KEYS, "unique_category_count", "most_viewed_category", F.size("views").alias("viewed"))


def stream_purchase(spark, sf):
    return all_sizes(spark, sf, panes.purchase_features, "stream_purchase").withColumn("order_value", F.round("order_value", 6))


def stream_sessions_metrics(spark, sf):
    """Sessions while they are open and at their close, with what all eight metrics need."""
    out = finish(open_sessions.session_features(events_stream(spark, sf), GAP, EMIT), "stream_sessions_metrics")
    devices = F.array_join("device_types", ",").alias("devices")
    return out.select(
        "session_id", "session_start", "as_of", "closed", "user_id", "page_views", "searches", "product_views", "cart_adds", "campaign", devices, "latest_platform", "duration_ms", "bounce", "cart_ratio"
    )


def stream_session_locations(spark, sf):
    """Regions and their changes, of sessions while they are open and at their close."""
    events = located(shop_with_address(events_stream(spark, sf)), places(spark, sf))
    out = finish(open_sessions.session_features(events, GAP, EMIT), "stream_session_locations")
    seen = out.where("shopper_locations IS NOT NULL")
    return seen.select("session_id", "as_of", "closed", F.array_join("shopper_locations", ",").alias("shopper_locations"), "shopper_region_changes")


def stream_late_rows(spark, sf):
    """A third of the events at a time, by their numbers: what then comes behind the watermark, and what no window takes."""
    events = shop_events_from_table(table(spark, sf, "events"))
    folder, work = new_folder(spark, "late_events"), new_folder(spark, "stream_late_rows")
    third = F.pmod(F.col("event_id").cast("long"), F.lit(3))
    for part in range(3):
        events.where(third == part).write.mode("append").parquet(folder)
        arriving = with_event_time(spark.readStream.schema(events.schema).parquet(folder), delay=WATERMARK_DELAY)
        out = finish(panes.late_rows(arriving, WINDOWS), "stream_late_rows", work)
    return out


def stream_deduplicated(spark, sf):
    """The events, then a third of them again with a fifth of their ids used for another event, as a stream in two runs."""
    events = shop_events_from_table(table(spark, sf, "events"))
    number = F.col("event_id").cast("long")
    other = events.where(number % 5 == 0).withColumn("page_url", F.lit("/other"))
    folder, work = new_folder(spark, "sent_events"), new_folder(spark, "stream_deduplicated")
    for sent in (events, events.where(number % 3 == 0).unionByName(other)):
        sent.write.mode("append").parquet(folder)
        out = finish(without_repeats(spark.readStream.schema(events.schema).parquet(folder)), "stream_deduplicated", work)
    return out.select("event_id", "event_type", "user_id", "ts", "page_url")


def stream_sessions(spark, sf):
    out = finish(native.session_stream(events_stream(spark, sf), GAP), "stream_sessions")
    devices = F.array_join("device_types", ",").alias("devices")
    return out.select(
        "session_id", "session_start", "last_ts", "user_id", "page_views", "searches", "product_views", "cart_adds", "campaign", devices, "latest_platform", "bounce", "cart_ratio"
    )


def stream_cart_exact(spark, sf):
    """With the zero row after each stretch, from the timer-driven operator."""
    carts = branches.cart_events(events_stream(spark, sf))
    out = stateful.rolling_stream(carts, "user_id", WINDOWS, stateful.cart_counts, stateful.CART_COUNTS_DDL)
    return finish(out, "stream_cart_exact")


def stream_sessions_running(spark, sf):
    rows = branches.session_events(events_stream(spark, sf))
    out = stateful.session_stream_running(rows, "session_id", GAP, EMIT, stateful.session_counts, stateful.SESSION_COUNTS_DDL)
    return finish(out, "stream_sessions_running").select("session_id", "as_of", "closed", "page_views", "product_views", "cart_adds")


STREAM: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: lambda spark, sf, f=f: f(prepare_streaming(spark), sf)
    for f in (
        stream_cart,
        stream_product,
        stream_category,
        stream_purchase,
        stream_sessions,
        stream_sessions_metrics,
        stream_session_locations,
        stream_late_rows,
        stream_deduplicated,
        stream_cart_exact,
        stream_sessions_running,
    )
}
