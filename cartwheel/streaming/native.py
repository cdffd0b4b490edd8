"""Rolling and session features on streams with Spark's own windows, in append mode.

``events`` are canonical events with a watermark. Two levels: panes first (combined before the shuffle, so a
hot user sends one row per pane and task), then sliding windows over the panes. Results equal the batch grid
for every emit time the watermark has passed. Rows later than the watermark are dropped by these operators;
``numRowsDroppedByWatermark`` in the query progress counts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel import schema
from cartwheel.config import RollingWindow
from cartwheel.functions.timeline import MICROS, common_step, floor_to, micros, position
from cartwheel.functions.useragent import DEVICE_CLASSES
from cartwheel.operators import branches
from cartwheel.operators.branches import updated_total
from cartwheel.operators.rolling import MONEY
from cartwheel.plans.event_features import average_order
from cartwheel.plans.grid_features import summarise_categories, summarise_products
from cartwheel.plans.session_features import COUNTS, count_conditions, derive
from cartwheel.streaming.stateful import pair_orders_stream


def _pane(w: RollingWindow) -> int:
    return common_step([w.duration_seconds, w.emit_seconds])


def _panes(ts: str, w: RollingWindow) -> Column:
    return F.window(ts, f"{_pane(w)} seconds").alias("pane")


def _in_windows(panes: DataFrame, w: RollingWindow, empty_rows: bool) -> DataFrame:
    """Each pane in the windows ``w`` that ask for it, and whether it is ``inside``.

    With ``empty_rows`` windows reach one emit interval further back: where all panes are in that part, the
    rolling window has just emptied, and gets one row of zeros.
    """
    reach = w.duration_seconds + (w.emit_seconds if empty_rows else 0)
    kept = panes.withColumn("w", F.window(F.window_time("pane"), f"{reach} seconds", f"{w.emit_seconds} seconds"))
    start = F.unix_micros(F.window_time("w")) + 1 - w.duration_seconds * MICROS
    return kept.withColumn("inside", F.unix_micros(F.window_time("pane")) >= start)


def _inside(column: str) -> Column:
    return F.when(F.col("inside"), F.col(column))


def _named(df: DataFrame, w: RollingWindow, *columns: str | Column) -> DataFrame:
    return df.select("user_id", F.col("w.end").alias("emit_ts"), F.lit(w.label).alias("window_size"), *columns)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def cart_stream(events: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = False) -> DataFrame:
    carts = branches.cart_events(events)
    value = updated_total("event_type", "previous_price", "product_price").alias("cart_value")

    def one(w: RollingWindow) -> DataFrame:
        panes = carts.groupBy("user_id", _panes("ts", w)).agg(
            F.count_if(F.col("event_type") == schema.ADD).alias("adds"),
            F.count_if(F.col("event_type") == schema.REMOVE).alias("removes"),
            F.max(F.struct("ts", "event_id", value)).alias("newest"),
        )
        rolled = _in_windows(panes, w, empty_rows).groupBy("user_id", "w").agg(
            F.coalesce(F.sum(_inside("adds")), F.lit(0)).alias("adds"),
            F.coalesce(F.sum(_inside("removes")), F.lit(0)).alias("removes"),
            F.max(_inside("newest")).alias("newest"),
        )
        total = (F.col("adds") + F.col("removes")).alias("update_frequency")
        return _named(rolled, w, "adds", "removes", total, F.col("newest.cart_value").alias("cart_value"))

    return _union([one(w) for w in windows])


def product_stream(events: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = False) -> DataFrame:
    views = branches.product_views(events)
    price = F.col("product_price")

    def one(w: RollingWindow) -> DataFrame:
        panes = views.groupBy("user_id", "product_id", _panes("ts", w)).agg(
            F.count("*").alias("n"),
            F.min(F.struct("ts", "event_id", price)).alias("first"),
            F.min(price).alias("low"),
            F.max(price).alias("high"),
        )
        items = _in_windows(panes, w, empty_rows).groupBy("user_id", "product_id", "w").agg(
            F.sum(_inside("n")).alias("n"),
            F.min(_inside("first"))["product_price"].cast(MONEY).alias("first_price"),
            F.min(_inside("low")).alias("low"),
            F.max(_inside("high")).alias("high"),
        )
        features = summarise_products(items.withColumn("window_size", F.lit(w.label)), "w")
        return features.select("user_id", F.col("w.end").alias("emit_ts"), *[c for c in features.columns if c not in ("user_id", "w")])

    return _union([one(w) for w in windows])


def category_stream(events: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = False) -> DataFrame:
    views = branches.keep(branches.category_views(events), F.col("category").isNotNull())

    def one(w: RollingWindow) -> DataFrame:
        panes = views.groupBy("user_id", "category", _panes("ts", w)).agg(F.count("*").alias("n"))
        items = _in_windows(panes, w, empty_rows).groupBy("user_id", "category", "w").agg(F.sum(_inside("n")).alias("n"))
        features = summarise_categories(items.withColumn("window_size", F.lit(w.label)), "w")
        return features.select("user_id", F.col("w.end").alias("emit_ts"), *[c for c in features.columns if c not in ("user_id", "w")])

    return _union([one(w) for w in windows])


def purchase_stream(events: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = False) -> DataFrame:
    """Pairing needs a user's events in order, so it runs as a stateful operator before the windows.

    One window per query: a second operator of this kind in the same query yields nothing (tried on 4.1).
    """
    (w,) = windows
    width = micros(_pane(w))
    panes = (
        pair_orders_stream(branches.purchase_events(events))
        .groupBy("user_id", floor_to(position("cart_ts"), width).alias("cart_pane"), _panes("ts", w))
        .agg(F.count("order_value").alias("n"), F.sum(F.col("order_value").cast(MONEY)).alias("total"))
    )
    # an order counts while its cart is inside
    inside = F.col("cart_pane") >= F.unix_micros(F.window_time("w")) + 1 - w.duration_seconds * MICROS
    kept = _in_windows(panes, w, empty_rows).withColumn("inside", F.coalesce(inside, F.lit(False)))
    rolled = kept.groupBy("user_id", "w").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("orders_count"),
        F.coalesce(F.sum(F.when(F.col("inside"), F.col("total"))), F.lit(0).cast(MONEY)).alias("order_total"),
    )
    return _named(
        rolled,
        w,
        "orders_count",
        F.col("order_total").cast("double").alias("order_value"),
        average_order(F.col("order_total"), F.col("orders_count")).alias("avg_order_value"),
    )


def session_stream(events: DataFrame, gap_seconds: int) -> DataFrame:
    """Closed sessions. First sightings of the known device classes are plain minima; of any other device all
    sightings in the session are kept, as its name is not known beforehand."""
    rows = branches.session_events(events)
    seen = {f"_seen_{i}": name for i, name in enumerate(DEVICE_CLASSES)}
    grouped = rows.groupBy("session_id", F.session_window("ts", f"{gap_seconds} seconds").alias("w")).agg(
        F.max("ts").alias("last_ts"),
        *[F.count_if(c).alias(n) for n, c in count_conditions().items()],
        F.max(F.struct("ts", "event_id", "user_id", "platform")).alias("newest"),
        F.min(F.when(F.col("has_marketing"), F.struct("ts", "event_id", "campaign"))).alias("marketed"),
        *[
            F.min(F.when(F.col("device") == name, F.struct("ts", "event_id", "device"))).alias(n)
            for n, name in seen.items()
        ],
        F.collect_set(F.when(F.coalesce(~F.col("device").isin(*seen.values()), F.lit(True)), F.struct("ts", "event_id", "device"))).alias("others"),
    )
    sightings = F.array_sort(F.concat(F.filter(F.array(*seen), lambda s: s.isNotNull()), "others"))
    out = grouped.select(
        "session_id",
        F.col("w.start").alias("session_start"),
        "last_ts",
        F.col("w.end").alias("close_ts"),
        F.col("newest.user_id").alias("user_id"),
        *COUNTS,
        F.col("marketed.campaign").alias("campaign"),
        F.array_distinct(F.transform(sightings, lambda s: s["device"])).alias("device_types"),
        F.col("newest.platform").alias("latest_platform"),
    )
    return derive(out, F.col("close_ts"))
