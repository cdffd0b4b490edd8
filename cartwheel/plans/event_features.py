"""Features as of each event: the closed window ``[T - size, T]`` with T the event's own time.

``sizes`` maps labels to seconds; all sizes of a branch share one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel import schema
from cartwheel.functions.timeline import default_block, micros, position
from cartwheel.operators.branches import updated_total
from cartwheel.operators.previous import with_previous
from cartwheel.operators.rolling import MONEY, rolling_stats

ID = ("event_id",)


def _block(sizes: Mapping[str, int]) -> int:
    return default_block(micros(s) for s in sizes.values())


def _one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("long")


def _shape(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select("user_id", "event_id", F.timestamp_micros("pos").alias("ts"), "window_size", *columns)


def product_stats(views: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    """Unique products, mean of their earliest prices, price bounds and view total."""
    block = _block(sizes)
    rows = views.select(
        "user_id", "product_id", "event_id", "product_price", position("ts").alias("pos")
    )
    rows = with_previous(rows, ["user_id", "product_id"], ["pos", "event_id", "product_price"], block)
    stats = rolling_stats(
        rows.select(
            "user_id",
            "pos",
            "event_id",
            F.col("prev.pos").alias("since"),
            F.lit(1).cast("long").alias("view_count"),
            F.lit(1).cast("long").alias("unique_product_count"),
            F.col("product_price").cast(MONEY).alias("first_prices"),
            F.col("product_price").alias("min_price"),
            F.col("product_price").alias("max_price"),
        ),
        ["user_id"],
        sizes,
        sums=["view_count"],
        firsts=["unique_product_count", "first_prices"],
        lows=["min_price"],
        highs=["max_price"],
        carry=ID,
        block=block,
    )
    mean = F.col("first_prices").cast("double") / F.col("unique_product_count")
    return _shape(
        stats, "unique_product_count", mean.alias("average_price"), "min_price", "max_price", "view_count"
    )


def category_stats(views: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    """Unique categories; rows without a category ask but do not count."""
    block = _block(sizes)
    named = F.concat(F.lit("="), "category")
    rows = views.select("user_id", F.coalesce(named, F.lit("")).alias("item"), "event_id", position("ts").alias("pos"))
    rows = with_previous(rows, ["user_id", "item"], ["pos", "event_id"], block)
    one = F.lit(1).cast("long")
    stats = rolling_stats(
        rows.select(
            "user_id",
            "pos",
            "event_id",
            F.col("prev.pos").alias("since"),
            (F.col("item") != "").alias("counted"),
            one.alias("view_count"),
            one.alias("unique_category_count"),
        ),
        ["user_id"],
        sizes,
        sums=["view_count"],
        firsts=["unique_category_count"],
        carry=ID,
        block=block,
    )
    return _shape(stats, "unique_category_count", "view_count")


def cart_stats(carts: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    stats = rolling_stats(
        carts.select(
            "user_id",
            "event_id",
            position("ts").alias("pos"),
            _one_if(F.col("event_type") == schema.ADD).alias("adds"),
            _one_if(F.col("event_type") == schema.REMOVE).alias("removes"),
        ),
        ["user_id"],
        sizes,
        sums=["adds", "removes"],
        carry=ID,
    )
    return _shape(stats, "adds", "removes", (F.col("adds") + F.col("removes")).alias("update_frequency"))


def cart_values(carts: DataFrame) -> DataFrame:
    """Cart value after each cart event: the newest cart event in any window ending there."""
    value = updated_total("event_type", "previous_price", "product_price")
    return carts.select("user_id", "event_id", "ts", value.alias("cart_value"))


def pair_orders(purchases: DataFrame, block: int) -> DataFrame:
    """Orders: completed checkouts whose last cart event was not yet used by another checkout.

    Among cart events and completed checkouts in time order, that is the case exactly when the
    checkout's predecessor is a cart event.
    """
    steps = purchases.where((F.col("event_type") != schema.CHECKOUT) | F.col("completed"))
    fields = ["pos", "event_id", "event_type", "cart_total", "cart_price"]
    rows = with_previous(
        steps.select("user_id", "event_id", "event_type", "cart_total", "cart_price", position("ts").alias("pos")),
        ["user_id"],
        fields,
        block,
    )
    paired = rows.where(
        (F.col("event_type") == schema.CHECKOUT) & (F.col("prev.event_type") != schema.CHECKOUT)
    )
    return paired.select(
        "user_id",
        F.col("event_id").alias("order_id"),
        F.col("prev.event_id").alias("cart_event_id"),
        F.col("prev.pos").alias("cart_pos"),
        F.col("pos").alias("order_pos"),
        updated_total("prev.event_type", "prev.cart_total", "prev.cart_price").alias("order_value"),
    )


def purchase_orders(purchases: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    return pair_orders(purchases, _block(sizes)).select(
        "user_id",
        "order_id",
        "cart_event_id",
        F.timestamp_micros("cart_pos").alias("cart_ts"),
        F.timestamp_micros("order_pos").alias("order_ts"),
        "order_value",
    )


def purchase_stats(purchases: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    """Orders whose cart event and checkout both lie in the window."""
    block = _block(sizes)
    orders = pair_orders(purchases, block).select(
        "user_id",
        F.col("order_pos").alias("pos"),
        F.lit(None).cast("string").alias("event_id"),
        F.col("cart_pos").alias("upto"),
        F.lit(False).alias("asked"),
        F.lit(True).alias("counted"),
        F.lit(1).cast("long").alias("orders_count"),
        F.col("order_value").cast(MONEY).alias("order_total"),
    )
    asks = purchases.select(
        "user_id",
        position("ts").alias("pos"),
        "event_id",
        position("ts").alias("upto"),
        F.lit(True).alias("asked"),
        F.lit(False).alias("counted"),
        F.lit(0).cast("long").alias("orders_count"),
        F.lit(0).cast(MONEY).alias("order_total"),
    )
    stats = rolling_stats(
        orders.unionByName(asks),
        ["user_id"],
        sizes,
        sums=["orders_count", "order_total"],
        carry=ID,
        block=block,
    )
    return _shape(
        stats,
        "orders_count",
        F.col("order_total").cast("double").alias("order_value"),
        average_order(F.col("order_total"), F.col("orders_count")).alias("avg_order_value"),
    )


def average_order(total: Column, orders: Column) -> Column:
    """Half-even. A total with at most one decimal gives one decimal, unless it is 1e7 or more."""
    mean = total.cast("double") / F.nullif(orders, F.lit(0))
    short = (total == F.round(total, 1)) & (F.abs(total) < 10_000_000)
    rounded = F.when(short, F.bround(mean, 1)).otherwise(F.bround(mean, 2))
    return F.when(orders == 0, 0.0).otherwise(rounded)
