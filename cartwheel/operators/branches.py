"""The five branches: which events each keeps, and the few columns it needs from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel import schema

BRANCH_TYPES = {
    "product": (schema.PRODUCT_VIEW,),
    "category": (schema.LIST_VIEW, schema.PRODUCT_VIEW),
    "cart": (schema.ADD, schema.REMOVE),
    "purchase": (schema.ADD, schema.REMOVE, schema.CHECKOUT),
    "session": (schema.PAGE_VIEW, schema.PRODUCT_VIEW, schema.ADD, schema.REMOVE),
}


def keep(events: DataFrame, condition: Column, ts: str = "ts") -> DataFrame:
    """Rows that meet a condition.

    On a stream the watermark must see every event, of whatever branch. The optimizer moves a filter below
    it unless the filter reads the event time, so there the condition is tied to it.
    """
    if events.isStreaming:
        time = F.unix_micros(ts)
        condition = time == time + F.when(condition, 0).otherwise(1)
    return events.where(condition)


def keep_types(events: DataFrame, *types: str) -> DataFrame:
    return keep(events, F.col("event_type").isin(*types))


def branch(events: DataFrame, name: str) -> DataFrame:
    return keep_types(events, *BRANCH_TYPES[name])


def _key(name: str) -> Column:
    """Keys are never null; the parser gives empty text."""
    return F.coalesce(name, F.lit("")).alias(name)


def product_views(events: DataFrame) -> DataFrame:
    return branch(events, "product").select(
        "event_id",
        _key("user_id"),
        F.coalesce("product_id", F.lit("")).alias("product_id"),
        F.coalesce("product_price", F.lit(0.0)).alias("product_price"),
        "ts",
    )


def category_views(events: DataFrame) -> DataFrame:
    return branch(events, "category").select("event_id", _key("user_id"), "category", "ts")


def cart_events(events: DataFrame) -> DataFrame:
    return branch(events, "cart").select(
        "event_id",
        _key("user_id"),
        "event_type",
        F.col("cart_total").alias("previous_price"),
        F.col("cart_price").alias("product_price"),
        "ts",
    )


def updated_total(event_type: str, total: str, price: str) -> Column:
    """Cart total once the event is applied: an add raises it, a removal lowers it."""
    change = F.when(F.col(event_type) == schema.ADD, F.col(price)).otherwise(-F.col(price))
    return F.col(total) + change


def is_completed_checkout() -> Column:
    return (F.col("event_type") == schema.CHECKOUT) & F.coalesce(
        F.col("step") == schema.COMPLETED_STEP, F.lit(False)
    )


def purchase_events(events: DataFrame) -> DataFrame:
    return branch(events, "purchase").select(
        "event_id",
        _key("user_id"),
        "event_type",
        F.coalesce("cart_total", F.lit(0.0)).alias("cart_total"),
        F.coalesce("cart_price", F.lit(0.0)).alias("cart_price"),
        is_completed_checkout().alias("completed"),
        "ts",
    )


def is_search() -> Column:
    return (F.col("event_type") == schema.PAGE_VIEW) & F.coalesce(
        F.contains(F.col("page_url"), F.lit(schema.SEARCH_MARK)), F.lit(False)
    )


def session_events(events: DataFrame) -> DataFrame:
    return branch(events, "session").select(
        "event_id",
        _key("session_id"),
        _key("user_id"),
        "event_type",
        is_search().alias("searched"),
        F.col("user_agent.platform").alias("device"),
        F.col("enrichment.platform").alias("platform"),
        F.col("enrichment.marketing").isNotNull().alias("has_marketing"),
        F.col("enrichment.marketing.campaign").alias("campaign"),
        # only where the job locates addresses
        *([] if "region" not in events.columns else ["region"]),
        "ts",
    )
