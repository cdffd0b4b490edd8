"""Shop events from a plain event table (event_id, ts, user_id, event_type, value, props)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel import schema


def shop_events_from_table(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    event_id, text_k = F.col("event_id"), F.col("_k").cast("string")
    source = F.col("event_type")
    kind = (
        F.when(
            source == "view",
            F.when(event_id % 3 == 0, schema.LIST_VIEW).otherwise(schema.PRODUCT_VIEW),
        )
        .when(source == "click", schema.ADD)
        .when(source == "error", schema.REMOVE)
        .when(source == "purchase", schema.CHECKOUT)
        .when(source == "signup", schema.PAGE_VIEW)
    )
    k_ = F.col("_k")
    is_kind = lambda *kinds: F.col("kind").isin(*kinds)
    in_cart = is_kind(schema.ADD, schema.REMOVE)
    viewed = is_kind(schema.PRODUCT_VIEW, schema.LIST_VIEW)
    device = F.when(k_ % 3 == 0, "Desktop").when(k_ % 3 == 1, "Phone").otherwise("Tablet")
    none = F.lit(None).cast("string")
    marketing = F.when(
        k_ % 5 == 0,
        F.struct(
            F.concat(F.lit("camp"), (k_ % 10).cast("string")).alias("campaign"),
            *[F.lit("").alias(n) for n in ("source", "medium", "term", "content")],
        ),
    )
    return events.select("*", k.alias("_k"), kind.alias("kind")).select(
        event_id.cast("string").alias("event_id"),
        F.col("kind").alias("event_type"),
        F.col("user_id").cast("string").alias("session_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("props").alias("payload"),
        F.struct(device.alias("platform"), none.alias("type")).alias("user_agent"),
        F.struct(
            F.when(k_ % 2 == 0, "web").otherwise("mob").alias("platform"),
            marketing.alias("marketing"),
            F.struct(none.alias("ip_address")).alias("user"),
        ).alias("enrichment"),
        F.when(is_kind(schema.PRODUCT_VIEW), F.concat(F.lit("p"), (k_ % 20).cast("string"))).alias(
            "product_id"
        ),
        F.when(is_kind(schema.PRODUCT_VIEW), F.col("value")).alias("product_price"),
        F.when(
            viewed,
            F.when(is_kind(schema.LIST_VIEW) & (k_ % 10 == 0), "").otherwise(
                F.concat(F.lit("c"), (k_ % 7).cast("string"))
            ),
        ).alias("category"),
        F.when(in_cart, F.round(F.col("value") * (1 + k_ % 5), 2)).alias("cart_total"),
        F.when(in_cart, F.col("value")).alias("cart_price"),
        F.when(is_kind(schema.CHECKOUT), F.when(k_ % 2 == 0, 2).otherwise(1)).alias("step"),
        F.when(
            is_kind(schema.PAGE_VIEW),
            F.when(k_ % 4 == 0, F.concat(F.lit("/search?q="), text_k)).otherwise("/home"),
        ).alias("page_url"),
    )
