"""Feature rows to long metric rows: name, value, ttl_seconds, emit_ts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.text import list_text, map_text, range_text

def _user_metrics(branch: str) -> dict[str, Column]:
    c = F.col
    return {
        "product": {
            "product_view_count": c("unique_product_count"),
            "avg_viewed_price": c("average_price"),
            "return_view_count": map_text(c("views")),
            "price_range_viewed": range_text(c("min_price"), c("max_price")),
        },
        "category": {
            "top_category": c("most_viewed_category"),
            "unique_categories": c("unique_category_count"),
            "category_view_count": map_text(c("views")),
        },
        "cart": {
            "cart_add_count": c("adds"),
            "cart_remove_count": c("removes"),
            "cart_update_frequency": c("update_frequency"),
            "cart_value": c("cart_value"),
        },
        "purchase": {
            "orders_count": c("orders_count"),
            "order_value": c("order_value"),
            "avg_order_value": c("avg_order_value"),
        },
    }[branch]


def _session_metrics() -> dict[str, Column]:
    c = F.col
    return {
        "session_duration": c("duration_ms"),
        "session_page_count": c("page_views"),
        "session_bounce": c("bounce"),
        "session_marketing_campaign": c("campaign"),
        "session_cart_ratio": c("cart_ratio"),
        "session_search_count": c("searches"),
        "shopper_device_types": list_text(c("device_types")),
        "shopper_latest_platform": c("latest_platform"),
        **_location_metrics(),
    }


def _location_metrics() -> dict[str, Column]:
    return {"shopper_locations": list_text(F.col("shopper_locations")), "shopper_region_changes": F.col("shopper_region_changes")}


def _long(df: DataFrame, name, metrics: Mapping[str, Column], ttl: Column, emit_ts: Column) -> DataFrame:
    rows = F.explode(
        F.array(*[F.struct(name(m).alias("name"), v.cast("string").alias("value")) for m, v in metrics.items()])
    )
    out = df.select(rows.alias("_m"), ttl.cast("long").alias("ttl_seconds"), emit_ts.alias("emit_ts"))
    return out.select("_m.name", "_m.value", "ttl_seconds", "emit_ts").where(F.col("value").isNotNull())


def user_metrics(features: DataFrame, branch: str, ttl_seconds: Mapping[str, int]) -> DataFrame:
    """``user:{user}:{metric}_{size}``; ``ttl_seconds`` by size label. Null values give no row."""
    pairs = [x for label, ttl in ttl_seconds.items() for x in (F.lit(label), F.lit(ttl))]
    return _long(
        features,
        lambda m: F.concat(F.lit("user:"), "user_id", F.lit(f":{m}_"), "window_size"),
        _user_metrics(branch),
        F.element_at(F.create_map(*pairs), F.col("window_size")),
        F.col("emit_ts"),
    )


def session_metrics(sessions: DataFrame, ttl_seconds: int, emit_ts: str = "close_ts") -> DataFrame:
    """``session:{session}:{metric}``; of sessions with or without regions, or of ``session_regions`` alone."""
    metrics, places = _session_metrics(), _location_metrics()
    if "shopper_locations" not in sessions.columns:
        metrics = {m: v for m, v in metrics.items() if m not in places}
    elif "page_views" not in sessions.columns:
        metrics = places
    return _long(
        sessions,
        lambda m: F.concat(F.lit("session:"), "session_id", F.lit(f":{m}")),
        metrics,
        F.lit(ttl_seconds),
        F.col(emit_ts),
    )
