"""Session features of the shop: closed sessions, and the running session as of each event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel import schema
from cartwheel.functions.timeline import micros, position
from cartwheel.operators.lookups import shopper_regions
from cartwheel.operators.rolling import rolling_stats
from cartwheel.operators.sessions import OPS, session_blocks, session_bounds, with_session_start

KEY = "session_id"


def _count(condition: Column) -> tuple[str, Column]:
    return "sum", F.when(condition, 1).otherwise(0).cast("long")


def _of_type(name: str) -> Column:
    return F.col("event_type") == name


COUNTS = ("page_views", "searches", "product_views", "cart_adds")


def count_conditions() -> dict[str, Column]:
    conditions = (
        _of_type(schema.PAGE_VIEW),
        F.col("searched"),
        _of_type(schema.PRODUCT_VIEW),
        _of_type(schema.ADD),
    )
    return dict(zip(COUNTS, conditions))


def _first_marketing() -> Column:
    return F.when(F.col("has_marketing"), F.struct("ts", "event_id", "campaign"))


def shop_sessions(events: DataFrame, gap_seconds: int) -> DataFrame:
    """``events`` as given by ``branches.session_events``."""
    measures = {n: _count(c) for n, c in count_conditions().items()}
    measures["newest"] = "max", F.struct("ts", "event_id", "user_id", "platform")
    measures["marketed"] = "min", _first_marketing()
    measures["seen"] = "min", F.struct("ts", "event_id")
    blocks = session_blocks(events, KEY, "ts", gap_seconds, measures, split=["device"])
    # devices are few: one row per device and session, then one row per session
    merged = {**{n: op for n, (op, _) in measures.items()}, "_from": "min", "_to": "max"}
    per_device = blocks.groupBy(KEY, "session_no", "device").agg(*[OPS[op](n).alias(n) for n, op in merged.items()])
    devices = F.transform(F.array_sort(F.collect_list(F.struct("seen", "device"))), lambda d: d["device"])
    sessions = per_device.groupBy(KEY, "session_no").agg(
        *[OPS[op](n).alias(n) for n, op in merged.items() if n != "seen"], devices.alias("device_types")
    )
    out = sessions.select(
        KEY,
        *session_bounds(gap_seconds),
        F.col("newest.user_id").alias("user_id"),
        *COUNTS,
        F.col("marketed.campaign").alias("campaign"),
        "device_types",
        F.col("newest.platform").alias("latest_platform"),
    )
    return derive(out, F.col("close_ts"))


def session_regions(events: DataFrame, gap_seconds: int) -> DataFrame:
    """Regions of each session that has any, and how often the region changed; ``events`` as above, with ``region``."""
    located = with_session_start(events, KEY, "ts", gap_seconds, {"_last": ("max", position("ts"))})
    close = F.timestamp_micros(F.col("_last") + micros(gap_seconds)).alias("close_ts")
    keys = [KEY, "session_start", "close_ts"]
    return shopper_regions(located.select(KEY, "session_start", close, "event_id", "region", "ts"), keys, "ts", "region", gap_seconds)


def derive(sessions: DataFrame, as_of: Column) -> DataFrame:
    """Durations in milliseconds, bounce flag, and cart ratio (whole-number division, and exact)."""
    start = F.unix_millis("session_start")
    views, adds = F.col("product_views"), F.col("cart_adds")
    return sessions.select(
        "*",
        F.greatest(F.unix_millis(as_of) - start, F.lit(0)).alias("duration_ms"),
        (F.unix_millis("last_ts") - start).alias("active_ms"),
        (F.col("page_views") < 2).alias("bounce"),
        F.coalesce(F.expr("cart_adds div nullif(product_views, 0)"), F.lit(0)).alias("cart_ratio"),
        F.when(views == 0, 0.0).otherwise(adds / F.nullif(views, F.lit(0))).alias("cart_ratio_exact"),
    )


def running_sessions(events: DataFrame, gap_seconds: int) -> DataFrame:
    """The session so far, at each of its events."""
    measures = {"marketed": ("min", _first_marketing())}
    rows = with_session_start(events, KEY, "ts", gap_seconds, measures)
    rows = rows.select(
        KEY,
        "session_start",
        "event_id",
        "user_id",
        "platform",
        F.when(F.col("marketed.ts") <= F.col("ts"), F.col("marketed.campaign")).alias("campaign"),
        position("ts").alias("pos"),
        *[_count(c)[1].alias(n) for n, c in count_conditions().items()],
    )
    stats = rolling_stats(
        rows,
        [KEY, "session_start"],
        {"session": None},
        sums=COUNTS,
        carry=["event_id", "user_id", "platform", "campaign"],
        block=micros(gap_seconds),
    )
    out = stats.select(
        KEY,
        "session_start",
        "event_id",
        F.timestamp_micros("pos").alias("last_ts"),
        "user_id",
        *COUNTS,
        "campaign",
        F.col("platform").alias("latest_platform"),
    )
    return derive(out, F.col("last_ts"))
