"""The worked sequences: rolling windows, sessions, order pairing, averages."""

import pytest
from pyspark.sql import functions as F

from cartwheel.config import RollingWindow
from cartwheel.operators.rolling import rolling_features
from cartwheel.operators.sessions import session_features
from cartwheel.plans import event_features, grid_features
from tests.conftest import at, minutes


def test_rolling_sequence(spark):
    """Size 10, emit 1: the window is closed at its lower end."""
    df = spark.createDataFrame([("U1", f"PV{i}", at(t)) for i, t in enumerate([0, 2, 7, 11, 13], 1)], "k string, event_id string, ts timestamp")
    out = rolling_features(df, ["k"], "ts", {"10m": 600}, {"seen": F.collect_list("event_id")})
    seen = {r.event_id: r.seen_10m for r in out.collect()}
    assert seen["PV4"] == ["PV2", "PV3", "PV4"]
    assert seen["PV5"] == ["PV3", "PV4", "PV5"]
    grid = rolling_features(df, ["k"], "ts", {"10m": 600}, {"seen": F.collect_list("event_id")}, "grid", 60)
    by_time = {minutes(r.emit_ts): sorted(r.seen) for r in grid.collect()}
    assert by_time[1] == ["PV1"]
    assert by_time[12] == ["PV2", "PV3", "PV4"]  # T = 2 still inside at 12
    assert by_time[13] == ["PV3", "PV4"]


def test_session_sequence(spark):
    df = spark.createDataFrame([("S1", at(t)) for t in [0, 5, 40, 45, 80]], "k string, ts timestamp")
    out = session_features(df, "k", "ts", 1800, {"n": ("sum", F.lit(1))}).orderBy("session_start").collect()
    assert [(minutes(r.session_start), minutes(r.close_ts), r.n) for r in out] == [(0, 35, 2), (40, 75, 2), (80, 110, 1)]


def test_gap_at_the_limit_joins(spark):
    df = spark.createDataFrame([("S1", at(t)) for t in [0, 30, 60.001]], "k string, ts timestamp")
    out = session_features(df, "k", "ts", 1800, {"n": ("sum", F.lit(1))}).orderBy("session_start").collect()
    assert [r.n for r in out] == [2, 1]


PURCHASES = "event_id string, user_id string, event_type string, cart_total double, cart_price double, completed boolean, ts timestamp"
PAIRING = [
    ("e1", "add_to_cart", 100.0, 20.0, False),
    ("e2", "checkout_step", 0.0, 0.0, False),
    ("e3", "checkout_step", 0.0, 0.0, True),
    ("e4", "checkout_step", 0.0, 0.0, True),
    ("e5", "remove_from_cart", 120.0, 20.0, False),
    ("e6", "checkout_step", 0.0, 0.0, True),
]


def test_pairing_sequence(spark):
    rows = [(e, "u", kind, total, price, done, at(i)) for i, (e, kind, total, price, done) in enumerate(PAIRING)]
    orders = event_features.purchase_orders(spark.createDataFrame(rows, PURCHASES), {"1h": 3600})
    assert {r.order_id: r.order_value for r in orders.collect()} == {"e3": 120.0, "e6": 100.0}


@pytest.mark.parametrize(
    "total, count, expected",
    [("100.0", 2, 50.0), ("100.0", 3, 33.3), ("100.01", 2, 50.0), ("100.03", 2, 50.02), ("10000000.0", 3, 3333333.33), ("0.0", 0, 0.0)],
)
def test_average_order(spark, total, count, expected):
    value = event_features.average_order(F.lit(total).cast("decimal(38,12)"), F.lit(count).cast("long"))
    assert spark.range(1).select(value.alias("v")).first().v == expected


def test_zero_row_once_per_stretch(spark):
    df = spark.createDataFrame(
        [("a", "u", "add_to_cart", 1.0, 1.0, at(0)), ("b", "u", "add_to_cart", 1.0, 1.0, at(100))],
        "event_id string, user_id string, event_type string, previous_price double, product_price double, ts timestamp",
    )
    out = grid_features.cart_grid(df, [RollingWindow("10m", 600, 60, 900)]).orderBy("emit_ts").collect()
    assert [minutes(r.emit_ts) for r in out if r.adds == 0] == [11, 111]
    assert [minutes(r.emit_ts) for r in out if r.adds == 1] == [*range(1, 11), *range(101, 111)]
    assert all(r.cart_value is None for r in out if r.adds == 0)


def test_windows_with_different_emit_intervals(spark):
    df = spark.createDataFrame(
        [(f"e{i}", "u", "add_to_cart", 1.0, 1.0, at(t)) for i, t in enumerate([0.5, 3, 3.2, 9])],
        "event_id string, user_id string, event_type string, previous_price double, product_price double, ts timestamp",
    )
    windows = [RollingWindow("5m", 300, 30, 900), RollingWindow("9m", 540, 180, 900)]
    out = grid_features.cart_grid(df, windows, empty_rows=False).collect()
    times = [0.5, 3, 3.2, 9]
    want = {}
    for label, size, emit in (("5m", 5, 0.5), ("9m", 9, 3)):
        for step in range(1, 60):
            n = sum(step * emit - size <= t < step * emit for t in times)
            if n:
                want[label, step * emit] = n
    assert {(r.window_size, minutes(r.emit_ts)): r.adds for r in out} == want


def test_grid_changes_against_a_loop(spark):
    """Sizes that the emit interval does not divide, late first prices, gaps: every emit time, and one empty row."""
    views = [("u", p, f"e{i}", price, at(t)) for i, (p, price, t) in enumerate([("a", 3.0, 1), ("b", 2.0, 4), ("a", 5.0, 9), ("a", 4.0, 16), ("b", 9.0, 58)])]
    events = spark.createDataFrame(views, "user_id string, product_id string, event_id string, product_price double, ts timestamp")
    windows = [RollingWindow("10m", 600, 240, 1), RollingWindow("25m", 1500, 360, 1)]
    got = {(r.window_size, minutes(r.emit_ts)): r for r in grid_features.product_grid(events, windows).collect()}
    start = (at(0).timestamp() / 60) % 720
    want = {}
    for label, size, emit in (("10m", 10, 4), ("25m", 25, 6)):
        open_before = False
        for t in [t for t in range(-30, 120) if (t + start) % emit == 0]:
            inside = [v for v in views if t - size <= minutes(v[4]) < t]
            first = {v[1]: v[3] for v in reversed(inside)}
            prices = [v[3] for v in inside] or [0.0]
            if inside or open_before:
                mean = sum(first.values()) / len(first) if first else 0.0
                counts = {p: sum(v[1] == p for v in inside) for p in first}
                want[label, t] = (len(first), mean, min(prices), max(prices), counts)
            open_before = bool(inside)
    assert {k: (r.unique_product_count, r.average_price, r.min_price, r.max_price, r.views) for k, r in got.items()} == want


def test_grid_rows_are_shuffled_as_changes(spark):
    """Rows per emit time are filled in after the last exchange, not carried through it."""
    views = [("u", "a", "e0", 1.0, at(0))]
    events = spark.createDataFrame(views, "user_id string, product_id string, event_id string, product_price double, ts timestamp")
    windows = [RollingWindow("7d", 604800, 60, 1)]
    for out in (grid_features.product_item_views(events, windows), grid_features.category_item_views(events.withColumnRenamed("product_id", "category"), windows)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("sequence(_at") < plan.index("RepartitionByExpression")
        assert out.count() == 10080
