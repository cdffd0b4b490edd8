"""Distributed results against plain loops over one user's events, hot users and equal times included."""

import random

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.previous import with_previous
from cartwheel.operators.rolling import rolling_stats
from cartwheel.operators.sessions import session_features, with_session_start
from cartwheel.plans import event_features, session_features as shop_sessions
from tests.conftest import at
from tests.test_golden import PURCHASES

SIZES = {"4m": 240, "12m": 720}


def moments(rng, n, span):
    return [rng.randrange(span * 4) / 4 for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_products(spark, seed):
    rng = random.Random(seed)
    views = []
    for user, n in (("hot", 250), ("a", 30), ("b", 1)):
        for i, t in enumerate(moments(rng, n, 90)):
            views.append((f"{user}{i:04d}", user, f"p{rng.randrange(6)}", rng.randrange(1000) / 100, at(t)))
    df = spark.createDataFrame(views, "event_id string, user_id string, product_id string, product_price double, ts timestamp")
    got = {(r.event_id, r.window_size): r for r in event_features.product_stats(df, SIZES).collect()}
    assert len(got) == len(views) * len(SIZES)
    for event, user, _, _, t in views:
        for label, seconds in SIZES.items():
            inside = sorted((v for v in views if v[1] == user and 0 <= (t - v[4]).total_seconds() <= seconds), key=lambda v: (v[4], v[0]))
            first = {}
            for v in inside:
                first.setdefault(v[2], v[3])
            r = got[event, label]
            assert r.unique_product_count == len(first) and r.view_count == len(inside)
            assert r.average_price == pytest.approx(sum(first.values()) / len(first))
            assert (r.min_price, r.max_price) == (min(v[3] for v in inside), max(v[3] for v in inside))


@pytest.mark.parametrize("seed", [3, 4])
def test_purchases(spark, seed):
    rng = random.Random(seed)
    rows = []
    for user, n in (("hot", 200), ("a", 25)):
        for i, t in enumerate(rng.sample(range(400), n)):
            kind = rng.choice(["add_to_cart", "remove_from_cart", "checkout_step"])
            cart = kind != "checkout_step"
            rows.append((f"{user}{i}", user, kind, float(rng.randrange(500)) if cart else 0.0, 3.5 if cart else 0.0, not cart and rng.random() < 0.7, at(t / 4)))
    got = {(r.event_id, r.window_size): r for r in event_features.purchase_stats(spark.createDataFrame(rows, PURCHASES), SIZES).collect()}
    assert len(got) == len(rows) * len(SIZES)
    for event in rows:
        for label, seconds in SIZES.items():
            last, orders = None, []
            for e in sorted((e for e in rows if e[1] == event[1]), key=lambda e: e[6]):
                if not 0 <= (event[6] - e[6]).total_seconds() <= seconds:
                    continue
                if e[2] != "checkout_step":
                    last = e
                elif e[5]:
                    if last:
                        orders.append(last[3] + (last[4] if last[2] == "add_to_cart" else -last[4]))
                    last = None
            r = got[event[0], label]
            assert (r.orders_count, r.order_value) == (len(orders), pytest.approx(sum(orders)))


@pytest.mark.parametrize("gap", [30, 300])
def test_sessions(spark, gap):
    rng = random.Random(gap)
    rows = [(key, f"{key}{i}", at(t)) for key, n in (("hot", 300), ("a", 20)) for i, t in enumerate(moments(rng, n, 240))]
    df = spark.createDataFrame(rows, "k string, event_id string, ts timestamp")
    want = set()
    for key in ("hot", "a"):
        times = sorted(t for k, _, t in rows if k == key)
        start, n = times[0], 0
        for before, t in zip([times[0], *times], times):
            if (t - before).total_seconds() > gap:
                want.add((key, start.timestamp(), before.timestamp(), n))
                start, n = t, 0
            n += 1
        want.add((key, start.timestamp(), times[-1].timestamp(), n))
    out = session_features(df, "k", "ts", gap, {"n": ("sum", F.lit(1))})
    seconds = lambda c: F.unix_micros(c) / 1e6
    got = {(r.k, r.a, r.b, r.n) for r in out.select("k", seconds("session_start").alias("a"), seconds("last_ts").alias("b"), "n").collect()}
    assert got == want
    per_event = with_session_start(df, "k", "ts", gap).groupBy("k", "session_start").agg(F.count("*").alias("n"))
    assert {(r.k, r.a, r.n) for r in per_event.select("k", seconds("session_start").alias("a"), "n").collect()} == {(k, a, n) for k, a, _, n in want}


def test_previous_row_over_empty_blocks(spark):
    rows = [("u", f"e{i}", p) for i, p in enumerate([5, 5, 17, 400, 401, 9000])]
    df = spark.createDataFrame(rows, "k string, event_id string, pos long")
    out = with_previous(df, ["k"], ["event_id"], 10).orderBy("pos", "event_id").collect()
    assert [r.prev.event_id if r.prev else None for r in out] == [None, "e0", "e1", "e2", "e3", "e4"]


def test_dates_before_1970(spark):
    df = spark.createDataFrame([("u", p, 1) for p in (-25_000_000, -12_000_000, -1, 0, 9_000_000)], "k string, pos long, n long")
    out = rolling_stats(df, ["k"], {"s": 16}, sums=["n"]).orderBy("pos").collect()
    assert [r.n for r in out] == [1, 2, 2, 3, 3]


def test_running_session_counts(spark):
    rng = random.Random(9)
    schema = "event_id string, session_id string, user_id string, event_type string, searched boolean, device string, platform string, has_marketing boolean, campaign string, ts timestamp"
    kinds = ["page_view", "product_view", "add_to_cart", "remove_from_cart"]
    rows = []
    for i, t in enumerate(rng.sample(range(900), 150)):
        marketing = rng.random() < 0.1
        rows.append((f"{i:03d}", "s", "u", rng.choice(kinds), False, "Phone", "web", marketing, f"c{i}" if marketing else None, at(t / 3)))
    got = {r.event_id: r for r in shop_sessions.running_sessions(spark.createDataFrame(rows, schema), 120).collect()}
    ordered = sorted(rows, key=lambda r: r[9])
    counts, campaign, before = {}, None, None
    for row in ordered:
        if before and (row[9] - before).total_seconds() > 120:
            counts, campaign = {}, None
        before = row[9]
        counts[row[3]] = counts.get(row[3], 0) + 1
        campaign = campaign or row[8]
        r = got[row[0]]
        assert (r.page_views, r.product_views, r.cart_adds) == tuple(counts.get(k, 0) for k in kinds[:3])
        assert r.campaign == campaign
