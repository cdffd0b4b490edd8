"""Pattern tables, agent rules, repeated events, sketches, and the writer with calls in flight."""

import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from cartwheel.config import RollingWindow
from cartwheel.functions.useragent import device_class, os_name
from cartwheel.operators import agents, lookups
from cartwheel.operators.matching import matches
from cartwheel.operators.repeats import without_repeats
from cartwheel.plans import grid_features, queries
from cartwheel.sources import sinks
from tests.conftest import DATA, at


def test_patterns_against_a_loop(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choices("abAB c", k=rng.randint(0, 25))) for _ in range(200)] + [None, "", "ÄÖ ä"]
    patterns = ["".join(rng.choices("abAB c", k=rng.choice([0, 1, 2, 4, 5, 6, 9]))) for _ in range(150)] + [None, "ÄÖ"]
    found = matches(spark.createDataFrame([(t,) for t in texts], "agent string"), "agent", spark.createDataFrame([(p, i) for i, p in enumerate(patterns)], "p string, n int"), "p")
    want = {(t, p, i) for t in texts if t for i, p in enumerate(patterns) if p and p.lower() in t.lower()}
    assert {tuple(r) for r in found.collect()} == want and len(want) > 200


def test_a_hundred_thousand_patterns(spark):
    include = spark.createDataFrame([("agent",), ("BROWSER",), ("",)], "pattern string")
    exclude = spark.range(100_000).select(F.concat(F.lit("Robot"), F.col("id"), F.lit("x")).alias("pattern"))
    events = spark.createDataFrame(
        [("1.2.3.4", "some robot17X agent"), ("1.2.3.4", "some robot agent"), ("1.2.3.4", "browser"), ("9.1.1.1", "browser"), (None, None), ("1.2.3.4", "other")],
        "ip string, agent string",
    )
    marked = lookups.mark_robots(events, "ip", "agent", spark.createDataFrame([("9.0.0.0/8",)], "cidr string"), include, exclude)
    assert {(r.ip, r.agent): r.is_robot for r in marked.collect()} == {
        ("1.2.3.4", "some robot17X agent"): True,
        ("1.2.3.4", "some robot agent"): False,
        ("1.2.3.4", "browser"): False,
        ("9.1.1.1", "browser"): True,
        (None, None): True,
        ("1.2.3.4", "other"): True,
    }
    assert len(marked._jdf.queryExecution().optimizedPlan().toString()) < 60_000  # the lists are no part of the plan
    none = lookups.mark_robots(events, "ip", "agent", spark.createDataFrame([], "cidr string"))
    assert none.where("is_robot").count() == 0 and marked.columns == ["ip", "agent", "is_robot"]


def test_agent_rules_are_data(spark):
    listed = [*queries.LISTED_AGENTS, "Mozilla (iPad)", "Windows Phone 8", "Slurp Android", "", "Kindle Fire", "CrOS x86"]
    events = spark.createDataFrame([*enumerate(listed), (99, None)], "n int, agent string")
    got = {r.n: (r.device_class, r.os_name) for r in agents.classified(events, "agent", agents.default_rules(spark)).collect()}
    want = {r.n: (r.d, r.o) for r in events.select("n", device_class(F.col("agent")).alias("d"), os_name(F.col("agent")).alias("o")).collect()}
    assert got == {**want, 99: ("Unknown", "Unknown")}
    assert {d for d, _ in got.values()} == {"Desktop", "Phone", "Tablet", "Robot", "Unknown"}
    own = spark.createDataFrame([("device", 2, "curl", "Tool"), ("device", 1, "curl/8", "New tool"), ("system", 1, "nothing", "x")], agents.RULE)
    assert {r.device_class for r in agents.classified(events, "agent", own).collect()} == {"New tool", "Unknown"}


def test_repeats_by_id_and_fingerprint(spark):
    rows = [("a", 1, None), ("a", 1, None), ("a", 2, None), ("b", 1, "x"), (None, 1, None), (None, 1, None), ("", 3, "y")]
    events = spark.createDataFrame(rows, "event_id string, n int, page string")
    assert sorted(map(str, without_repeats(events).collect())) == sorted(map(str, events.distinct().collect()))
    assert without_repeats(events).columns == events.columns


def test_sketches_are_close(spark):
    """Thousands of products in a window: within four standard errors of the exact count."""
    rows = spark.range(120_000).select(
        F.concat(F.lit("e"), "id").alias("event_id"),
        F.lit("u").alias("user_id"),
        (F.pmod(F.xxhash64("id"), F.lit(20_000))).cast("string").alias("product_id"),
        F.lit(1.0).alias("product_price"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(7200))).alias("ts"),
    )
    windows = [RollingWindow("10m", 600, 300, 1), RollingWindow("1h", 3600, 600, 1)]
    got = {(r.window_size, r.emit_ts): r.unique_product_count for r in grid_features.unique_products_approx(rows, windows).collect()}
    ends = rows.select("product_id", F.unix_seconds("ts").alias("s"))
    for (label, end), n in got.items():
        size = {"10m": 600, "1h": 3600}[label]
        stop = int((end - at(0).replace(tzinfo=None)).total_seconds()) + 1_704_067_200
        if stop % 1800 == 0:
            exact = ends.where((F.col("s") >= stop - size) & (F.col("s") < stop)).select("product_id").distinct().count()
            assert abs(n - exact) <= 4 * 1.04 / 2 ** (grid_features.LOG_BUCKETS / 2) * exact + 1
    assert len(got) > 30


class Client:
    """Counts calls under way; some fail or hang at their first try."""

    lock, log, tried = threading.Lock(), [], set()
    now = most = made = 0
    failing, hanging = set(), set()

    def __init__(self):
        with Client.lock:
            Client.made += 1

    @classmethod
    def reset(cls, failing=(), hanging=()):
        cls.log, cls.tried, cls.failing, cls.hanging = [], set(), set(failing), set(hanging)
        cls.now = cls.most = cls.made = 0

    def setex(self, name, ttl, value):
        with Client.lock:
            Client.now += 1
            Client.most = max(Client.most, Client.now)
            first = (name, value) not in Client.tried
            Client.tried.add((name, value))
        try:
            time.sleep(0.6 if first and value in Client.hanging else 0.01)
            if first and value in Client.failing | Client.hanging:
                raise ConnectionError
            with Client.lock:
                Client.log.append((name, ttl, value))
        finally:
            with Client.lock:
                Client.now -= 1

    def close(self):
        pass


def test_calls_in_flight():
    rows = [{"name": f"n{i % 40}", "ttl_seconds": None if i % 2 else 7, "value": str(i)} for i in range(400)]
    Client.reset(failing={"3", "43", "100"}, hanging={"5"})
    begin = time.monotonic()
    sinks.put_in_flight(iter(rows), Client, delay=0.01, in_flight=20, timeout=0.2)
    assert time.monotonic() - begin < 3  # one after the other takes four seconds at least
    assert 5 < Client.most <= 20 and Client.made <= 20 + 8
    assert sorted(Client.log) == sorted((r["name"], 900 if r["ttl_seconds"] is None else 7, r["value"]) for r in rows)
    for name in {r["name"] for r in rows}:  # retries do not overtake
        assert [int(v) for n, _, v in Client.log if n == name] == [int(r["value"]) for r in rows if r["name"] == name]


def test_a_call_that_keeps_failing_fails_the_task():
    class Broken(Client):
        def setex(self, name, ttl, value):
            raise ConnectionError

    with pytest.raises(ConnectionError):
        sinks.put_in_flight(iter([{"name": "a", "ttl_seconds": 1, "value": "1"}]), Broken, delay=0)


def test_robot_filter_query(spark):
    assert queries.robot_filter(spark, str(DATA / "sf0.001")).count() > 0
