"""Address lookup by few and by many ranges, and region changes of users of whom nothing is known."""

from datetime import timedelta

from pyspark.sql import functions as F

from cartwheel.functions.enrich import ip_number
from cartwheel.operators import lookups
from tests.conftest import START

ADDRESSES = ["10.0.0.1", "10.1.2.3", "10.1.2.4", "10.9.0.0", "192.168.0.1", "256.1.1.1", "1.2.3", "a.b.c.d", "", "0.0.0.0", "255.255.255.255", "010.001.002.003", None]
RANGES = [("10.0.0.0/8", "ten"), ("10.1.0.0/16", "narrow"), ("10.1.2.3/32", None), ("10.1.2.3", "one"), ("0.0.0.0/1", "low"), ("bad", "bad"), ("1.2.3.4/33", "bad")]


def test_few_and_many_ranges_find_the_same(spark):
    events = spark.createDataFrame([(i, a) for i, a in enumerate(ADDRESSES)], "event_id int, ip string")
    table = spark.createDataFrame(RANGES, "cidr string, place string")
    few, many = ([tuple(r) for r in lookups.ip_lookup(events, "ip", table, ["place"], n).select("event_id", "ip", "place").orderBy("event_id").collect()] for n in (100, 0))
    assert few == many
    found = {a: p for _, a, p in few}
    assert found["10.0.0.1"] == "ten" and found["10.1.2.4"] == "narrow" and found["0.0.0.0"] == "low"
    assert found["010.001.002.003"] == found["10.1.2.3"] and found["256.1.1.1"] is None and found[None] is None
    everywhere = spark.createDataFrame([("0.0.0.0/0", "all")], "cidr string, place string")
    rows = lookups.ip_lookup(events, "ip", everywhere, ["place"]).collect()
    assert sum(r["place"] == "all" for r in rows) == 8 and len(rows) == len(ADDRESSES)


def test_few_ranges_read_an_address_twice_and_shuffle_no_event(spark):
    """Before, a filter of the join key read it nine times, and events were shuffled by address."""
    events = spark.range(10).select(F.concat(F.lit("10.1.2."), F.col("id").cast("string")).alias("ip"))
    table = spark.createDataFrame(RANGES, "cidr string, place string")
    plan = lookups.ip_lookup(events, "ip", table, ["place"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [ip#" not in plan
    number = events.where(ip_number(F.col("ip")).isNotNull())._jdf.queryExecution().optimizedPlan().toString()
    assert number.count("10.1.2.") <= 3  # two in the filter, one in the output


def test_region_changes_across_blocks_without_a_user(spark):
    days = [(None, "e1", 0, "x"), (None, "e2", 1, "y"), (None, "e3", 3, "x"), ("u", "e4", 0, "x"), ("u", "e5", 0, "z"), ("u", "e6", 2, "z"), ("u", "e7", 5, None), ("u", "e8", 6, "x")]
    rows = spark.createDataFrame([(u, e, START + timedelta(days=d), r) for u, e, d, r in days], "user_id string, event_id string, ts timestamp, region string")
    got = {r["user_id"]: (r["shopper_locations"], r["shopper_region_changes"]) for r in lookups.shopper_regions(rows, "user_id", "ts", "region", 86_400).collect()}
    assert got == {None: (["x", "y"], 2), "u": (["x", "z"], 2)}
