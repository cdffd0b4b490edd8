"""Feature table, external writer, configuration, user agents, enrichments and plans."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from cartwheel.config import FeatureConfig
from cartwheel.functions import enrich
from cartwheel.functions.text import list_text, map_text, range_text
from cartwheel.functions.useragent import device_class, os_name
from cartwheel.operators import branches, lookups
from cartwheel.plans import grid_features, queries
from cartwheel.plans.metrics import session_metrics, user_metrics
from cartwheel.sources import sinks
from cartwheel.sources.store import FeatureStore
from tests.conftest import DATA, at
from tests.test_streaming import PROPERTIES

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # Flaky below runs in workers

METRIC = "name string, value string, ttl_seconds long, emit_ts timestamp"


def metrics(spark, *rows):
    return spark.createDataFrame([(n, v, ttl, at(t)) for n, v, ttl, t in rows], METRIC)


def values(df):
    return {r.name: r.value for r in df.collect()}


def test_newest_value_wins_whatever_the_batch(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "s"), buckets=4)
    assert store.latest().count() == 0
    store.upsert(metrics(spark, ("a", "1", 60, 0), ("a", "2", 60, 5), ("b", "x", None, 1)), 0)
    store.upsert(metrics(spark, ("a", "old", 60, 2), ("c", "y", 60, 1)), 1)
    assert values(store.latest()) == {"a": "2", "b": "x", "c": "y"}
    store.upsert(metrics(spark, ("a", "3", 60, 5)), 2)  # same time, later batch
    assert values(store.latest())["a"] == "3"


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "s"), buckets=4)
    for _ in range(2):
        store.upsert(metrics(spark, ("a", "1", 60, 0), ("b", "2", 60, 0)), 7)
    assert store.rows().count() == 2
    store.upsert(metrics(spark, ("a", "1", 60, 0)), 7)
    assert values(store.latest()) == {"a": "1"}


def test_expiry_and_default_ttl(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "s"), buckets=4)
    store.upsert(metrics(spark, ("a", "1", 60, 0), ("b", "2", None, 0)), 0)

    def live(t):
        return set(values(store.lookup(["a", "b", "z"], F.lit(at(t)))))

    assert live(0.9) == {"a", "b"}
    assert live(1) == {"b"}
    assert live(14.9) == {"b"}
    assert live(15) == set()


def test_compaction_keeps_the_table(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "s"), buckets=4)
    store.upsert(metrics(spark, ("a", "1", 60, 0), ("b", "2", 60, 0)), 0)
    store.upsert(metrics(spark, ("a", "3", 60, 1)), 1)
    before = values(store.latest())
    store.compact()
    assert values(store.latest()) == before and store.rows().count() == 2
    store.upsert(metrics(spark, ("b", "4", 60, 2)), 2)
    assert values(store.latest()) == {"a": "3", "b": "4"}


def test_no_write_hides_another(spark, tmp_path):
    """Runs with the same batch numbers, and numbers that were folded before, add to the table."""
    path = str(tmp_path / "s")
    for i in range(3):
        FeatureStore(spark, path, buckets=4).upsert(metrics(spark, (f"n{i}", str(i), 60, 0)), 0)
    store = FeatureStore(spark, path, buckets=4)
    store.compact()
    store.upsert(metrics(spark, ("late", "x", 60, 0)), 0)
    store.compact()
    store.upsert(metrics(spark, ("late", "y", 60, 1)), 0)
    assert values(store.latest()) == {"n0": "0", "n1": "1", "n2": "2", "late": "y"}


def test_upserts_compact_and_clean_up(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "s"), buckets=2, compact_after=3)
    for i in range(10):
        store.upsert(metrics(spark, (f"n{i}", str(i), 10**9, i), ("a", str(i), 60, i)), i)
    assert values(store.latest()) == {"a": "9", **{f"n{i}": str(i) for i in range(10)}}
    assert len(list((tmp_path / "s").glob("part=*"))) <= 6
    store.upsert(metrics(spark, ("z", "1", 60, 60 * 48)), 10)
    store.upsert(metrics(spark, ("z", "2", 60, 60 * 48)), 11)
    store.compact()
    assert "a" not in values(store.latest()) and len(values(store.latest())) == 11


def test_lookup_by_list_reads_its_buckets(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "s"), buckets=8)
    store.upsert(metrics(spark, *[(f"n{i}", "1", 60, 0) for i in range(200)]), 0)
    found = store.lookup(["n7"], F.lit(at(0.5)))
    assert values(found) == {"n7": "1"}
    assert "PartitionFilters: [" in physical(found) and "bucket#" in physical(found).split("PartitionFilters: [", 1)[1].split("]")[0]
    many = [f"n{i}" for i in range(12_000)]
    assert store.lookup(many, F.lit(at(0.5))).count() == 200


class Flaky:
    """Fails the first calls, then writes lines to a file."""

    def __init__(self, path, failures):
        self.path, self.failures = path, failures

    def setex(self, name, ttl, value):
        if self.failures:
            self.failures.pop()
            raise ConnectionError
        with open(self.path, "a", encoding="utf-8") as out:
            out.write(f"{name} {ttl} {value}\n")

    def close(self):
        pass


def test_external_writer(spark, tmp_path):
    path = str(tmp_path / "kv")
    write = sinks.external_store_writer(lambda: Flaky(path, []))
    write(metrics(spark, ("a", "1", None, 0), ("a", "2", 60, 1), ("b", "3", None, 0)).coalesce(1), 0)
    assert sorted(open(path, encoding="utf-8").read().splitlines()) == ["a 60 2", "b 900 3"]


def test_writer_retries_three_times_then_fails(tmp_path):
    rows = [{"name": "a", "ttl_seconds": 5, "value": "1"}]
    path = str(tmp_path / "kv")
    three, four = [1] * 3, [1] * 4
    sinks.put_all(iter(rows), lambda: Flaky(path, three), delay=0)
    assert open(path, encoding="utf-8").read() == "a 5 1\n"
    with pytest.raises(ConnectionError):
        sinks.put_all(iter(rows), lambda: Flaky(path, four), delay=0)


def test_configuration(tmp_path):
    config = FeatureConfig.from_properties(PROPERTIES)
    assert [w.label for w in config.windows("cart")] == ["5min"]
    assert config.windows("purchase")[0].duration_seconds == 86400
    assert config.session.gap_seconds == 240
    with pytest.raises(ValueError):
        FeatureConfig.from_properties({})
    with pytest.raises(KeyError):
        FeatureConfig.from_properties({k: v for k, v in PROPERTIES.items() if "session.gap" not in k})
    first, second = tmp_path / "a.properties", tmp_path / "b.properties"
    first.write_text("# comment\n" + "\n".join(f"{k} = {v}" for k, v in PROPERTIES.items()))
    second.write_text("metric.session.gap_seconds=99\n")
    assert FeatureConfig.from_files(str(first), str(second)).session.gap_seconds == 99


@pytest.mark.parametrize(
    "agent, device, system",
    [
        ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/120", "Desktop", "Windows NT"),
        ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) Mobile/15E148", "Phone", "iOS"),
        ("Mozilla/5.0 (iPad; CPU OS 16_0 like Mac OS X)", "Tablet", "iOS"),
        ("Mozilla/5.0 (Linux; Android 14; Pixel 8) Mobile Safari", "Phone", "Android"),
        ("Mozilla/5.0 (Linux; Android 13; SM-X900) Safari", "Tablet", "Android"),
        ("Mozilla/5.0 (compatible; Somebot/2.1)", "Robot", "Unknown"),
        ("", "Unknown", "Unknown"),
    ],
)
def test_user_agents(spark, agent, device, system):
    row = spark.range(1).select(device_class(F.lit(agent)).alias("d"), os_name(F.lit(agent)).alias("s")).first()
    assert (row.d, row.s) == (device, system)


def test_text_forms(spark):
    row = spark.range(1).select(
        map_text(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))).alias("m"),
        list_text(F.array(F.lit("x"), F.lit("y"))).alias("l"),
        range_text(F.lit(0.0), F.lit(12.5)).alias("r"),
    ).first()
    assert tuple(row) == ("{a=1, b=2}", "[x, y]", "0.0-12.5")


def test_metric_rows(spark):
    carts = spark.createDataFrame([("u", at(0), "1hr", 2, 1, 3, None)], "user_id string, emit_ts timestamp, window_size string, adds long, removes long, update_frequency long, cart_value double")
    rows = {r.name: (r.value, r.ttl_seconds) for r in user_metrics(carts, "cart", {"1hr": 7200}).collect()}
    assert rows == {f"user:u:{m}_1hr": (v, 7200) for m, v in (("cart_add_count", "2"), ("cart_remove_count", "1"), ("cart_update_frequency", "3"))}
    session = "session_id string, close_ts timestamp, duration_ms long, page_views long, bounce boolean, campaign string, cart_ratio long, searches long, device_types array<string>, latest_platform string"
    one = spark.createDataFrame([("s", at(0), 5, 1, True, None, 0, 0, ["Phone", "Desktop"], "web")], session)
    rows = {r.name: r.value for r in session_metrics(one, 60).collect()}
    assert rows["session:s:session_bounce"] == "true"
    assert rows["session:s:shopper_device_types"] == "[Phone, Desktop]"
    assert "session:s:session_marketing_campaign" not in rows and len(rows) == 7


def test_anonymous_ip_and_fingerprint(spark):
    ip = F.lit("10.20.30.40")
    row = spark.range(1).select(
        enrich.anonymous_ip(ip).alias("one"),
        enrich.anonymous_ip(ip, 2).alias("two"),
        enrich.anonymous_ip(F.lit("::1")).alias("other"),
        (enrich.fingerprint(F.lit("b=2&a=1&eid=9")) == enrich.fingerprint(F.lit("a=1&stm=5&b=2"))).alias("same"),
        enrich.ip_number(F.lit("1.2.3.4")).alias("n"),
        enrich.ip_number(F.lit("x")).alias("none"),
    ).first()
    assert tuple(row) == ("10.20.30.x", "10.20.x.x", "::1", True, 16909060, None)


def test_lookup_never_multiplies_events(spark):
    events = spark.createDataFrame([(1, "k"), (2, "z")], "id long, key string")
    table = spark.createDataFrame([("k", "b"), ("k", "a")], "key string, label string")
    assert {(r.id, r.label) for r in lookups.lookup(events, table, ["key"]).collect()} == {(1, "a"), (2, None)}


def test_addresses_and_ranges_that_are_none(spark):
    cidrs = ["10.0.0.0/8", "10.1.0.0/16", "10.1.44.5", "10.1.44.0/33", "10.1.44.0/-1", "300.0.0.0/8", "x/8", "10.1.44.0/", "10.1.2.3/24/5", None]
    table = spark.createDataFrame([(c, c) for c in cidrs], "cidr string, place string")
    ips = ["10.0.300.5", "10.1.44.5", "10.1.44.6", "10.255.255.255", "11.0.0.0", "", None, "10.1.44"]
    events = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "id long, ip string")
    found = {r.id: r.place for r in lookups.ip_lookup(events, "ip", table, ["place"]).collect()}
    assert [found[i] for i in range(8)] == [None, "10.1.44.5", "10.1.0.0/16", "10.0.0.0/8", None, None, None, None]
    everything = spark.createDataFrame([("0.0.0.0/0", "all")], "cidr string, place string")
    assert lookups.ip_lookup(events, "ip", everything, ["place"]).where("place = 'all'").count() == 4
    assert lookups.ip_lookup(events, "ip", table.limit(0), ["place"]).where("place IS NULL").count() == 8


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    """Column pruning reaches the scan, no product of rows, no Python in batch plans."""
    sf = str(DATA / "sf0.001")
    for name in ("rolling_cart", "rolling_product_unique", "rolling_purchase", "grid_product", "session_features"):
        plan = physical(queries.BATCH[name](spark, sf))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "Python" not in plan and "ArrowEval" not in plan, name
    bounds = physical(queries.session_bounds(spark, sf))
    assert "ReadSchema" in bounds and "value:double" not in bounds


def test_panes_are_combined_before_the_shuffle(spark):
    views = branches.product_views(queries.shop(spark, str(DATA / "sf0.001")))
    plan = physical(grid_features.product_item_views(views, queries.WINDOWS))
    assert "partial_count(1)" in plan and "partial_min(product_price" in plan


def test_rows_are_computed_once(spark):
    """Totals per block and running values inside blocks read the same exchange; so do row and carried row."""
    sf = str(DATA / "sf0.001")
    for name, reused in (("rolling_cart", 1), ("rolling_category_unique", 2), ("rolling_product_unique", 2), ("grid_cart", 1)):
        df = queries.BATCH[name](spark, sf)
        df.collect()
        final = physical(df).split("== Initial Plan ==")[0]
        assert final.count("ReusedExchange") >= reused, name
