"""Steps whose cost outgrew their input: results at their odd inputs."""

import pytest
from pyspark.sql import functions as F

from cartwheel.functions.text import number_of

TEXTS = ["1", "-2.5", "+.5", "5.", " 7 ", "\t8\n", "1e5", "1E-5", "-1.0E-7", "3d", "2F", "0x1p3", "0x1.8p-1", "NaN", "nan", " -inf ", "+Infinity", "iNf", ""]
TEXTS += ["1.5-2.0", "-1.5--2.0", "0.0-0.0", "{p1=2, p3=1}", "{}", "[Phone, 1]", "c3", "true", "infinite", "nano", "1 2", "1,5", "e5", ".", "-", "1e", "1e5-2", "0x", "1-\n2", None]


def test_number_of_is_the_plain_cast(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = rows.select("t", number_of(F.col("t")).cast("string").alias("ours"), F.col("t").try_cast("double").cast("string").alias("plain")).collect()
    assert [(r["t"], r["ours"]) for r in got] == [(r["t"], r["plain"]) for r in got]
    assert sum(r["plain"] is not None for r in got) >= 18


def test_a_value_is_worked_out_once_for_the_times_at_which_it_holds(spark):
    """Of two views and two cart events far apart, at windows of a day and a row each hour."""
    from cartwheel import schema
    from cartwheel.config import RollingWindow
    from cartwheel.plans import grid_features
    from tests.conftest import at

    windows = [RollingWindow("d", 86_400, 3_600, 900)]
    views = spark.createDataFrame([("u", "p1", "e1", 2.0, at(5)), ("u", "p2", "e2", 4.0, at(605))], "user_id string, product_id string, event_id string, product_price double, ts timestamp")
    held = grid_features.product_held(views, windows)
    rows = grid_features.product_grid(views, windows).collect()
    # 10 hours with one product, 14 with both, 10 with the other, one empty row
    assert len(rows) == 35 == held.select(F.explode("emit_ts")).distinct().count()
    assert sorted({(r.unique_product_count, r.average_price) for r in rows}) == [(0, 0.0), (1, 2.0), (1, 4.0), (2, 3.0)]
    assert held.count() <= 10  # cut every eight hours too
    carts = [("u", "e1", schema.ADD, 10.0, 1.0, at(5)), ("u", "e2", schema.REMOVE, None, 1.0, at(605)), ("u", "e3", schema.ADD, 5.0, 1.0, at(607))]
    carts = spark.createDataFrame(carts, "user_id string, event_id string, event_type string, previous_price double, product_price double, ts timestamp")
    held = grid_features.cart_held(carts, windows).orderBy(F.col("emit_ts")[0]).collect()
    assert [(len(r.emit_ts), r.adds, r.removes, r.cart_value) for r in held] == [(10, 1, 0, 11.0), (14, 2, 1, 6.0), (10, 1, 1, 6.0), (1, 0, 0, None)]
    # an unknown newest value is not replaced by an older one
    held = grid_features.cart_held(carts.where("event_id <> 'e3'"), windows).orderBy(F.col("emit_ts")[0]).collect()
    assert [r.cart_value for r in held] == [11.0, None, None, None]


def test_stored_cart_metrics_need_no_join_and_are_spread_last(spark):
    from cartwheel.plans import queries
    from tests.conftest import DATA

    df = queries._cart_metrics(spark, str(DATA / "sf0.001"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    # the times are spread after the metrics' texts are there
    lines = plan.splitlines()
    spread, texts = (next(i for i, line in enumerate(lines) if f"Generate explode({what}" in line) for what in ("emit_ts", "array(struct"))
    assert spread < texts
    assert df.columns == ["name", "value", "ttl_seconds", "emit_ts"]
