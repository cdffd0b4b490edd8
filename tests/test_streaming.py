"""Streams over many small batches, with events out of order, against the batch results."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cartwheel.config import FeatureConfig, RollingWindow
from cartwheel.operators import branches
from cartwheel.plans import grid_features, pipeline, session_features
from cartwheel.plans.queries import tracker_json
from cartwheel.sources.events import file_events, with_event_time
from cartwheel.sources.table_events import shop_events_from_table
from cartwheel.sources.store import FeatureStore
from cartwheel.sources.sinks import as_json_rows, file_sink, print_sink
from cartwheel.streaming import native, stateful
from cartwheel.streaming.event_time import rows_dropped_as_late
from tests.conftest import START, at

WINDOWS = [RollingWindow("10m", 600, 60, 900), RollingWindow("30m", 1800, 300, 900)]
GAP = 240
TYPES = ["view", "click", "error", "purchase", "signup"]
EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Eight files; within a file events are shuffled, across files mostly in order (three minutes late at most)."""
    rng = random.Random(5)
    rows = [
        (i, at(t / 4), rng.randrange(3), rng.choice(TYPES), rng.randrange(5000) / 100, '{"k": %d}' % rng.randrange(100))
        for i, t in enumerate(sorted(rng.sample(range(480), 240)))
    ]
    arrival = sorted(rows, key=lambda r: r[1].timestamp() + rng.random() * 180)
    path = str(tmp_path_factory.mktemp("events"))
    for n in range(8):
        part = arrival[n * 30 : (n + 1) * 30]
        rng.shuffle(part)
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, folder):
    files = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(folder)
    return with_event_time(shop_events_from_table(files), delay="4 minutes")


def batch(spark, folder):
    return shop_events_from_table(spark.read.schema(EVENTS).parquet(folder))


def run(df, tmp_path, name):
    query = (
        df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name))
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows_dropped_as_late(query) == 0
    return df.sparkSession.table(name)


def passed(spark, folder):
    newest = spark.read.schema(EVENTS).parquet(folder).agg(F.max("ts")).first()[0]
    return F.lit(newest).cast("timestamp") - F.expr("interval 4 minutes")


def rows_of(df, *columns):
    out = [tuple(round(v, 6) if isinstance(v, float) else str(v) if isinstance(v, (dict, list)) else v for v in r) for r in df.select(*columns).collect()]
    assert len(out) == len(set(out))
    return set(out)


KEYS = ("user_id", "window_size", "emit_ts")
CASES = {
    "cart": (native.cart_stream, branches.cart_events, grid_features.cart_grid, ["adds", "removes", "cart_value"]),
    "product": (native.product_stream, branches.product_views, grid_features.product_grid, ["unique_product_count", "average_price", "min_price", "views"]),
    "category": (native.category_stream, branches.category_views, grid_features.category_grid, ["unique_category_count", "most_viewed_category", "views"]),
    "purchase": (native.purchase_stream, branches.purchase_events, grid_features.purchase_grid, ["orders_count", "order_value", "avg_order_value"]),
}


@pytest.mark.parametrize("empty_rows", [False, True])
@pytest.mark.parametrize("name", list(CASES))
def test_rolling_stream_equals_batch(spark, folder, tmp_path, name, empty_rows):
    streamed, project, grid, columns = CASES[name]
    got = set()
    for i, windows in enumerate([[w] for w in WINDOWS] if name == "purchase" else [WINDOWS]):
        out = streamed(stream(spark, folder), windows, empty_rows)
        got |= rows_of(run(out, tmp_path, f"native_{name}_{i}_{empty_rows}"), *KEYS, *columns)
    want = grid(project(batch(spark, folder)), WINDOWS, empty_rows).where(F.col("emit_ts") <= passed(spark, folder))
    want = rows_of(want, *KEYS, *columns)
    assert len(want) > 100
    assert got == want


def test_exact_rolling_equals_batch(spark, folder, tmp_path):
    carts = branches.cart_events(stream(spark, folder))
    out = stateful.rolling_stream(carts, "user_id", WINDOWS, stateful.cart_counts, stateful.CART_COUNTS_DDL)
    got = rows_of(run(out, tmp_path, "exact_rolling"), *KEYS, "adds", "removes")
    want = grid_features.cart_grid(branches.cart_events(batch(spark, folder)), WINDOWS)
    want = rows_of(want.where(F.col("emit_ts") <= passed(spark, folder)), *KEYS, "adds", "removes")
    assert len(want) > 100 and got == want


def test_sessions_equal_batch(spark, folder, tmp_path):
    columns = ("session_id", "session_start", "last_ts", *session_features.COUNTS, "campaign", "device_types", "latest_platform")
    got = rows_of(run(native.session_stream(stream(spark, folder), GAP), tmp_path, "native_sessions"), *columns)
    closed = session_features.shop_sessions(branches.session_events(batch(spark, folder)), GAP)
    want = rows_of(closed.where(F.col("close_ts") <= passed(spark, folder)), *columns)
    assert len(want) > 5 and got == want


def test_running_sessions_end_like_batch(spark, folder, tmp_path):
    rows = branches.session_events(stream(spark, folder))
    out = run(
        stateful.session_stream_running(rows, "session_id", GAP, 60, stateful.session_counts, stateful.SESSION_COUNTS_DDL),
        tmp_path,
        "running_sessions",
    )
    columns = ("session_id", "session_start", "page_views", "product_views", "cart_adds", "duration_ms")
    got = rows_of(out.where("closed"), *columns)
    closed = session_features.shop_sessions(branches.session_events(batch(spark, folder)), GAP)
    want = rows_of(closed.where(F.col("close_ts") <= passed(spark, folder)), *columns)
    assert len(want) > 5 and got == want
    running = out.where("not closed").groupBy("session_id", "session_start").agg(F.count("*").alias("n"))
    assert running.agg(F.max("n")).first()[0] > 1


def test_watermark_follows_the_newest_event(spark, tmp_path):
    """Three events, one of them late: the watermark is the newest time less the delay."""
    for i, t in enumerate([0, -4 / 60, 1 / 60]):
        spark.createDataFrame([(at(t), f"e{i}")], "ts timestamp, value string").write.mode("append").parquet(str(tmp_path / "in"))
    files = spark.readStream.schema("ts timestamp, value string").parquet(str(tmp_path / "in"))
    counts = with_event_time(files).groupBy(F.window("ts", "1 second")).count()
    query = counts.writeStream.format("noop").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    mark = datetime.fromisoformat(query.lastProgress["eventTime"]["watermark"].replace("Z", "+00:00"))
    assert (mark - START).total_seconds() == 1 - 5


PROPERTIES = {
    "metric.sizes": "5min,1hr,24hr",
    **{f"metric.{b}.5min.{k}_seconds": v for b in ("product", "category", "cart") for k, v in (("duration", "300"), ("emit", "30"), ("ttl", "900"))},
    **{f"metric.{b}.24hr.{k}_seconds": v for b in ("purchase",) for k, v in (("duration", "86400"), ("emit", "3600"), ("ttl", "172800"))},
    "metric.session.gap_seconds": "240",
    "metric.session.emit_seconds": "30",
    "metric.session.ttl_seconds": "3600",
}


def test_pipeline_batch_and_stream_agree(spark, folder, tmp_path):
    config = FeatureConfig.from_properties(PROPERTIES)
    text = tracker_json(batch(spark, folder))
    text = text.unionByName(spark.createDataFrame([('{"event_id": "cut',)], "value string"))
    raw = str(tmp_path / "raw")
    text.coalesce(1).write.text(raw)
    done = pipeline.run_batch(file_events(spark, raw), config, str(tmp_path / "b"), str(tmp_path / "bad_b"), reshaped=False)
    queries = pipeline.run_stream(
        file_events(spark, raw, streaming=True), config, str(tmp_path / "s"), str(tmp_path / "cp"), str(tmp_path / "bad_s"), reshaped=False, once=True
    )
    for query in queries:
        query.awaitTermination()
    assert spark.read.json(str(tmp_path / "bad_b")).count() == spark.read.json(str(tmp_path / "bad_s")).count() == 1
    for name, store in pipeline.stores(spark, str(tmp_path / "s"), config).items():
        streamed = {r.name: (r.emit_ts, r.value) for r in store.latest().collect()}
        whole = {r.name: (r.emit_ts, r.value) for r in done[name].latest().collect()}
        assert whole, name
        # a stream ends at the watermark, so its rows may be older, never different at the same time
        assert set(streamed) <= set(whole), name
        for key, (time, value) in streamed.items():
            assert time <= whole[key][0]
            assert time < whole[key][0] or value == whole[key][1]
    assert done["cart"].latest().where("name like 'user:%:cart_add_count_5min'").count() > 0


def test_console_and_file_sinks(spark, folder, tmp_path):
    events = stream(spark, folder).select("event_id", "event_type")
    print_sink(events, "printed", str(tmp_path / "c1")).trigger(availableNow=True).start().awaitTermination()
    query = file_sink(as_json_rows(events), str(tmp_path / "out"), str(tmp_path / "c2"), "text").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).select("event_id").distinct().count() == 240


def test_idle_source_still_closes_windows(spark, tmp_path):
    """One event, then silence: the clock moves the watermark on and the window comes out."""
    from datetime import timezone
    from time import monotonic, sleep

    from cartwheel.streaming.event_time import POLICY, larger_watermark, with_idle_advance

    before = spark.conf.get(POLICY)
    fields = "event_type string, ts timestamp"
    spark.createDataFrame([("view", datetime.now(timezone.utc))], fields).write.parquet(str(tmp_path / "in"))
    events = with_idle_advance(spark.readStream.schema(fields).parquet(str(tmp_path / "in")))
    counts = events.groupBy(F.window("ts", "2 seconds"), "event_type").count()
    writer = counts.writeStream.format("memory").queryName("idle").outputMode("append").option("checkpointLocation", str(tmp_path / "c"))
    with larger_watermark(spark):
        query = writer.trigger(processingTime="1 second").start()
    assert spark.conf.get(POLICY) == before
    end = monotonic() + 60
    while monotonic() < end and spark.table("idle").count() == 0 and query.exception() is None:
        sleep(1)
    query.stop()
    assert [(r.event_type, r["count"]) for r in spark.table("idle").collect()] == [("view", 1)]


def test_a_stopped_stream_goes_on_where_it_was(spark, tmp_path):
    """Two runs on one checkpoint lose and repeat nothing; a new checkpoint adds to the same table."""
    raw = str(tmp_path / "raw")
    events = spark.createDataFrame([(f"u{i}", str(i), 60, datetime(2024, 1, 1, 0, i)) for i in range(4)], "name string, value string, ttl_seconds long, emit_ts timestamp")
    for i in range(2):
        events.where(f"name IN ('u{2 * i}', 'u{2 * i + 1}')").write.mode("append").parquet(raw)
        for checkpoint in ("one", "two"):
            store = FeatureStore(spark, str(tmp_path / "store"), buckets=2, compact_after=3)
            query = (
                spark.readStream.schema(events.schema).parquet(raw).writeStream
                .foreachBatch(pipeline._upserting(store, str(tmp_path / checkpoint)))
                .option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start()
            )
            query.awaitTermination()
    assert {r.name: r.value for r in store.latest().collect()} == {f"u{i}": str(i) for i in range(4)}


def test_a_window_that_holds_the_same_rows_is_counted_once(spark):
    from types import SimpleNamespace

    from pyspark.sql import Row
    from pyspark.sql import types as T

    from cartwheel.streaming import stateful
    from tests.test_panes import Handle

    class Rows(list):
        appendList = list.extend

        def get(self):
            return iter(list(self))

        def put(self, values):
            self[:] = values

        def exists(self):
            return bool(self)

    calls = []
    fields = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("event_id", T.StringType()), T.StructField(stateful.MOMENT, T.LongType())])
    processor = stateful.RollingProcessor(fields, "user_id string, window_size string, emit_ts timestamp, n bigint", [RollingWindow("w", 3600, 60, 1)], lambda rows: calls.append(len(rows)) or (len(rows),))
    handle = Handle()
    handle.getListState = lambda name, _: handle.states.setdefault(name, Rows())
    processor.init(handle)
    at_ms = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    rows = [Row(*fields.names)("k", "a", 1), Row(*fields.names)("k", "b", 600_000_001)]
    list(processor.handleInputRows(("k",), iter(rows), at_ms(0)))
    out = list(processor.handleExpiredTimer(("k",), at_ms(7_200_000), None))
    assert [r.n for r in out] == [1] * 10 + [2] * 50 + [1] * 10 + [0] and len(calls) == 4
