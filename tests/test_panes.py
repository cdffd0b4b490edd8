"""All sizes over one state, open sessions, late rows: against plain loops, and in streams that stop and go on."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cartwheel import schema
from cartwheel.config import FeatureConfig, RollingWindow
from cartwheel.operators import branches
from cartwheel.plans import grid_features, pipeline, session_features
from cartwheel.plans.queries import tracker_json
from cartwheel.sources.events import file_events, with_event_time
from cartwheel.sources.table_events import shop_events_from_table
from cartwheel.streaming import open_sessions, panes
from tests.conftest import at
from tests.test_streaming import CASES, EVENTS, GAP, KEYS, WINDOWS, batch, folder, passed, rows_of, run, stream  # noqa: F401

# --- the operators by themselves ---------------------------------------------------------------------------


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Map(dict):
    containsKey, getValue, iterator = dict.__contains__, dict.__getitem__, dict.items

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        self.pop(key, None)


class Handle:
    """State of one key, and its timers."""

    def __init__(self):
        self.states, self.timers, self.reads = {}, set(), 0

    def getValueState(self, name, _):
        return self.states.setdefault(name, Value())

    def getMapState(self, name, *_):
        return self.states.setdefault(name, Map())

    def registerTimer(self, when):
        self.timers.add(when)

    def deleteTimer(self, when):
        self.timers.remove(when)


def drive(processor, batches, delay_ms):
    """Batches of rows through one key: rows first, then the timers the watermark has passed; the watermark follows."""
    handle, watermark, out = Handle(), 0, []
    processor.init(handle)
    for number, rows in enumerate([*batches, []]):
        clock = SimpleNamespace(getCurrentWatermarkInMs=lambda w=watermark: w)
        if rows:
            out += [(number, r) for r in processor.handleInputRows(("k",), iter(rows), clock)]
        for when in sorted(t for t in handle.timers if t < watermark):
            if when in handle.timers:
                handle.timers.remove(when)
                out += [(number, r) for r in processor.handleExpiredTimer(("k",), clock, None)]
        watermark = max([watermark, *(r[panes.MOMENT] // 1000 - delay_ms for r in rows)])
    return out, handle


KINDS = [schema.ADD, schema.ADD, schema.REMOVE, schema.CHECKOUT]
FIELDS = ("event_type", "event_id", "value", "product_price", "cart_total", "cart_price", "completed", panes.MOMENT)


def random_rows(rng, n, span):
    rows = []
    for i in range(n):
        moment, amount = rng.randrange(span * 1000) * 1000 + rng.choice([0, 1, 999]), rng.randrange(1000) / 100
        kind = rng.choice(KINDS)
        rows.append(Row(*FIELDS)(kind, f"e{i:04d}", amount, amount, amount * 2, amount, kind == schema.CHECKOUT and rng.random() < 0.7, moment))
    return rows


def loop_orders(rows):
    cart, values = None, []
    for r in sorted(rows, key=lambda r: (r[panes.MOMENT], r.event_id)):
        if r.event_type != schema.CHECKOUT:
            cart = r
        elif r.completed and cart is not None:
            values.append(cart.cart_total + (cart.cart_price if cart.event_type == schema.ADD else -cart.cart_price))
            cart = None
    return len(values), round(sum(values), 6)


def loop_features(algebra, rows):
    first = sorted(rows, key=lambda r: (r[panes.MOMENT], r.event_id))
    if isinstance(algebra, panes.Orders):
        return loop_orders(rows)
    if isinstance(algebra, panes.Carts):
        return sum(r.event_type == schema.ADD for r in rows), sum(r.event_type == schema.REMOVE for r in rows), first[-1].value if first else None
    if isinstance(algebra, panes.Products):
        prices = [r.product_price for r in rows]
        return (len(rows), first[0].product_price, min(prices), max(prices)) if rows else (None,) * 4
    return (len(rows) or None,)


def plain(algebra, values):
    return (values[0], round(float(values[1]), 6)) if isinstance(algebra, panes.Orders) else tuple(values)


SIZES = [RollingWindow("a", 600, 60, 1), RollingWindow("b", 90, 30, 1), RollingWindow("c", 3600, 120, 1)]


@pytest.mark.parametrize("algebra", [panes.Carts(), panes.Products(), panes.Categories(), panes.Orders()], ids=lambda a: type(a).__name__)
def test_windows_against_a_loop(algebra):
    """Rows in time, in small and large batches: every emit time the watermark has passed, and one empty row."""
    rng = random.Random(8)
    names = ["user_id", "window_size", "emit_ts", *[f.split()[0] for f in algebra.output.split(", ")]]
    for case in range(60):
        rows = random_rows(rng, rng.choice([1, 5, 40, 200]), rng.choice([100, 2000, 20000]))
        arrival = sorted(rows, key=lambda r: r[panes.MOMENT] + rng.randrange(20_000_000))
        step = rng.choice([1, 7, 400])
        got, handle = drive(panes.PaneRing(algebra, SIZES, names), [arrival[i : i + step] for i in range(0, len(rows), step)], 20_000)
        watermark = max(r[panes.MOMENT] for r in rows) // 1000 - 20_000
        want = []
        for label, size, emit in [(w.label, w.duration_seconds * 1000, w.emit_seconds * 1000) for w in SIZES]:
            before = False
            for end in range(0, watermark + 1, emit):
                inside = [r for r in rows if end - size <= r[panes.MOMENT] // 1000 < end]
                if inside or before:
                    want.append((label, end, loop_features(algebra, inside)))
                before = bool(inside)
        assert sorted((r.window_size, round(r.emit_ts.timestamp() * 1000), plain(algebra, tuple(r)[3:])) for _, r in got) == sorted(want), case
        if not handle.timers:
            assert not handle.states["panes"] and not handle.states["fronts"] and not handle.states["head"].exists()


@pytest.mark.parametrize("algebra", [panes.Carts(), panes.Orders()], ids=lambda a: type(a).__name__)
def test_late_rows_count_from_then_on(algebra):
    """Any arrival: a row emitted in a batch holds all rows that had arrived and were taken, each once."""
    rng = random.Random(9)
    names = ["user_id", "window_size", "emit_ts", *[f.split()[0] for f in algebra.output.split(", ")]]
    seen = 0
    for _ in range(60):
        rows = random_rows(rng, 60, 4000)
        arrival = sorted(rows, key=lambda r: r[panes.MOMENT] + rng.randrange(1_500_000_000))
        batches = [arrival[i : i + 6] for i in range(0, 60, 6)]
        got, _ = drive(panes.PaneRing(algebra, SIZES, names), batches, 5_000)
        watermark, taken = 0, []
        for number, rows in enumerate(batches):
            for r in rows:
                time = r[panes.MOMENT] // 1000
                if any(panes.takes(time, watermark, w.duration_seconds * 1000, w.emit_seconds * 1000) for w in SIZES):
                    taken.append((number, r))
                    seen += time < watermark
            watermark = max([watermark, *(r[panes.MOMENT] // 1000 - 5_000 for r in rows)])
        sizes = {w.label: w.duration_seconds * 1000 for w in SIZES}
        for number, r in got:
            end = round(r.emit_ts.timestamp() * 1000)
            inside = [x for m, x in taken if m <= number and end - sizes[r.window_size] <= x[panes.MOMENT] // 1000 < end]
            assert plain(algebra, tuple(r)[3:]) == loop_features(algebra, inside)
        keys = [(r.window_size, r.emit_ts) for _, r in got]
        assert len(keys) == len(set(keys))
    assert seen > 50


def test_an_emit_reads_few_panes():
    """Reads and writes of the state per emit do not grow with the window."""
    counts = []
    for minutes in (60, 600):
        rows = [r for i in range(3 * minutes) for r in random_rows(random.Random(i), 1, 1)]
        rows = [Row(*FIELDS)(*[60_000_000 * i + 5 if n == panes.MOMENT else r[n] for n in FIELDS]) for i, r in enumerate(rows)]
        names = ["user_id", "window_size", "emit_ts", "adds", "removes", "cart_value"]
        processor = panes.PaneRing(panes.Carts(), [RollingWindow("w", minutes * 60, 60, 1)], names)
        calls = 0

        class Counted(Map):
            def getValue(self, key):
                nonlocal calls
                calls += 1
                return self[key]

            def updateValue(self, key, value):
                nonlocal calls
                calls += 1
                self[key] = value

            def iterator(self):
                nonlocal calls
                calls += len(self)
                return self.items()

        handle = Handle()
        handle.states = {"panes": Counted(), "fronts": Counted()}
        processor.init(handle)
        for r in rows:
            clock = SimpleNamespace(getCurrentWatermarkInMs=lambda t=r[panes.MOMENT] // 1000 - 1: t)
            list(processor.handleInputRows(("k",), iter([r]), clock))
            handle.timers.clear()
            list(processor.handleExpiredTimer(("k",), clock, None))
        counts.append(calls / len(rows))
    assert counts[1] < 1.3 * counts[0] and counts[1] < 12


# --- sessions ----------------------------------------------------------------------------------------------

VISIT = (*open_sessions.COLUMNS, panes.MOMENT)


def loop_session(rows):
    rows = sorted(rows, key=lambda r: (r[panes.MOMENT], r.event_id))
    kinds = [r.event_type for r in rows]
    counts = [kinds.count(schema.PAGE_VIEW), sum(r.searched for r in rows), kinds.count(schema.PRODUCT_VIEW), kinds.count(schema.ADD)]
    regions = [r.region for r in rows if r.region is not None]
    places = (sorted(set(regions)), sum(a != b for a, b in zip(regions, regions[1:]))) if regions else (None, None)
    return *counts, rows[-1].user_id, next((r.campaign for r in rows if r.has_marketing), None), list(dict.fromkeys(r.device for r in rows)), rows[-1].platform, *places


def test_sessions_against_a_loop():
    rng = random.Random(10)
    kinds = [schema.PAGE_VIEW, schema.PRODUCT_VIEW, schema.ADD, schema.REMOVE]
    names = [f.strip().split()[0] for f in open_sessions.OUTPUT.split(",")]
    for gap, emit in ((30, 10), (30, 60), (45, 20)):
        for _ in range(40):
            n, span = rng.choice([1, 4, 30, 90]), rng.choice([50, 900, 5000])
            rows = [
                Row(*VISIT)(f"e{i:03d}", rng.choice(kinds), rng.choice("uv"), rng.random() < 0.3, rng.choice(["Desktop", "Phone", None]), rng.choice("wm"), rng.random() < 0.2, rng.choice(["x", "y"]), rng.choice(["n", "s", None]), rng.randrange(span * 1000) * 1000)
                for i in range(n)
            ]
            arrival, step = sorted(rows, key=lambda r: r[panes.MOMENT] + rng.randrange(8_000_000)), rng.choice([1, 9, 100])
            got, _ = drive(open_sessions.OpenSessions(gap, emit, names), [arrival[i : i + step] for i in range(0, n, step)], 8_000)
            watermark = max(r[panes.MOMENT] for r in rows) // 1000 - 8_000
            sessions = []
            for r in sorted(rows, key=lambda r: r[panes.MOMENT]):
                if sessions and r[panes.MOMENT] // 1000 - sessions[-1][-1][panes.MOMENT] // 1000 <= gap * 1000:
                    sessions[-1].append(r)
                else:
                    sessions.append([r])
            want = []
            for session in sessions:
                start, closing = session[0][panes.MOMENT] // 1000, session[-1][panes.MOMENT] // 1000 + gap * 1000
                for end in range((start // (emit * 1000) + 1) * emit * 1000, min(watermark, closing) + 1, emit * 1000):
                    want.append((start, end, False, loop_session([r for r in session if r[panes.MOMENT] // 1000 < end])))
                if closing <= watermark:
                    want.append((start, closing, True, loop_session(session)))
            ms = lambda t: round(t.timestamp() * 1000)
            assert sorted(((ms(r.session_start), ms(r.as_of), r.closed, tuple(r)[5:]) for _, r in got), key=str) == sorted(want, key=str)


# --- as streams --------------------------------------------------------------------------------------------

STREAMED = {"cart": panes.cart_features, "product": panes.product_features, "category": panes.category_features, "purchase": panes.purchase_features}


@pytest.mark.parametrize("name", list(CASES))
def test_all_sizes_equal_batch(spark, folder, tmp_path, name):  # noqa: F811
    """One query, all sizes; many small batches."""
    _, project, grid, columns = CASES[name]
    got = rows_of(run(STREAMED[name](stream(spark, folder), WINDOWS), tmp_path, f"panes_{name}"), *KEYS, *columns)
    want = grid(project(batch(spark, folder)), WINDOWS).where(F.col("emit_ts") <= passed(spark, folder))
    want = rows_of(want, *KEYS, *columns)
    assert len(want) > 100 and got == want


def test_a_stateful_stream_goes_on_where_it_stopped(spark, folder, tmp_path):  # noqa: F811
    """Stopped between two runs on one checkpoint, with panes, fronts and timers in its state."""
    from cartwheel.plans.stream_queries import finish

    rows = batch(spark, folder)
    middle = rows.agg(F.percentile_approx("ts", 0.5)).first()[0]
    source = str(tmp_path / "source")
    for part in (F.col("ts") < F.lit(middle), F.col("ts") >= F.lit(middle)):
        rows.where(part).coalesce(1).write.mode("append").parquet(source)
        arriving = with_event_time(spark.readStream.schema(rows.schema).parquet(source), delay="4 minutes")
        out = finish(panes.purchase_features(arriving, WINDOWS), "restarted", str(tmp_path / "work"))
    want = grid_features.purchase_grid(branches.purchase_events(rows), WINDOWS).where(F.col("emit_ts") <= passed(spark, folder))
    columns = (*KEYS, "orders_count", "order_value", "avg_order_value")
    assert rows_of(out, *columns) == rows_of(want, *columns)


def test_late_rows_are_in_later_windows_or_kept(spark, tmp_path):
    from cartwheel.plans.stream_queries import finish

    windows = [RollingWindow("10m", 600, 60, 900)]
    parts = [[(1, 29), (2, 30)], [(3, 25), (4, 10), (5, 31)], [(6, 60)]]
    source = str(tmp_path / "source")
    for part in parts:
        rows = [(i, at(t), 7, "click", 1.0, '{"k": 1}') for i, t in part]
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(source)
        arriving = lambda: with_event_time(shop_events_from_table(spark.readStream.schema(EVENTS).parquet(source)), delay="0 seconds")
        carts = finish(panes.cart_features(arriving(), windows), "late", str(tmp_path / "carts"))
        late = finish(panes.late_rows(arriving(), windows), "late", str(tmp_path / "late"))
    adds = {r.emit_ts: r.adds for r in carts.collect()}
    naive = lambda t: at(t).replace(tzinfo=None)
    # the row of minute 25 comes when the watermark is at 30: it counts from 31 to 35, then leaves
    assert [adds[naive(t)] for t in (30, 31, 32, 35, 36, 39, 40, 41, 42)] == [1, 3, 4, 4, 3, 3, 2, 1, 0]
    assert {(r.event_id, r.missed) for r in late.collect()} == {("3", False), ("4", True)}


PROPERTIES = {
    "metric.sizes": "5min,20min,1hr",
    **{
        f"metric.{b}.{s}.{k}_seconds": v
        for b in ("product", "category", "cart", "purchase")
        for s, d in (("5min", "300"), ("20min", "1200"), ("1hr", "3600"))
        for k, v in (("duration", d), ("emit", "60"), ("ttl", "900"))
    },
    "metric.session.gap_seconds": "240",
    "metric.session.emit_seconds": "30",
    "metric.session.ttl_seconds": "3600",
}


def test_job_of_three_sizes_on_one_batch(spark, folder, tmp_path):  # noqa: F811
    """Everything in one batch: the table holds what the batch grid has at the last emit time passed, for every size."""
    config = FeatureConfig.from_properties(PROPERTIES)
    events = batch(spark, folder)
    raw = str(tmp_path / "raw")
    tracker_json(events).coalesce(1).write.text(raw)
    late = str(tmp_path / "late")
    queries = pipeline.run_stream(
        file_events(spark, raw, streaming=True), config, str(tmp_path / "s"), str(tmp_path / "cp"), reshaped=False, once=True, delay="4 minutes", late_path=late
    )
    for query in queries:
        query.awaitTermination()
    kept = pipeline.stores(spark, str(tmp_path / "s"), config)
    for branch in ("cart", "product", "category", "purchase"):
        project, grid = pipeline.BATCH_FEATURES[branch]
        features = grid(project(events), config.windows(branch)).where(F.col("emit_ts") <= passed(spark, folder))
        want = {}
        for r in pipeline._metrics(features, branch, config.windows(branch)).collect():
            want[r.name] = max(want.get(r.name, (r.emit_ts, r.value)), (r.emit_ts, r.value))
        got = {r.name: (r.emit_ts, r.value) for r in kept[branch].latest().collect()}
        assert len(got) > 5 and got == want
    # sessions: closed ones as in a batch, and open ones are there too
    closed = session_features.shop_sessions(branches.session_events(events), 240).where(F.col("close_ts") <= passed(spark, folder))
    rows = kept["session"].rows()
    pages = {(r.name, r.emit_ts): r.value for r in rows.where("name LIKE '%:session_page_count'").collect()}
    newest = {}
    for r in closed.collect():
        newest[r.session_id] = max(newest.get(r.session_id, (r.close_ts, 0)), (r.close_ts, r.page_views))
    known = {name.split(":")[1]: (time, int(value)) for (name, time), value in pages.items()}
    for session, (time, views) in newest.items():
        assert known[session] > (time, -1) or known[session] == (time, views)
    assert rows.select(F.substring_index("name", ":", -1)).distinct().count() >= 7
    assert not spark.read.schema("event_id string").json(late).count()


def test_a_batch_of_many_panes_calls_the_state_a_few_times():
    """Panes and fronts share entries of the state, and what is not there is not asked for."""
    calls = 0

    class Counted(Map):
        def __getitem__(self, key):
            nonlocal calls
            calls += 1
            return super().__getitem__(key)

        def __setitem__(self, key, value):
            nonlocal calls
            calls += 1
            super().__setitem__(key, value)

        def removeKey(self, key):
            nonlocal calls
            calls += 1
            self.pop(key)

        def containsKey(self, key):
            nonlocal calls
            calls += 1
            return key in self

        getValue, updateValue = __getitem__, __setitem__

    names = ["user_id", "window_size", "emit_ts", "adds", "removes", "cart_value"]
    processor, handle = panes.PaneRing(panes.Carts(), [RollingWindow("w", 1200, 60, 1)], names), Handle()
    handle.states = {"panes": Counted(), "fronts": Counted()}
    processor.init(handle)
    rows = [Row(*FIELDS)(schema.ADD, f"e{i:03d}", 1.0, 1.0, 1.0, 1.0, False, 60_000_000 * i + 5) for i in range(200)]
    assert not list(processor.handleInputRows(("k",), iter(rows), SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)))
    out = list(processor.handleExpiredTimer(("k",), SimpleNamespace(getCurrentWatermarkInMs=lambda: 199 * 60_000), None))
    assert [r.adds for r in out] == [min(i, 20) for i in range(1, 200)]
    assert calls < 40 and all(len(v[0]) < 2 * panes.PAGE for s in ("panes", "fronts") for v in dict.values(handle.states[s]))
