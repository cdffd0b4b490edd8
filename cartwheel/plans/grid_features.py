"""Features at regular emit times: windows ``[T - size, T)`` with T a multiple of the emit interval.

Events are first combined into panes, whose width divides every size and interval of the branch; only
panes go on, so the events of a hot user shrink before the shuffle. A pane is a row stamped with its last
microsecond; it changes what a window holds at two emit times, and values are the same from change to change.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel import schema
from cartwheel.config import RollingWindow
from cartwheel.functions.timeline import ceil_to, common_step, default_block, micros, position
from cartwheel.operators.branches import updated_total
from cartwheel.operators.rolling import MONEY, grid_times, last_time, pane_end, rolling_stats
from cartwheel.plans.event_features import average_order, pair_orders

USER = ("user_id",)


def pane_width(windows: Sequence[RollingWindow]) -> int:
    return micros(common_step([s for w in windows for s in (w.duration_seconds, w.emit_seconds)]))


def _stamp(windows: Sequence[RollingWindow]) -> Column:
    return pane_end(position("ts"), pane_width(windows)).alias("stamp")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _by_emit(windows: Sequence[RollingWindow]) -> list[list[RollingWindow]]:
    """Windows with the same emit interval go through one shuffle together."""
    emits = dict.fromkeys(w.emit_seconds for w in windows)
    return [[w for w in windows if w.emit_seconds == e] for e in emits]


def _in_reach(df: DataFrame, windows: Sequence[RollingWindow], pane: int, empty_rows: bool) -> DataFrame:
    """Of the times asked for the largest window, those that matter to the row's own window."""
    emit = micros(windows[0].emit_seconds)
    duration = F.element_at(
        F.create_map(*[F.lit(x) for w in windows for x in (w.label, micros(w.duration_seconds))]), F.col("window_size")
    )
    last = last_time(F.col("stamp"), pane, duration, emit)
    return (
        df.withColumn("empty", F.col("pos") > last)
        .where(F.col("pos") <= last + (emit if empty_rows else 0))
        .withColumn("emit_ts", F.timestamp_micros("pos"))
    )


def _asked_answers(
    counted: DataFrame,
    panes: DataFrame,
    keys: Sequence[str],
    windows: Sequence[RollingWindow],
    carry: Sequence[str] = (),
    empty_rows: bool = False,
    **measures: Sequence[str],
) -> DataFrame:
    """Rolling answers over ``counted`` (with ``pos``) at the emit times that ``panes`` calls for."""
    pane = pane_width(windows)
    parts = []
    for group in _by_emit(windows):
        sizes = {w.label: w.duration_seconds for w in group}
        largest, emit = micros(max(sizes.values())), micros(group[0].emit_seconds)
        asks = grid_times(panes, keys, largest, emit, pane, carry, empty_rows)
        rows = counted.select("*", F.lit(True).alias("counted"), F.lit(False).alias("asked")).unionByName(
            asks.select("*", F.lit(False).alias("counted"), F.lit(True).alias("asked")), allowMissingColumns=True
        )
        if "upto" in counted.columns:
            rows = rows.withColumn("upto", F.coalesce("upto", "pos"))
        stats = rolling_stats(rows, keys, sizes, carry=[*carry, "stamp"], **measures)
        parts.append(_in_reach(stats, group, pane, empty_rows))
    return _union(parts)


def _span(panes: DataFrame, window: RollingWindow, pane: int, stamp: str, upto: str) -> tuple[Column, Column]:
    """First and last emit time at which a window holds what came at ``stamp`` and stays as long as ``upto``."""
    emit = micros(window.emit_seconds)
    return ceil_to(F.col(stamp) + 1, emit), last_time(F.col(upto), pane, micros(window.duration_seconds), emit)


def _stretches(
    counted: DataFrame,
    keys: Sequence[str],
    windows: Sequence[RollingWindow],
    empty_rows: bool = False,
    *,
    sums: Sequence[str] = (),
    firsts: Sequence[str] = (),
    lows: Sequence[str] = (),
    highs: Sequence[str] = (),
    latest: Sequence[str] = (),
) -> DataFrame:
    """Per key and window the stretches of emit times (``_at`` to ``_until``) between changes, as long as the window holds
    a pane; with ``empty_rows`` also the first time after these, with ``empty`` set.

    ``counted`` has the keys, ``stamp``, the measures, and whether the row is a pane that ``holds`` the window
    open; optionally ``upto`` (as in ``rolling_stats``) and ``since`` (``firsts`` count once the pane stamped so has left).
    What a window holds changes only where a pane enters or leaves, so each pane gives a few rows of changes; running
    totals over these give the values, and ``_filled`` gives a row to each emit time. Lowest and
    highest values walk the panes of a window, whose number the window's length bounds. ``latest`` measures are
    those of the newest pane, null ones too.
    """
    pane = pane_width(windows)
    upto = "upto" if "upto" in counted.columns else "stamp"
    totals = [*sums, *firsts]
    marks = []
    for w in windows:
        emit = micros(w.emit_seconds)
        enter, last = _span(counted, w, pane, "stamp", upto)
        ever = enter <= last

        def mark(at: Column, sign: int, when: Column, *, row: bool = False, summed: Sequence[str] = (), change: bool = True) -> Column:
            """Measures that count from ``at`` on (or no longer), if ``when``."""
            signed = lambda m: (F.col(m) if sign > 0 else -F.col(m)).cast(counted.schema[m].dataType)
            null = lambda m: F.lit(None).cast(counted.schema[m].dataType)
            fields = [
                F.lit(w.label).alias("window_size"),
                at.alias("_at"),
                F.lit(change).alias("_change"),
                (F.when(F.col("holds"), sign).otherwise(0) if row and change else F.lit(0)).cast("long").alias("_held"),
                *[(signed(m) if m in summed else null(m)).alias(m) for m in totals],
                *[(F.col(m) if not change else null(m)).alias(m) for m in [*lows, *highs]],
                *([F.when(F.lit(row and sign > 0), F.col("stamp")).alias("_stamp")] if latest else []),
                *[(F.col(m) if row and sign > 0 else null(m)).alias(m) for m in latest],
            ]
            return F.when(when, F.struct(*fields))

        marks += [mark(enter, 1, ever, row=True, summed=sums), mark(last + emit, -1, ever, row=True, summed=sums)]
        if firsts:
            left = F.coalesce(last_time(F.col("since"), pane, micros(w.duration_seconds), emit) + emit, enter)
            first = F.greatest(enter, left)
            marks += [mark(first, 1, first <= last, summed=firsts), mark(last + emit, -1, first <= last, summed=firsts)]
        if lows or highs:
            marks.append(mark(F.col("stamp") + 1, 1, ever, change=False))
    changes = counted.select(*keys, F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull())).alias("_m")).select(*keys, "_m.*")
    changes = changes.groupBy(*keys, "window_size", "_at").agg(
        F.max("_change").alias("_change"),
        F.sum("_held").alias("_held"),
        *[F.sum(m).alias(m) for m in totals],
        *[F.min(m).alias(m) for m in lows],
        *[F.max(m).alias(m) for m in highs],
        *[F.max_by(m, "_stamp").alias(m) for m in latest],
        *([F.max("_stamp").alias("_stamp")] if latest else []),
    )
    order = Window.partitionBy(*keys, "window_size").orderBy("_at")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def inside(pick, m: str) -> Column:
        return F.coalesce(
            *[F.when(F.col("window_size") == w.label, pick(m).over(order.rangeBetween(pane - micros(w.duration_seconds), Window.currentRow))) for w in windows]
        )

    running = changes.select(
        *keys,
        "window_size",
        "_at",
        "_change",
        F.sum("_held").over(so_far).alias("_held"),
        *[F.coalesce(F.sum(m).over(so_far), F.lit(0)).alias(m) for m in totals],
        *[inside(F.min, m).alias(m) for m in lows],
        *[inside(F.max, m).alias(m) for m in highs],
        *[F.max_by(m, "_stamp").over(so_far).alias(m) for m in latest],
    ).where("_change")
    emit, empty = _emit(windows), F.col("_held") == 0
    # the last change of a key leaves its window empty, so every other row has a change ahead
    ahead = running.withColumn("_ahead", F.lead("_at").over(order)).withColumn("empty", empty)
    if not empty_rows:
        ahead = ahead.where(~empty)
    until = F.when(F.col("empty"), F.col("_at")).otherwise(F.col("_ahead") - emit)
    return ahead.withColumn("_until", until).where(F.col("_at") <= F.col("_until")).select(*keys, "window_size", "_at", "_until", "empty", *totals, *lows, *highs, *latest)


def _emit(windows: Sequence[RollingWindow]) -> Column:
    return F.element_at(F.create_map(*[x for w in windows for x in (F.lit(w.label), F.lit(micros(w.emit_seconds)).cast("long"))]), F.col("window_size"))


def _filled(stretches: DataFrame, windows: Sequence[RollingWindow]) -> DataFrame:
    """A row per emit time (``emit_ts``) of each stretch."""
    times = F.explode(F.sequence("_at", "_until", _emit(windows))).alias("_time")
    return stretches.select("*", times).withColumn("emit_ts", F.timestamp_micros("_time")).drop("_time", "_at", "_until")


def _times(windows: Sequence[RollingWindow]) -> Column:
    """The emit times of a stretch, in a list."""
    return F.transform(F.sequence("_at", "_until", _emit(windows)), F.timestamp_micros).alias("emit_ts")


def spread(held: DataFrame) -> DataFrame:
    """A row per time, of rows that list the times (``emit_ts``) at which they hold."""
    return held.withColumn("emit_ts", F.explode("emit_ts"))


EMITS_TOGETHER = 8


def _together(stretches: DataFrame, item: str, measures: Sequence[str], windows: Sequence[RollingWindow]) -> DataFrame:
    """Per user and window the stretches of emit times (``_at`` to ``_until``) in which the window holds the same
    ``items``, given in their order, each with its measures.

    A user's stretches are gathered once per few emit times and cut wherever one of them begins or ends.
    """
    span = F.col("_span")
    piece = F.struct(item, "_at", "_until", "empty", *measures)
    first, last = (F.floor(F.col(c) / span).cast("long") for c in ("_at", "_until"))
    pieces = stretches.withColumn("_span", EMITS_TOGETHER * _emit(windows)).select("user_id", "window_size", "_span", F.explode(F.sequence(first, last)).alias("_block"), piece.alias("_p"))
    gathered = pieces.groupBy("user_id", "window_size", "_span", "_block").agg(F.array_sort(F.collect_list("_p")).alias("_all"))
    begin = F.greatest(F.array_min(F.transform("_all", lambda p: p["_at"])), F.col("_block") * span)
    end = F.least(F.array_max(F.transform("_all", lambda p: p["_until"])), (F.col("_block") + 1) * span - _emit(windows))
    begins, ends = F.transform("_all", lambda p: p["_at"]), F.transform("_all", lambda p: p["_until"] + F.col("_step"))
    bounded = gathered.select("user_id", "window_size", "_all", begin.alias("_begin"), end.alias("_end"), _emit(windows).alias("_step"))
    cuts = F.filter(F.concat(begins, ends), lambda t: (t > F.col("_begin")) & (t <= F.col("_end")))
    bounded = bounded.select("user_id", "window_size", "_all", "_step", F.array_sort(F.array_distinct(F.concat(F.array("_begin"), cuts, F.array(F.col("_end") + F.col("_step"))))).alias("_cuts"))
    here = lambda t: F.filter("_all", lambda p: (p["_at"] <= t) & (p["_until"] >= t))
    until = lambda k: F.get("_cuts", k + 1) - F.col("_step")
    held = F.transform(F.slice("_cuts", F.lit(1), F.size("_cuts") - 1), lambda t, k: F.struct(t.alias("_at"), until(k).alias("_until"), here(t).alias("_here")))
    timed = bounded.select("user_id", "window_size", F.explode(held).alias("_s")).select("user_id", "window_size", "_s.*").where(F.size("_here") > 0)
    return timed.select("user_id", "window_size", "_at", "_until", F.filter("_here", lambda p: ~p["empty"]).alias("items"))


def _views(item: str) -> Column:
    return F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("n").isNotNull(), F.struct(item, "n")))))


def _items(answers: DataFrame, item: str, *measures: str) -> DataFrame:
    """Rows per item; one in which it has just left the window has no measures, and only keeps the window open."""
    return answers.select("user_id", item, "emit_ts", "window_size", *[F.when(~F.col("empty"), F.col(m)).alias(m) for m in measures])


def product_item_views(views: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = False) -> DataFrame:
    """Per user, product and emit time: views, earliest price in the window, price bounds."""
    return _items(_filled(_product_stretches(views, windows, empty_rows), windows), "product_id", *PRODUCT_MEASURES)


PRODUCT_MEASURES = ("n", "first_price", "low", "high")


def _product_stretches(views: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool) -> DataFrame:
    keys = ["user_id", "product_id"]
    return _stretches(_product_panes(views, windows), keys, windows, empty_rows, sums=["n"], firsts=["first_price"], lows=["low"], highs=["high"])


def _product_panes(views: DataFrame, windows: Sequence[RollingWindow]) -> DataFrame:
    price = F.col("product_price")
    panes = views.groupBy("user_id", "product_id", _stamp(windows)).agg(
        F.count("*").alias("n"),
        F.min(F.struct("ts", "event_id", price)).alias("first"),
        F.min(price).alias("low"),
        F.max(price).alias("high"),
    )
    return panes.repartition("user_id", "product_id").select(
        "user_id",
        "product_id",
        "stamp",
        F.lag("stamp").over(Window.partitionBy("user_id", "product_id").orderBy("stamp")).alias("since"),
        F.lit(True).alias("holds"),
        "n",
        F.col("first.product_price").cast(MONEY).alias("first_price"),
        "low",
        "high",
    )


def _viewed(item: str) -> Column:
    return F.map_from_entries(F.transform("items", lambda p: F.struct(p[item].alias(item), p["n"].alias("n"))))


def product_grid(views: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = True) -> DataFrame:
    return spread(product_held(views, windows, empty_rows))


def product_held(views: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = True) -> DataFrame:
    rows = _together(_product_stretches(views, windows, empty_rows), "product_id", PRODUCT_MEASURES, windows)
    total = F.aggregate("items", F.lit(0).cast(MONEY), lambda a, p: (a + p["first_price"]).cast(MONEY))
    some, zero = F.size("items") > 0, F.lit(0.0)
    each = lambda name: F.transform("items", lambda p: p[name])
    return rows.select(
        "user_id",
        _times(windows),
        "window_size",
        F.size("items").cast("long").alias("unique_product_count"),
        F.when(some, total.cast("double") / F.nullif(F.size("items"), F.lit(0))).otherwise(zero).alias("average_price"),
        F.when(some, F.array_min(each("low"))).otherwise(zero).alias("min_price"),
        F.when(some, F.array_max(each("high"))).otherwise(zero).alias("max_price"),
        _viewed("product_id").alias("views"),
    )


def summarise_products(items: DataFrame, time: str) -> DataFrame:
    """Product rows of one window to the window's feature row; items with a null count only keep the window open."""
    zero = F.lit(0.0)
    mean = F.sum("first_price").cast("double") / F.nullif(F.count("n"), F.lit(0))
    return items.groupBy("user_id", time, "window_size").agg(
        F.count("n").alias("unique_product_count"),
        F.when(F.count("n") == 0, zero).otherwise(mean).alias("average_price"),
        F.when(F.count("n") == 0, zero).otherwise(F.min("low")).alias("min_price"),
        F.when(F.count("n") == 0, zero).otherwise(F.max("high")).alias("max_price"),
        _views("product_id").alias("views"),
    )


LOG_BUCKETS = 12
"""Of a sketch: its relative standard error is about 1.04 / 2 ** (LOG_BUCKETS / 2), 1.6 %."""


def unique_products_approx(views: DataFrame, windows: Sequence[RollingWindow], item: str = "product_id") -> DataFrame:
    """How many products each user viewed, by a sketch per pane, merged over windows.

    A pane sends one sketch of a bounded size, however many views and products it holds.
    """
    pane = pane_width(windows)
    panes = views.groupBy("user_id", _stamp(windows)).agg(F.hll_sketch_agg(item, LOG_BUCKETS).alias("sketch"))
    parts = []
    for w in windows:
        emit = micros(w.emit_seconds)
        times = F.sequence(ceil_to(F.col("stamp") + 1, emit), last_time(F.col("stamp"), pane, micros(w.duration_seconds), emit), F.lit(emit))
        parts.append(panes.select("user_id", F.lit(w.label).alias("window_size"), F.explode(times).alias("pos"), "sketch"))
    merged = _union(parts).groupBy("user_id", "window_size", "pos").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_product_count"))
    return merged.select("user_id", F.timestamp_micros("pos").alias("emit_ts"), "window_size", "unique_product_count")


def category_item_views(views: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = False) -> DataFrame:
    return _items(_filled(_category_stretches(views, windows, empty_rows), windows), "category", "n")


def _category_stretches(views: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool) -> DataFrame:
    panes = (
        views.where(F.col("category").isNotNull())
        .groupBy("user_id", "category", _stamp(windows))
        .agg(F.count("*").alias("n"))
    )
    keys = ["user_id", "category"]
    counted = panes.repartition(*keys).select(*keys, "stamp", F.lit(True).alias("holds"), "n")
    return _stretches(counted, keys, windows, empty_rows, sums=["n"])


def category_grid(views: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = True) -> DataFrame:
    return spread(category_held(views, windows, empty_rows))


def category_held(views: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = True) -> DataFrame:
    rows = _together(_category_stretches(views, windows, empty_rows), "category", ["n"], windows)
    most = F.array_min(F.transform("items", lambda p: F.struct((-p["n"]).alias("n"), p["category"].alias("category"))))
    return rows.select(
        "user_id",
        _times(windows),
        "window_size",
        F.size("items").cast("long").alias("unique_category_count"),
        most["category"].alias("most_viewed_category"),
        _viewed("category").alias("views"),
    )


def summarise_categories(items: DataFrame, time: str) -> DataFrame:
    """Most views win; among equals the alphabetically smallest. Items with a null count only keep the window open."""
    most = F.min(F.when(F.col("n").isNotNull(), F.struct((-F.col("n")).alias("n"), "category")))
    return items.groupBy("user_id", time, "window_size").agg(
        F.count("n").alias("unique_category_count"),
        most["category"].alias("most_viewed_category"),
        _views("category").alias("views"),
    )


def _cart_panes(carts: DataFrame, windows: Sequence[RollingWindow]) -> DataFrame:
    value = updated_total("event_type", "previous_price", "product_price").alias("cart_value")
    return carts.groupBy("user_id", _stamp(windows)).agg(
        F.count_if(F.col("event_type") == schema.ADD).alias("adds"),
        F.count_if(F.col("event_type") == schema.REMOVE).alias("removes"),
        F.max(F.struct("ts", "event_id", value)).alias("newest"),
    )


def cart_grid(carts: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = True) -> DataFrame:
    panes = _cart_panes(carts, windows)
    counted = panes.select("user_id", F.col("stamp").alias("pos"), "adds", "removes")
    asking = panes.select("user_id", "stamp", "newest.cart_value")
    out = _asked_answers(counted, asking, USER, windows, ["cart_value"], empty_rows, sums=["adds", "removes"])
    return out.select(
        "user_id",
        "emit_ts",
        "window_size",
        "adds",
        "removes",
        (F.col("adds") + F.col("removes")).alias("update_frequency"),
        F.when(~F.col("empty"), F.col("cart_value")).alias("cart_value"),
    )


def cart_held(carts: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = True) -> DataFrame:
    """The rows of ``cart_grid`` with the list of the times at which they hold; carts go through changes here."""
    panes = _cart_panes(carts, windows)
    counted = panes.repartition("user_id").select("user_id", "stamp", F.lit(True).alias("holds"), "adds", "removes", "newest.cart_value")
    out = _stretches(counted, USER, windows, empty_rows, sums=["adds", "removes"], latest=["cart_value"])
    return out.select(
        "user_id",
        _times(windows),
        "window_size",
        "adds",
        "removes",
        (F.col("adds") + F.col("removes")).alias("update_frequency"),
        F.when(~F.col("empty"), F.col("cart_value")).alias("cart_value"),
    )


def purchase_grid(purchases: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = True) -> DataFrame:
    return spread(purchase_held(purchases, windows, empty_rows))


def purchase_held(purchases: DataFrame, windows: Sequence[RollingWindow], empty_rows: bool = True) -> DataFrame:
    width = pane_width(windows)
    orders = pair_orders(purchases, default_block([micros(w.duration_seconds) for w in windows]))
    counted = orders.groupBy(
        "user_id",
        pane_end(F.col("order_pos"), width).alias("stamp"),
        pane_end(F.col("cart_pos"), width).alias("upto"),
    ).agg(
        F.count("*").alias("orders_count"), F.sum(F.col("order_value").cast(MONEY)).cast(MONEY).alias("order_total")
    )
    panes = purchases.select("user_id", _stamp(windows)).distinct()
    rows = _union([
        counted.withColumn("holds", F.lit(False)),
        panes.select(
            "user_id", "stamp", F.col("stamp").alias("upto"), *[F.lit(0).cast(counted.schema[m].dataType).alias(m) for m in ("orders_count", "order_total")], F.lit(True).alias("holds")
        ),
    ])
    out = _stretches(rows.repartition("user_id"), USER, windows, empty_rows, sums=["orders_count", "order_total"])
    return out.select(
        "user_id",
        _times(windows),
        "window_size",
        "orders_count",
        F.col("order_total").cast("double").alias("order_value"),
        average_order(F.col("order_total"), F.col("orders_count")).alias("avg_order_value"),
    )
