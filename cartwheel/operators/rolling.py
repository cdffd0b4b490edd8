"""Rolling windows ``[T - size, T]`` per key.

``rolling_stats`` covers everything that combines from parts. Each counted row is in the window for one
span of T, so a running total of entries minus exits gives sums at any T; lowest and highest values are
combined from the two cut blocks at the window's ends and the whole blocks between them. Work is split
by (key, time block): a hot key is never sorted or held in one task, and every step is linear in the
rows, where a sliding range frame would walk the whole frame again for each row.

``rolling_features`` takes any aggregate column and therefore needs a window's rows in one place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.timeline import (
    BLOCK,
    block_of,
    ceil_to,
    default_block,
    floor_to,
    micros,
    position,
)

MONEY = "decimal(38,12)"
"""Amounts are added as decimals: totals do not depend on row order, and what leaves a window cancels
exactly what entered it."""


def rolling_stats(
    rows: DataFrame,
    keys: Sequence[str],
    sizes: Mapping[str, int | None],
    *,
    sums: Sequence[str] = (),
    firsts: Sequence[str] = (),
    lows: Sequence[str] = (),
    highs: Sequence[str] = (),
    carry: Sequence[str] = (),
    block: int | None = None,
) -> DataFrame:
    """One row per (asked row, size label), with ``keys``, ``pos``, ``carry``, ``window_size``, measures.

    ``rows`` holds ``keys``, ``pos`` (microseconds), the measures, and optionally
    ``asked``    the row asks for an answer at T = pos (default true)
    ``counted``  the row contributes its measures (default true)
    ``upto``     the row stays in the window while ``T - size <= upto`` (default pos)
    ``since``    measures in ``firsts`` count only once ``T - size > since`` (default: always); with the
                 position of the previous row of the same item this counts the item's first row only
    ``sizes`` maps labels to seconds; ``None`` means no lower bound (sums only). Sum measures must be
    integers or decimals.
    """
    has = set(rows.columns)
    extremes = [*lows, *highs]
    labels = list(sizes)
    spans = [None if sizes[x] is None else micros(sizes[x]) for x in labels]
    if extremes and ("upto" in has or None in spans):
        raise ValueError("lowest and highest values need bounded windows that end at pos")
    width = block or default_block([s for s in spans if s is not None])
    if extremes and any(s % width for s in spans):
        raise ValueError("the block must divide every window size")

    pos, role, at = F.col("pos"), F.col("_role"), F.col("_at")
    measures = list(dict.fromkeys([*sums, *firsts, *extremes]))
    rows = rows.select(
        *keys,
        "pos",
        *carry,
        *measures,
        (F.col("asked") if "asked" in has else F.lit(True)).alias("asked"),
        (F.col("counted") if "counted" in has else F.lit(True)).alias("counted"),
        (F.col("upto") if "upto" in has else pos).alias("upto"),
        (F.col("since") if "since" in has else F.lit(None).cast("long")).alias("since"),
    )
    counted, since, upto = F.col("counted"), F.col("since"), F.col("upto")

    # Role 0 is the row itself, i its leaving size i, -i its late arrival as a first row in size i.
    marks = [F.struct(pos.alias("_at"), F.lit(0).alias("_role"))]
    for i, span in enumerate(spans, 1):
        if span is None:
            continue
        leaves = F.struct((upto + span).alias("_at"), F.lit(i).alias("_role"))
        marks.append(F.when(counted & (upto + span >= pos), leaves))
        if firsts and "since" in has:
            joins = F.struct((since + span + 1).alias("_at"), F.lit(-i).alias("_role"))
            marks.append(F.when(counted & (since < pos) & (since + span >= pos), joins))
    points = (
        rows.withColumn("_mark", F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull())))
        .select(*keys, "pos", *carry, *measures, "asked", "counted", "since", "upto", "_mark.*")
        .withColumn(BLOCK, block_of(at, width))
        .repartition(*keys, BLOCK)
    )

    own = (role == 0) & counted
    enter, leave, extreme = {}, {}, {}
    for i, span in enumerate(spans, 1):
        for m in sums:
            in_time = own & (upto + span >= pos) if "upto" in has and span else own
            enter[m, i] = F.when(in_time, F.col(m))
            leave[m, i] = F.when(role == i, F.col(m))
        for m in firsts:
            on_time = own & (since.isNull() | (since + (span or 0) < pos))
            enter[m, i] = F.when(on_time | (role == -i), F.col(m))
            leave[m, i] = F.when((role == i) & (since.isNull() | (since < pos)), F.col(m))
    for m in extremes:
        extreme[m] = F.when(own, F.col(m))
    pick = {**dict.fromkeys(lows, F.min), **dict.fromkeys(highs, F.max)}
    if len(pick) < len(extremes):
        raise ValueError("a measure is either a lowest or a highest value")

    # Per block: totals, then what the blocks before it leave behind. Reading all columns of the points,
    # the totals share the exchange of the points themselves: rows are computed and shuffled once.
    asked = F.when((role == 0) & F.col("asked"), F.xxhash64("pos", at, *carry))
    per_block = points.groupBy(*keys, BLOCK).agg(
        F.max(asked).isNotNull().alias("_asked"),
        *[(F.sum(c)).alias(f"_in_{m}_{i}") for (m, i), c in enter.items()],
        *[(F.sum(c)).alias(f"_out_{m}_{i}") for (m, i), c in leave.items()],
        *[pick[m](c).alias(f"_ext_{m}") for m, c in extreme.items()],
    )
    over_key = Window.partitionBy(*keys).orderBy(BLOCK)
    before = over_key.rowsBetween(Window.unboundedPreceding, -1)

    def whole_blocks(m: str, span: int) -> Column:
        n = span // width
        if n < 2:
            return F.lit(None)
        return pick[m](f"_ext_{m}").over(over_key.rangeBetween(-(n - 1), -1))

    base = per_block.select(
        *keys,
        BLOCK,
        "_asked",
        *[_net(f"_in_{m}_{i}", f"_out_{m}_{i}", before, before).alias(f"_base_{m}_{i}") for m, i in enter],
        *[
            whole_blocks(m, span).cast(rows.schema[m].dataType).alias(f"_mid_{m}_{i}")
            for m in extremes
            for i, span in enumerate(spans, 1)
        ],
    ).where("_asked")

    # Inside a block: running values up to and including T; exits count strictly after.
    rising = Window.partitionBy(*keys, BLOCK).orderBy("_at")
    falling = Window.partitionBy(*keys, BLOCK).orderBy(F.col("_at").desc())
    to_now = rising.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    to_just_before = rising.rangeBetween(Window.unboundedPreceding, -1)
    from_now = falling.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = points.select(
        *keys,
        BLOCK,
        "pos",
        *carry,
        "asked",
        "_role",
        *[_net(enter[k], leave[k], to_now, to_just_before).alias(f"_run_{k[0]}_{k[1]}") for k in enter],
        *[pick[m](extreme[m]).over(to_now).alias(f"_head_{m}") for m in extremes],
        *[
            pick[m](F.when(role == i, F.col(m))).over(from_now).alias(f"_rest_{m}_{i}")
            for m in extremes
            for i in range(1, len(spans) + 1)
        ],
    ).where((F.col("_role") == 0) & F.col("asked"))

    joined = inside.join(base, [*keys, BLOCK], "left")
    ends = {m: (F.least if m in lows else F.greatest) for m in extremes}

    def answer(i: int, label: str) -> Column:
        return F.struct(
            F.lit(label).alias("window_size"),
            *[
                (F.coalesce(F.col(f"_base_{m}_{i}"), F.lit(0)) + F.col(f"_run_{m}_{i}")).alias(m)
                for m in dict.fromkeys([*sums, *firsts])
            ],
            *[
                ends[m](F.col(f"_head_{m}"), F.col(f"_rest_{m}_{i}"), F.col(f"_mid_{m}_{i}")).alias(m)
                for m in extremes
            ],
        )

    answers = F.explode(F.array(*[answer(i, x) for i, x in enumerate(labels, 1)]))
    return joined.select(*keys, "pos", *carry, answers.alias("_a")).select(*keys, "pos", *carry, "_a.*")


def _net(enter, leave, enter_frame, leave_frame) -> Column:
    return F.coalesce(F.sum(enter).over(enter_frame), F.lit(0)) - F.coalesce(
        F.sum(leave).over(leave_frame), F.lit(0)
    )


def pane_end(pos: Column, pane: int) -> Column:
    """Last microsecond of the pane a position falls in: where a grid run stamps the pane's rows."""
    return floor_to(pos, pane) + F.lit(pane - 1)


def last_time(stamp: Column, pane: int, duration: Column | int, emit: int) -> Column:
    """Last emit time at which a window of ``duration`` still holds the pane."""
    return floor_to(stamp + 1 - pane + duration, emit)


def grid_times(
    panes: DataFrame,
    keys: Sequence[str],
    duration: int,
    emit: int,
    pane: int,
    carry: Sequence[str] = (),
    empty_rows: bool = False,
) -> DataFrame:
    """Emit times (column ``pos``) at which a window over ``panes`` is not empty, each exactly once.

    ``panes`` has one row per (keys, ``stamp``), with ``pane_end`` as the stamp. Every pane row gives the
    times from its own first one up to the next pane's first one, so ``stamp`` and ``carry`` belong to the
    newest pane in the window. With ``empty_rows`` the first empty time after each stretch is added.
    Arguments are in microseconds. A key has at most one row per pane here, so its window stays small.
    """
    ahead = F.lead("_first").over(Window.partitionBy(*keys).orderBy("stamp"))
    timed = panes.withColumn("_first", ceil_to(F.col("stamp") + 1, emit)).withColumn("_ahead", ahead)
    stop = last_time(F.col("stamp"), pane, duration, emit) + (emit if empty_rows else 0)
    stop = F.least(stop, F.col("_ahead") - emit)
    times = F.when(F.col("_first") <= stop, F.sequence(F.col("_first"), stop, F.lit(emit)))
    return timed.select(*keys, *carry, "stamp", F.explode(times).alias("pos"))


def rolling_features(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    sizes: Mapping[str, int],
    aggs: Mapping[str, Column],
    mode: str = "event",
    emit_seconds: int | None = None,
) -> DataFrame:
    """Any aggregate columns over rolling windows; the extension point for own features.

    ``event``: closed windows ending at each row. ``grid``: windows ``[T - size, T)`` at multiples of
    ``emit_seconds``, also on streams. In event mode rows go to the block of the widest size they fall in
    and to the next one, so a task needs two windows' worth of one key, not the key's whole history.
    """
    if mode == "grid":
        parts = []
        for label, seconds in sizes.items():
            span = F.window(ts, f"{seconds} seconds", f"{emit_seconds} seconds")
            parts.append(
                df.groupBy(*keys, span.alias("_w"))
                .agg(*[c.alias(n) for n, c in aggs.items()])
                .select(*keys, F.lit(label).alias("window_size"), F.col("_w.end").alias("emit_ts"), *aggs)
            )
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    width = micros(max(sizes.values()))
    first = block_of(position(ts), width)
    copies = df.withColumn("_pos", position(ts)).withColumn(
        BLOCK, F.explode(F.array(first, first + 1))
    )
    order = Window.partitionBy(*keys, BLOCK).orderBy("_pos")
    wide = copies.select(
        *df.columns,
        BLOCK,
        "_pos",
        *[
            c.over(order.rangeBetween(-micros(s), Window.currentRow)).alias(f"{n}_{label}")
            for label, s in sizes.items()
            for n, c in aggs.items()
        ],
    )
    return wide.where(F.col(BLOCK) == block_of(F.col("_pos"), width)).drop(BLOCK, "_pos")
