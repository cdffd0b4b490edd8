"""Exact keyed operators with state and event-time timers.

They emit what the native windows cannot: the zero row when a rolling window empties, sessions while they
are still open, and orders paired in time order. State per key is what its open windows need.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cartwheel import schema
from cartwheel.config import RollingWindow

WindowFunction = Callable[[Sequence[Row]], tuple]
"""Rows of one window in time order to the feature values."""

LONG = T.StructType([T.StructField("value", T.LongType())])
MOMENT = "_moment"
"""Event time in microseconds: plain numbers mean the same in every worker's time zone."""

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def from_micros(moment: int) -> datetime:
    return EPOCH + timedelta(microseconds=moment)


def from_ms(ms: int) -> datetime:
    return from_micros(ms * 1000)


def after(ms: int, step: int) -> int:
    """First multiple of ``step`` later than ``ms``."""
    return (ms // step + 1) * step


class _Buffered(StatefulProcessor):
    """Keeps a key's events in list state until subclasses let go of them."""

    def __init__(self, events: T.StructType, output: str) -> None:
        self.state_schema = T.StructType([f for f in events.fields if f.dataType != T.TimestampType()])
        self.names = self.state_schema.names
        self.moment, self.order = self.names.index(MOMENT), self.names.index("event_id")
        self.output_names = T.StructType.fromDDL(output).names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", self.state_schema)
        self.timer = handle.getValueState("timer", LONG)

    def _time(self, event) -> int:
        return event[self.moment] // 1000

    def _named(self, event) -> Row:
        return Row(*self.names)(*event)

    def _all_named(self, events: Sequence) -> list[Row]:
        make = Row(*self.names)
        return [make(*e) for e in events]

    def _out(self, *values) -> Row:
        return Row(*self.output_names)(*values)

    def _add(self, rows: Iterator[Row]) -> list:
        fresh = [tuple(r[n] for n in self.names) for r in rows]
        self.events.appendList(fresh)
        return fresh

    def _load(self) -> list:
        return sorted(self.events.get(), key=lambda e: (e[self.moment], e[self.order]))

    def _keep(self, events: Sequence) -> None:
        if events:
            self.events.put([tuple(e) for e in events])
        else:
            self.events.clear()

    def _set_timer(self, when: int | None) -> None:
        """One live timer per key, to act as soon as the watermark has reached ``when``.

        Timers fire when the watermark is past them, hence the millisecond less.
        """
        when = None if when is None else when - 1
        found = self.timer.get()
        if found is not None:
            if found[0] == when:
                return
            self.handle.deleteTimer(found[0])
            if when is None:
                self.timer.clear()
        if when is not None:
            self.handle.registerTimer(when)
            self.timer.update((when,))

    def close(self) -> None:
        pass


class RollingProcessor(_Buffered):
    """Windows ``[T - size, T)`` at multiples of each window's emit interval, all sizes over one state."""

    def __init__(
        self, events: T.StructType, output: str, windows: Sequence[RollingWindow], fn: WindowFunction
    ) -> None:
        super().__init__(events, output)
        self.windows = [(w.label, w.duration_seconds * 1000, w.emit_seconds * 1000) for w in windows]
        self.fn = fn

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        # next emit time per window, in the order of the windows
        self.next = handle.getListState("next", LONG)

    def _nexts(self) -> list:
        found = [n[0] for n in self.next.get()] if self.next.exists() else []
        return found or [None] * len(self.windows)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fresh = self._add(rows)
        first = min(self._time(e) for e in fresh)
        nexts = [
            min(n or after(first, emit), after(first, emit)) for n, (_, _, emit) in zip(self._nexts(), self.windows)
        ]
        self.next.put([(n,) for n in nexts])
        self._set_timer(min(nexts))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.timer.clear()
        watermark = timerValues.getCurrentWatermarkInMs()
        events = self._load()
        times, named = [self._time(e) for e in events], self._all_named(events)
        make, nexts, out = Row(*self.output_names), [], []
        for (label, size, emit), at in zip(self.windows, self._nexts()):
            held = None
            while at is not None and at <= watermark:
                inside = (bisect_left(times, at - size), bisect_left(times, at))
                if inside != held:
                    rows, held = named[slice(*inside)], inside
                    values = self.fn(rows)
                out.append(make(*key, label, from_ms(at), *values))
                if rows:
                    at += emit
                else:  # empty: once, then not before the next event
                    at = after(times[inside[1]], emit) if inside[1] < len(times) else None
            nexts.append(at)
        needed = [n - size for n, (_, size, _) in zip(nexts, self.windows) if n is not None]
        self._keep([e for e, t in zip(events, times) if needed and t >= min(needed)])
        if needed:
            self.next.put([(n,) for n in nexts])
        else:
            self.next.clear()
        self._set_timer(min((n for n in nexts if n is not None), default=None))
        return iter(out)


class SessionProcessor(_Buffered):
    """Sessions re-emitted at multiples of ``emit`` while open, and once more when they close."""

    def __init__(
        self, events: T.StructType, output: str, gap_seconds: int, emit_seconds: int, fn: WindowFunction
    ) -> None:
        super().__init__(events, output)
        self.gap, self.emit, self.fn = gap_seconds * 1000, emit_seconds * 1000, fn

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.emitted, self.make = handle.getValueState("emitted", LONG), Row(*self.output_names)

    def _done(self) -> int | None:
        found = self.emitted.get()
        return None if found is None else found[0]

    def _planned(self, events: Sequence, done: int | None) -> int | None:
        if not events:
            return None
        first = self._time(events[0])
        return min(after(first if done is None else max(done, first), self.emit), self._end(events)[1])

    def _end(self, events: Sequence) -> tuple[int, int]:
        """Length of the leading session, and the time it closes unless more arrives."""
        size = 1
        while size < len(events) and self._time(events[size]) - self._time(events[size - 1]) <= self.gap:
            size += 1
        return size, self._time(events[size - 1]) + self.gap

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        self._add(rows)
        self._set_timer(self._planned(self._load(), self._done()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.timer.clear()
        watermark = timerValues.getCurrentWatermarkInMs()
        events, out = self._load(), []
        kept, done = len(events), self._done()
        while events:
            size, closing = self._end(events)
            rows, times = self._all_named(events[:size]), [self._time(e) for e in events[:size]]
            start, seen = times[0], 0
            at = after(start if done is None else max(done, start), self.emit)
            while at <= min(watermark, closing):
                if bisect_left(times, at) != seen or seen == 0:
                    seen = bisect_left(times, at)
                    values = self.fn(rows[:seen])
                out.append(self._row(key, values, start, at, False))
                done = at
                at += self.emit
            if watermark < closing:
                break
            out.append(self._row(key, self.fn(rows), start, closing, True))
            done = None
            events = events[size:]
        if done is None:
            self.emitted.clear()
        else:
            self.emitted.update((done,))
        if len(events) < kept:
            self._keep(events)
        self._set_timer(self._planned(events, done))
        return iter(out)

    def _row(self, key, values: tuple, start: int, as_of: int, closed: bool) -> Row:
        return self.make(*key, from_ms(start), from_ms(as_of), closed, max(as_of - start, 0), *values)


class OrderPairing(_Buffered):
    """Every purchase event once the watermark has passed it, with its order when it completes one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.cart = handle.getValueState("cart", self.state_schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fresh = self._add(rows)
        due = min(self._time(e) for e in fresh)
        if self.timer.exists():
            due = min(due, self.timer.get()[0] + 1)
        self._set_timer(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.timer.clear()
        watermark = timerValues.getCurrentWatermarkInMs()
        events = self._load()
        ready = [e for e in events if self._time(e) <= watermark]
        rest = events[len(ready) :]
        cart = self.cart.get() if self.cart.exists() else None
        out = []
        for event in ready:
            e = self._named(event)
            cart_ts = value = None
            if e.event_type != schema.CHECKOUT:
                cart = event
            elif e.completed:
                if cart is not None:
                    c = self._named(cart)
                    change = c.cart_price if c.event_type == schema.ADD else -c.cart_price
                    cart_ts, value = from_micros(cart[self.moment]), c.cart_total + change
                cart = None
            out.append(self._out(*key, e.event_id, from_micros(event[self.moment]), cart_ts, value))
        if cart is None:
            self.cart.clear()
        else:
            self.cart.update(tuple(cart))
        self._keep(rest)
        self._set_timer(self._time(rest[0]) if rest else None)
        return iter(out)


def _run(
    events: DataFrame, key: str, processor: type[_Buffered], output: str, time_column: str, *settings
) -> DataFrame:
    timed = events.withColumn(MOMENT, F.unix_micros("ts"))
    return timed.groupBy(key).transformWithState(
        statefulProcessor=processor(timed.schema, output, *settings),
        outputStructType=output,
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName=time_column,
    )


def rolling_stream(
    events: DataFrame, key: str, windows: Sequence[RollingWindow], fn: WindowFunction, feature_ddl: str
) -> DataFrame:
    """Own rolling features: ``fn`` gets a window's rows in time order and returns ``feature_ddl`` values."""
    output = f"{key} string, window_size string, emit_ts timestamp, {feature_ddl}"
    return _run(events, key, RollingProcessor, output, "emit_ts", windows, fn)


def session_stream_running(
    events: DataFrame, key: str, gap_seconds: int, emit_seconds: int, fn: WindowFunction, feature_ddl: str
) -> DataFrame:
    output = f"{key} string, session_start timestamp, as_of timestamp, closed boolean, duration_ms bigint, {feature_ddl}"
    return _run(events, key, SessionProcessor, output, "as_of", gap_seconds, emit_seconds, fn)


def pair_orders_stream(purchases: DataFrame) -> DataFrame:
    output = "user_id string, event_id string, ts timestamp, cart_ts timestamp, order_value double"
    return _run(purchases, "user_id", OrderPairing, output, "ts")


def count_types(*types: str) -> WindowFunction:
    """How many rows of each event type a window holds."""

    def counts(rows: Iterable[Row]) -> tuple:
        found = [r.event_type for r in rows]
        return tuple(found.count(t) for t in types)

    return counts


cart_counts = count_types(schema.ADD, schema.REMOVE)
CART_COUNTS_DDL = "adds bigint, removes bigint"
session_counts = count_types(schema.PAGE_VIEW, schema.PRODUCT_VIEW, schema.ADD)
SESSION_COUNTS_DDL = "page_views bigint, product_views bigint, cart_adds bigint"
