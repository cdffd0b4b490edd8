"""Rolling features on streams: all sizes of a branch over one state, a few steps per emit.

Events of a key go into panes, whose width divides every size and emit interval. A window's value is made of two
parts, as in a queue of two stacks: ``front`` holds, for each pane up to a split, everything from that pane to
the split; ``back`` is one value, everything after it. A new pane is merged to the back, a pane that leaves is the
head of the front. When the front is used up it is built anew from the panes, once per window length, so an emit
costs a constant number of merges on average, whatever the window's size. Merging keeps the order of time and
needs no inverse, so highest, lowest, newest and paired values work like sums.

Late rows count: a row that comes after its emit times have passed is in all later windows that still hold it, as
its pane takes it and the fronts are built anew. A row that no window can hold any more is passed over here;
``late_rows`` keeps it. Rows are compared with the watermark as plain numbers, so Spark drops none.
"""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence
from decimal import ROUND_HALF_UP, Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cartwheel import schema
from cartwheel.config import RollingWindow
from cartwheel.functions.timeline import common_step
from cartwheel.operators import branches
from cartwheel.operators.branches import updated_total
from cartwheel.operators.rolling import MONEY
from cartwheel.plans.event_features import average_order
from cartwheel.plans.grid_features import summarise_categories, summarise_products
from cartwheel.streaming.stateful import MOMENT, after, from_ms

PLACES = 12
"""Decimal places of amounts, as in ``MONEY``."""

Element = Any
"""What a stretch of time comes to: a list of plain values, or None for nothing."""


class Algebra:
    """How rows become elements and elements merge, earlier ones first. Contents of a pane are its element here."""

    columns: Sequence[str] = ()
    output = ""

    def add(self, content: Element, row: Row) -> Element:
        return self.merge(content, self.lift(row))

    def element(self, content: Element) -> Element:
        return content

    def lift(self, row: Row) -> Element:
        raise NotImplementedError

    def join(self, a: list, b: list) -> list:
        raise NotImplementedError

    def merge(self, a: Element, b: Element) -> Element:
        return b if a is None else a if b is None else self.join(a, b)

    def features(self, element: Element) -> tuple:
        raise NotImplementedError


class Carts(Algebra):
    """Adds, removes, and the cart's value after its newest event."""

    columns = ("event_type", "event_id", "value")
    output = "adds bigint, removes bigint, cart_value double"

    def lift(self, row: Row) -> Element:
        return [int(row.event_type == schema.ADD), int(row.event_type == schema.REMOVE), [row[MOMENT], row.event_id, row.value]]

    def join(self, a: list, b: list) -> list:
        return [a[0] + b[0], a[1] + b[1], max(a[2], b[2], key=lambda x: x[:2])]

    def features(self, element: Element) -> tuple:
        return (0, 0, None) if element is None else (element[0], element[1], element[2][2])


class Products(Algebra):
    """Of one product: views, the earliest price, the lowest and the highest."""

    columns = ("event_id", "product_price")
    output = "n bigint, first_price double, low double, high double"

    def lift(self, row: Row) -> Element:
        price = row.product_price
        return [1, [row[MOMENT], row.event_id, price], price, price]

    def join(self, a: list, b: list) -> list:
        return [a[0] + b[0], min(a[1], b[1], key=lambda x: x[:2]), min(a[2], b[2]), max(a[3], b[3])]

    def features(self, element: Element) -> tuple:
        return (None,) * 4 if element is None else (element[0], element[1][2], element[2], element[3])


class Categories(Algebra):
    """Views of one category."""

    output = "n bigint"

    def lift(self, row: Row) -> Element:
        return [1]

    def join(self, a: list, b: list) -> list:
        return [a[0] + b[0]]

    def features(self, element: Element) -> tuple:
        return (None,) if element is None else (element[0],)


class Orders(Algebra):
    """Orders of a stretch of time: a completed checkout takes the newest cart event before it, if there is one.

    The element is: whether a checkout comes before all cart events, the orders, their total in units, the value of
    the cart event that waits for a checkout, whether there was any checkout. Merging two stretches gives one order
    more when a cart event waits in the first and a checkout leads the second. A pane keeps its events, as these may
    come in any order.
    """

    columns = ("event_type", "event_id", "cart_total", "cart_price", "completed")
    output = "orders_count bigint, total string"

    def add(self, content: Element, row: Row) -> Element:
        content = content or []
        insort(content, [row[MOMENT], row.event_id, *self._step(row)], key=lambda e: e[:2])
        return content

    @staticmethod
    def _step(row: Row) -> tuple[bool, int | None]:
        """Whether the event is a completed checkout, and the order value if it is a cart event."""
        if row.event_type == schema.CHECKOUT:
            return row.completed, None
        change = row.cart_price if row.event_type == schema.ADD else -row.cart_price
        return False, units(row.cart_total + change)

    def element(self, content: Element) -> Element:
        whole = None
        for _, _, checkout, value in content:
            whole = self.merge(whole, [checkout, 0, 0, value, checkout])
        return whole

    def join(self, a: list, b: list) -> list:
        lead, count, total, waiting, checkout = a
        leads, n, more, waits, any_checkout = b
        lead = lead or (leads and waiting is None and not checkout)
        if leads and waiting is not None:
            count, total, waiting = count + 1, total + waiting, None
        if waits is not None or any_checkout:
            waiting = waits
        return [lead, count + n, total + more, waiting, checkout or any_checkout]

    def features(self, element: Element) -> tuple:
        count, total = (0, 0) if element is None else (element[1], element[2])
        return count, f"{Decimal(total).scaleb(-PLACES):f}"


def units(value: float) -> int:
    """An amount in units of its last decimal place: sums of whole numbers do not depend on their order."""
    return int(Decimal(repr(value)).scaleb(PLACES).quantize(Decimal(1), ROUND_HALF_UP))


def takes(time: int, watermark: int, size: int, emit: int) -> bool:
    """Whether an event that comes at this watermark is in a window still to come."""
    return time >= watermark or time >= after(watermark, emit) - size


PAGE = 4096
"""Characters a page of the state takes before a new one is begun."""


class Pages:
    """Contents by pane, several to an entry of the state: a call to the state costs more than a few panes do.

    ``index`` (kept by the caller) names the first pane of each page, in order; a page holds what comes up to the next
    one. Only the pages that are asked for are read, and what is written is bounded by a page, or by one pane if that
    is larger.
    """

    def __init__(self, state, index: list[int], prefix: tuple = ()) -> None:
        self.state, self.index, self.prefix = state, index, prefix
        self.read: dict[int, dict[int, Element]] = {}
        self.changed: set[int] = set()
        self.stored = set(index)

    def _page(self, first: int) -> dict[int, Element]:
        if first not in self.read:
            self.read[first] = {int(k): v for k, v in json.loads(self.state.getValue((*self.prefix, first))[0]).items()}
        return self.read[first]

    def _first(self, pane: int) -> int | None:
        at = bisect_right(self.index, pane)
        return self.index[at - 1] if at else None

    def get(self, pane: int) -> Element:
        first = self._first(pane)
        return None if first is None else self._page(first).get(pane)

    def put(self, pane: int, content: Element) -> None:
        first = self._first(pane)
        if first is None:
            first = pane
            insort(self.index, first)
            self.read[first] = {}
        self._page(first)[pane] = content
        self.changed.add(first)

    def items(self) -> Iterator[tuple[int, Element]]:
        for first in self.index:
            yield from sorted(self._page(first).items())

    def drop_before(self, pane: int | None) -> None:
        """Let whole pages go that end before a pane; all of them without one."""
        while self.index and (pane is None or self._last(self.index[0]) < pane):
            first = self.index.pop(0)
            if first in self.stored:
                self.state.removeKey((*self.prefix, first))
            self.read.pop(first, None)
            self.changed.discard(first)

    def _last(self, first: int) -> int:
        """The last pane the first page can hold; of the only page the last that it does hold."""
        return self.index[1] - 1 if len(self.index) > 1 else max(self._page(first))

    def save(self) -> None:
        """Write what has changed; a page that has grown too long is cut."""
        for first in sorted(self.changed):
            texts = {p: json.dumps(v) for p, v in sorted(self.read[first].items())}
            page, length = first, 0
            whole: dict[int, list[str]] = {page: []}
            for pane, text in texts.items():
                if length and length + len(text) > PAGE:
                    page, length = pane, 0
                    whole[page] = []
                    insort(self.index, page)
                whole[page].append(f'"{pane}": {text}')
                length += len(text)
            for start, parts in whole.items():
                self.state.updateValue((*self.prefix, start), ("{" + ", ".join(parts) + "}",))
        self.changed.clear()
        self.read.clear()


class PaneRing(StatefulProcessor):
    """Windows ``[T - size, T)`` at multiples of each window's emit interval; one more, empty, when it has emptied."""

    def __init__(self, algebra: Algebra, windows: Sequence[RollingWindow], output: Sequence[str]) -> None:
        self.algebra, self.names = algebra, list(output)
        self.windows = [(w.label, w.duration_seconds * 1000, w.emit_seconds * 1000) for w in windows]
        self.pane = 1000 * common_step([s for w in windows for s in (w.duration_seconds, w.emit_seconds)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # per window: next and last emit, split, first pane of the front, back, whether a late row came in; the panes
        # that some window has not taken yet; the timer
        self.head = handle.getValueState("head", "value string")
        self.panes = handle.getMapState("panes", "pane bigint", "content string")
        self.fronts = handle.getMapState("fronts", "size int, pane bigint", "content string")

    def _load(self) -> dict:
        found = self.head.get()
        if found is not None:
            return json.loads(found[0])
        none = {"next": None, "done": None, "split": None, "first": None, "back": None, "late": False}
        return {"w": [{**none, "pages": []} for _ in self.windows], "ahead": [], "pages": [], "timer": None}

    def _save(self, head: dict, panes: Pages, fronts: Sequence[Pages] = ()) -> None:
        due = [w["next"] for w in head["w"] if w["next"] is not None]
        # timers fire when the watermark is past them, hence the millisecond less
        timer = min(due) - 1 if due else None
        if head["timer"] is not None and head["timer"] != timer:
            self.handle.deleteTimer(head["timer"])
        if timer is None:
            self.head.clear()
            self.panes.clear()
            self.fronts.clear()
            return
        for pages in (panes, *fronts):
            pages.save()
        if head["timer"] != timer:
            self.handle.registerTimer(timer)
        head["timer"] = timer
        self.head.update((json.dumps(head),))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        head, touched = self._load(), {}
        panes = Pages(self.panes, head["pages"])
        for row in rows:
            time = row[MOMENT] // 1000
            pane = time // self.pane * self.pane
            if not any(takes(time, watermark, size, emit) for _, size, emit in self.windows):
                continue
            for w, (_, size, emit) in zip(head["w"], self.windows):
                at = after(time, emit)
                if w["done"] is not None and at <= w["done"]:
                    at = w["done"] + emit
                    if time < at - size:
                        continue
                    w["late"] = True
                if w["next"] is not None or takes(time, watermark, size, emit):
                    w["next"] = at if w["next"] is None else min(w["next"], at)
            if pane not in touched:
                touched[pane] = panes.get(pane)
            touched[pane] = self.algebra.add(touched[pane], row)
        for pane, content in sorted(touched.items()):
            panes.put(pane, content)
        head["ahead"] = sorted({*head["ahead"], *touched})
        if touched:
            self._save(head, panes)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        head = self._load()
        head["timer"] = None
        panes = Pages(self.panes, head["pages"])
        self.elements: dict[int, Element] = {}
        self.everything = False
        make, out, fronts = Row(*self.names), [], []
        for number, (w, (label, size, emit)) in enumerate(zip(head["w"], self.windows)):
            front = Pages(self.fronts, w["pages"], (number,))
            fronts.append(front)
            while w["next"] is not None and w["next"] <= watermark:
                at = w["next"]
                element = self._window(w, front, panes, head["ahead"], at, size)
                out.append(make(*key, label, from_ms(at), *self.algebra.features(element)))
                w["done"] = at
                if element is not None:
                    w["next"] = at + emit
                else:  # empty: once, then not before the next event
                    later = bisect_left(head["ahead"], at)
                    w["next"] = after(head["ahead"][later], emit) if later < len(head["ahead"]) else None
            front.drop_before(w["first"])
        waiting = [w["done"] for w in head["w"] if w["next"] is not None]
        taken = min((d for d in waiting if d is not None), default=None) if None not in waiting else None
        if taken is not None:
            head["ahead"] = [p for p in head["ahead"] if p >= taken]
        if self.everything and waiting:  # panes that have left every window
            panes.drop_before(min(w["next"] - size for w, (_, size, _) in zip(head["w"], self.windows) if w["next"] is not None))
        self._save(head, panes, fronts)
        return iter(out)

    def _element(self, panes: Pages, pane: int) -> Element:
        if pane not in self.elements:
            self.elements[pane] = self.algebra.element(panes.get(pane))
        return self.elements[pane]

    def _window(self, w: dict, front: Pages, panes: Pages, ahead: Sequence[int], at: int, size: int) -> Element:
        begin, merge = at - size, self.algebra.merge
        while w["first"] is not None and w["first"] < begin:
            w["first"] = front.get(w["first"])[1]
        if w["late"] or w["split"] is None or (w["first"] is None and begin > w["split"]):
            front.drop_before(None)
            value, follows, built = None, None, []
            self.everything = True
            for pane in sorted((p for p, _ in panes.items() if begin <= p < at), reverse=True):
                value = merge(self._element(panes, pane), value)
                built.append((pane, [value, follows]))
                follows = pane
            for pane, entry in reversed(built):
                front.put(pane, entry)
            w.update(first=follows, split=at, back=None, late=False)
            return value
        for pane in ahead[bisect_left(ahead, w["done"]) : bisect_left(ahead, at)]:
            w["back"] = merge(w["back"], self._element(panes, pane))
        return merge(None if w["first"] is None else front.get(w["first"])[0], w["back"])


def _rolled(events: DataFrame, keys: Sequence[str], algebra: Algebra, windows: Sequence[RollingWindow]) -> DataFrame:
    """Rows per key, window and emit time. The event time goes in as a number: see the module's note on late rows."""
    fields = ", ".join(f"{k} string" for k in keys)
    output = f"{fields}, window_size string, emit_ts timestamp, {algebra.output}"
    names = [f.split()[0] for f in output.split(", ")]
    rows = events.select(*keys, *algebra.columns, F.unix_micros("ts").alias(MOMENT))
    return rows.groupBy(*keys).transformWithState(
        statefulProcessor=PaneRing(algebra, windows, names),
        outputStructType=output,
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName="emit_ts",
    )


def _feature(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select("user_id", "emit_ts", "window_size", *columns)


def cart_features(events: DataFrame, windows: Sequence[RollingWindow]) -> DataFrame:
    value = updated_total("event_type", "previous_price", "product_price").alias("value")
    rolled = _rolled(branches.cart_events(events).select("*", value), ["user_id"], Carts(), windows)
    return _feature(rolled, "adds", "removes", (F.col("adds") + F.col("removes")).alias("update_frequency"), "cart_value")


def product_features(events: DataFrame, windows: Sequence[RollingWindow]) -> DataFrame:
    """Keyed by user and product, so that a user's products are many keys; then added up per user and emit time."""
    items = _rolled(branches.product_views(events), ["user_id", "product_id"], Products(), windows)
    items = items.withColumn("first_price", F.col("first_price").cast(MONEY))
    return summarise_products(items, "emit_ts")


def category_features(events: DataFrame, windows: Sequence[RollingWindow]) -> DataFrame:
    views = branches.keep(branches.category_views(events), F.col("category").isNotNull())
    return summarise_categories(_rolled(views, ["user_id", "category"], Categories(), windows), "emit_ts")


def purchase_features(events: DataFrame, windows: Sequence[RollingWindow]) -> DataFrame:
    rolled = _rolled(branches.purchase_events(events), ["user_id"], Orders(), windows)
    total = F.col("total").cast(MONEY)
    return _feature(rolled, "orders_count", total.cast("double").alias("order_value"), average_order(total, F.col("orders_count")).alias("avg_order_value"))


class _Late(StatefulProcessor):
    """Rows behind the watermark, as they arrive; keeps no state."""

    def __init__(self, names: Sequence[str], windows: Sequence[RollingWindow]) -> None:
        self.names = list(names)
        self.windows = [(w.duration_seconds * 1000, w.emit_seconds * 1000) for w in windows]

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        for row in rows:
            time = row[MOMENT] // 1000
            if time < watermark:
                missed = not any(takes(time, watermark, size, emit) for size, emit in self.windows)
                yield Row(*self.names)(row.event_id, row.event_type, row.user_id, row.session_id, from_ms(time), from_ms(watermark), missed)

    def close(self) -> None:
        pass


def late_rows(events: DataFrame, windows: Sequence[RollingWindow]) -> DataFrame:
    """Events behind the watermark, and whether they are ``missed`` by all windows still to come.

    Dealt out by a hash of the event, as nothing is kept per user.
    """
    output = "event_id string, event_type string, user_id string, session_id string, ts timestamp, watermark timestamp, missed boolean"
    rows = events.select("event_id", "event_type", "user_id", "session_id", F.unix_micros("ts").alias(MOMENT), F.pmod(F.xxhash64("event_id"), F.lit(256)).alias("deal"))
    return rows.groupBy("deal").transformWithState(
        statefulProcessor=_Late([f.split()[0] for f in output.split(", ")], windows), outputStructType=output, outputMode="Append", timeMode="EventTime"
    )
