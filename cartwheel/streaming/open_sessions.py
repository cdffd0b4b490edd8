"""Sessions on streams, while they are open and once more when they close, with all their features.

Rows of a session id go into panes no wider than the gap, so that all rows of a pane are one session. A pane the
watermark has passed is merged into the open session, or closes it if it begins more than the gap later. The state
is one accumulator for the open session and the panes the watermark has not passed yet; rows are not kept. What an
accumulator holds grows only with the number of distinct devices.

A late row joins the open session if it is within the gap of it, before or after. Other late rows are sessions of
their own, closed at once, as the state of closed sessions is gone.

Regions, where events have them: a pane keeps its sightings until it is passed, as their order tells the changes. The
session keeps the regions seen, the newest and the number of changes. A late row behind the newest sighting adds its
region and no change.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cartwheel import schema
from cartwheel.functions.timeline import common_step
from cartwheel.operators import branches
from cartwheel.plans.session_features import COUNTS, derive
from cartwheel.streaming.panes import Pages
from cartwheel.streaming.stateful import MOMENT, after, from_micros, from_ms

COLUMNS = ("event_id", "event_type", "user_id", "searched", "device", "platform", "has_marketing", "campaign", "region")
FEATURES = "page_views bigint, searches bigint, product_views bigint, cart_adds bigint, user_id string, campaign string, device_types array<string>, latest_platform string, shopper_locations array<string>, shopper_region_changes bigint"
OUTPUT = f"session_id string, session_start timestamp, last_ts timestamp, as_of timestamp, closed boolean, {FEATURES}"


def lift(row: Row) -> list:
    """First and last moment, counts, newest user and platform, first campaign, first sighting of each device, sightings
    of regions, and what earlier ones came to."""
    place, kind = [row[MOMENT], row.event_id], row.event_type
    counts = [int(kind == schema.PAGE_VIEW), int(row.searched), int(kind == schema.PRODUCT_VIEW), int(kind == schema.ADD)]
    marketed = [*place, row.campaign] if row.has_marketing else None
    located = [] if row.region is None else [[*place, row.region]]
    return [row[MOMENT], row[MOMENT], counts, [*place, row.user_id, row.platform], marketed, [[*place, row.device]], located, None]


def merge(a: list | None, b: list | None) -> list | None:
    """Both together; the order does not matter."""
    if a is None or b is None:
        return b if a is None else a
    devices: dict[str | None, list] = {}
    for sighting in sorted(a[5] + b[5], key=lambda s: s[:2]):
        devices.setdefault(sighting[2], sighting)
    return [
        min(a[0], b[0]),
        max(a[1], b[1]),
        [x + y for x, y in zip(a[2], b[2])],
        max(a[3], b[3], key=lambda n: n[:2]),
        min((m for m in (a[4], b[4]) if m is not None), key=lambda m: m[:2], default=None),
        list(devices.values()),
        a[6] + b[6],
        b[7] if a[7] is None else a[7],
    ]


def settled(session: list) -> list:
    """Sightings of regions counted in the order of time, after those counted before."""
    if not session[6]:
        return session
    regions, newest, changes = session[7] or [[], None, 0]
    for sighting in sorted(session[6]):
        if newest is None or sighting[:2] > newest[:2]:
            changes += newest is not None and sighting[2] != newest[2]
            newest = sighting
    return [*session[:6], [], [sorted({*regions, *(s[2] for s in session[6])}), newest, changes]]


class OpenSessions(StatefulProcessor):
    def __init__(self, gap_seconds: int, emit_seconds: int, output: Sequence[str]) -> None:
        self.gap, self.emit, self.names = gap_seconds * 1000, emit_seconds * 1000, list(output)
        self.pane = common_step([self.gap, self.emit])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.make = handle, Row(*self.names)
        # the open session, its last emit, up to where panes are merged, panes not yet passed, the timer
        self.head = handle.getValueState("head", "value string")
        self.panes = handle.getMapState("panes", "pane bigint", "content string")

    def _load(self) -> dict:
        found = self.head.get()
        return {"open": None, "done": None, "merged": None, "ahead": [], "pages": [], "timer": None} if found is None else json.loads(found[0])

    def _due(self, head: dict) -> int | None:
        """When there is something to emit next: a running session, or its close."""
        if head["open"] is None:
            return head["ahead"][0] + self.pane if head["ahead"] else None
        last = head["open"][1] // 1000
        start = head["open"][0] // 1000
        at = after(max(start, head["done"] or start), self.emit)
        return min(at, last + self.gap)

    def _save(self, head: dict, panes: Pages) -> None:
        due = self._due(head)
        timer = None if due is None else due - 1
        if head["timer"] is not None and head["timer"] != timer:
            self.handle.deleteTimer(head["timer"])
        if timer is None:
            self.head.clear()
            self.panes.clear()
            return
        panes.save()
        if head["timer"] != timer:
            self.handle.registerTimer(timer)
        head["timer"] = timer
        self.head.update((json.dumps(head),))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        head, touched, strays = self._load(), {}, []
        panes = Pages(self.panes, head["pages"])
        for row in rows:
            time, found = row[MOMENT] // 1000, head["open"]
            if head["merged"] is None or time >= head["merged"]:
                pane = time // self.pane * self.pane
                touched[pane] = merge(touched.get(pane), lift(row))
            elif found is not None and found[0] // 1000 - self.gap <= time <= found[1] // 1000 + self.gap:
                head["open"] = settled(merge(found, lift(row)))
            else:
                strays.append(lift(row))
        for pane, content in sorted(touched.items()):
            panes.put(pane, merge(panes.get(pane), content))
        head["ahead"] = sorted({*head["ahead"], *touched})
        self._save(head, panes)
        return iter(self._closed(key, strays))

    def _closed(self, key, rows: Sequence[list]) -> list[Row]:
        sessions: list[list] = []
        for row in sorted(rows, key=lambda r: r[0]):
            if sessions and row[0] // 1000 - sessions[-1][1] // 1000 <= self.gap:
                sessions[-1] = merge(sessions[-1], row)
            else:
                sessions.append(row)
        return [self._row(key, settled(s), s[1] // 1000 + self.gap, True) for s in sessions]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        head = self._load()
        head["timer"] = None
        panes = Pages(self.panes, head["pages"])
        out: list[Row] = []
        # panes in the order of time: what is emitted at a time knows the panes that end by then
        passed = bisect_right(head["ahead"], watermark - self.pane)
        ready, head["ahead"] = head["ahead"][:passed], head["ahead"][passed:]
        for pane in ready:
            content = panes.get(pane)
            head["merged"] = pane + self.pane
            if head["open"] is not None:
                reached = content[0] // 1000 - head["open"][1] // 1000 <= self.gap
                self._emit(key, head, pane if reached else watermark, not reached, out)
            head["open"] = settled(merge(head["open"], content))
        # what is merged is not kept
        if ready:
            panes.drop_before(head["ahead"][0] if head["ahead"] else None)
        if head["open"] is not None:
            # a pane that is not passed yet may still carry the session on, as may a row to come
            self._emit(key, head, watermark, head["open"][1] // 1000 + self.gap <= watermark and not self._carried_on(head, panes), out)
        self._save(head, panes)
        return iter(out)

    def _carried_on(self, head: dict, panes: Pages) -> bool:
        if not head["ahead"]:
            return False
        following = panes.get(head["ahead"][0])
        return following[0] // 1000 - head["open"][1] // 1000 <= self.gap

    def _emit(self, key, head: dict, until: int, close: bool, out: list[Row]) -> None:
        """Running rows at emit times up to ``until``, and the last row if the session closes."""
        found = head["open"]
        start, closing = found[0] // 1000, found[1] // 1000 + self.gap
        at = after(max(start, head["done"] or start), self.emit)
        while at <= min(until, closing):
            out.append(self._row(key, found, at, False))
            head["done"] = at
            at += self.emit
        if close:
            out.append(self._row(key, found, closing, True))
            head.update(open=None, done=None)

    def _row(self, key, found: list, at: int, closed: bool) -> Row:
        first, last, counts, newest, marketed, devices, _, places = found
        campaign = None if marketed is None else marketed[2]
        locations, changes = (None, None) if places is None else (places[0], places[2])
        return self.make(*key, from_micros(first), from_micros(last), from_ms(at), closed, *counts, newest[2], campaign, [d[2] for d in devices], newest[3], locations, changes)


def session_features(events: DataFrame, gap_seconds: int, emit_seconds: int) -> DataFrame:
    """Sessions at each multiple of ``emit_seconds`` while they are open, and ``closed`` at their end, with durations."""
    names = [f.strip().split()[0] for f in OUTPUT.split(",")]
    rows = branches.session_events(events)
    if "region" not in rows.columns:
        rows = rows.withColumn("region", F.lit(None).cast("string"))
    rows = rows.select("session_id", *COLUMNS, F.unix_micros("ts").alias(MOMENT))
    out = rows.groupBy("session_id").transformWithState(
        statefulProcessor=OpenSessions(gap_seconds, emit_seconds, names), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime", eventTimeColumnName="as_of"
    )
    return derive(out, F.col("as_of")).select("session_id", "session_start", "last_ts", "as_of", "closed", "user_id", *COUNTS, "campaign", "device_types", "latest_platform", "shopper_locations", "shopper_region_changes", "duration_ms", "active_ms", "bounce", "cart_ratio", "cart_ratio_exact")
