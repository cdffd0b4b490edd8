"""Enrichments that join events with reference tables.

No side is forced to be broadcast, but for address ranges that were counted to be few: the planner does so
below its size threshold, and splits skewed partitions of the larger joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.enrich import ip_number
from cartwheel.functions.timeline import BLOCK, block_of, micros, position
from cartwheel.operators.matching import matches


def at_most_one(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the smallest in column order, so that a lookup never multiplies events."""
    rest = [c for c in table.columns if c not in keys]
    return table.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*")


def lookup(events: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    return events.join(at_most_one(table, keys), list(keys), "left")


def referer(events: DataFrame, url: str, table: DataFrame, internal: Sequence[str] = ()) -> DataFrame:
    """``table``: host, medium, source. Hosts of the shop itself give medium ``internal``."""
    host = F.lower(F.try_parse_url(F.col(url), F.lit("HOST")))
    known = table.select(
        F.lower("host").alias("refr_host"),
        F.col("medium").alias("refr_medium"),
        F.col("source").alias("refr_source"),
    )
    found = lookup(events.withColumn("refr_host", host), known, ["refr_host"])
    own = F.col("refr_host").isin(*internal) if internal else F.lit(False)
    return found.withColumn("refr_medium", F.when(own, "internal").otherwise(F.col("refr_medium"))).withColumn(
        "refr_source", F.when(~F.coalesce(own, F.lit(False)), F.col("refr_source"))
    )


def ip_ranges(table: DataFrame, cidr: str = "cidr") -> DataFrame:
    """``a.b.c.d/n`` to first and last address and length; null for what is no range (n is 0 to 32, 32 if left out)."""
    parts = F.split(F.col(cidr), "/")
    said = F.when(F.size(parts) > 1, F.try_element_at(parts, F.lit(2)).try_cast("int")).otherwise(F.lit(32))
    length = F.when(said.between(0, 32) & (F.size(parts) <= 2), said)
    size = F.pow(F.lit(2.0), 32 - length).cast("long")
    address = ip_number(parts[0])
    start = address - F.pmod(address, size)
    known = start.isNotNull()
    return table.select("*", start.alias("ip_from"), (start + size - 1).alias("ip_to"), F.when(known, length).alias("ip_length"))


FEW_RANGES = 10_000


def ip_lookup(events: DataFrame, ip: str, table: DataFrame, fields: Sequence[str], few: int = FEW_RANGES) -> DataFrame:
    """Fields of the narrowest range holding the event's address; what is no address or no range matches nothing.

    A range is its length and its leading bits, so an address has one candidate per length that occurs (33 at
    most), and the search is an equality join. Up to ``few`` ranges go to the events, one length after the
    other, and events are not shuffled; with more, addresses are looked up once each.
    """
    ranges = ip_ranges(table).where(F.col("ip_from").isNotNull())
    counts = {r["ip_length"]: r["count"] for r in ranges.groupBy("ip_length").count().collect()}
    lengths = sorted(counts)
    bits = F.call_function("shiftright", F.col("ip_from"), 32 - F.col("ip_length"))
    ranges = ranges.select(*fields, "ip_length", bits.alias("_bits"))
    ranges = ranges.groupBy("ip_length", "_bits").agg(F.max(F.struct(*fields)).alias("_best"))
    if not lengths:
        return events.select("*", *[F.lit(None).cast(table.schema[f].dataType).alias(f) for f in fields])
    if sum(counts.values()) <= few:
        # never null, so no join adds a filter that would read the address again
        found = events.withColumn("_n", F.coalesce(ip_number(F.col(ip)), F.lit(-1).cast("long")))
        for n in lengths:
            held = ranges.where(F.col("ip_length") == n).select(F.col("_bits").alias(f"_bits_{n}"), F.col("_best").alias(f"_best_{n}"))
            found = found.join(F.broadcast(held), F.shiftright("_n", 32 - n) == F.col(f"_bits_{n}"), "left")
        best = F.coalesce(*[F.col(f"_best_{n}") for n in reversed(lengths)])
        kept = [ip, *[c for c in events.columns if c != ip]]
        return found.select(*kept, best.alias("_m")).select(*kept, *[F.col(f"_m.{f}").alias(f) for f in fields])
    addresses = events.select(ip).distinct().withColumn("_n", ip_number(F.col(ip))).where(F.col("_n").isNotNull())
    candidates = F.array(*[F.struct(F.lit(n).alias("l"), F.shiftright("_n", 32 - n).alias("b")) for n in lengths])
    asked = addresses.select(ip, F.explode(candidates).alias("_c")).select(ip, F.col("_c.l").alias("ip_length"), F.col("_c.b").alias("_bits"))
    best = asked.join(ranges, ["ip_length", "_bits"]).groupBy(ip).agg(F.max(F.struct("ip_length", "_best")).alias("_m"))
    return events.join(best.select(ip, *[F.col(f"_m._best.{f}").alias(f) for f in fields]), ip, "left")


def with_region(events: DataFrame, ip: Column, table: DataFrame, field: str, name: str = "region") -> DataFrame:
    """``name``: ``field`` of the narrowest range (``table``: cidr and ``field``) that holds the event's address.

    Ranges are cut at the leading 16 bits of the addresses, so an event asks one equality key and picks among
    the ranges of its block. That is one join without a shuffle of results, and so runs on streams as well.
    """
    ranges = ip_ranges(table).where(F.col("ip_from").isNotNull())
    blocks = F.sequence(F.shiftright("ip_from", 16), F.shiftright("ip_to", 16))
    held = ranges.select(F.explode(blocks).alias("_block"), F.struct("ip_length", "ip_from", "ip_to", field).alias("_range"))
    held = held.groupBy("_block").agg(F.collect_set("_range").alias("_ranges"))
    asked = events.withColumn("_n", ip_number(ip)).withColumn("_block", F.shiftright("_n", 16))
    inside = F.filter("_ranges", lambda r: (r["ip_from"] <= F.col("_n")) & (F.col("_n") <= r["ip_to"]))
    return asked.join(held, "_block", "left").select(*[events[c] for c in events.columns], F.array_max(inside)[field].alias(name))


def mark_robots(
    events: DataFrame,
    ip: str,
    agent: str,
    ip_table: DataFrame,
    include: DataFrame | None = None,
    exclude: DataFrame | None = None,
) -> DataFrame:
    """``is_robot``: address in a listed range, or an agent that is not a browser or is a listed robot.

    ``include`` and ``exclude`` are tables with a column ``pattern``: pieces of the names of browsers and of robots.
    Without ``include`` every agent is a browser, with it a missing agent is none.
    """
    listed = ip_lookup(events, ip, ip_table.withColumn("_listed", F.lit(True)), ["_listed"])

    def found(patterns: DataFrame, mark: str) -> DataFrame:
        return matches(events, agent, patterns.select("pattern"), "pattern").select(F.col("_text").alias(f"_of{mark}"), F.lit(True).alias(mark)).distinct()

    robot = F.coalesce("_listed", F.lit(False))
    for patterns, mark, sought in ((include, "_browser", False), (exclude, "_excluded", True)):
        if patterns is not None:
            listed = listed.join(found(patterns, mark), F.col(agent) == F.col(f"_of{mark}"), "left")
            robot = robot | (F.coalesce(mark, F.lit(False)) == sought)
    return listed.select(*events.columns, robot.alias("is_robot"))


def without_robots(events: DataFrame, **lists) -> DataFrame:
    return mark_robots(events, **lists).where(~F.col("is_robot")).drop("is_robot")


def prior_day_rate(events: DataFrame, ts: str, currency: str, rates: DataFrame) -> DataFrame:
    """``rate`` of the newest ``rate_date`` before the event's date (rates: currency, rate_date, rate).

    Only the days and currencies that occur are put in order with the rates; events then join by equality.
    """
    day = F.to_date(ts)
    rates = rates.select(F.col("currency").alias("_c"), F.col("rate_date").alias("_d"), "rate")
    days = events.select(F.col(currency).alias("_c"), day.alias("_d")).distinct()
    line = days.select("*", F.lit(None).cast(rates.schema["rate"].dataType).alias("rate")).unionByName(rates)
    before = Window.partitionBy("_c").orderBy("_d").rangeBetween(Window.unboundedPreceding, -1)
    day_number = F.datediff("_d", F.lit("1970-01-01").cast("date"))
    line = line.withColumn("_d", day_number).withColumn("_is_day", F.col("rate").isNull())
    known = line.withColumn("_r", F.last("rate", ignorenulls=True).over(before)).where("_is_day")
    known = known.select("_c", "_d", F.col("_r").alias("rate"))
    keyed = events.withColumn("_c", F.col(currency)).withColumn(
        "_d", F.datediff(day, F.lit("1970-01-01").cast("date"))
    )
    return keyed.join(known, ["_c", "_d"], "left").drop("_c", "_d")


def convert_currency(
    events: DataFrame, amount: str, currency: str, ts: str, rates: DataFrame, base: str = "EUR"
) -> DataFrame:
    """``amount_base``: ``rate`` is the price of one unit of the currency in the base currency."""
    with_rate = prior_day_rate(events, ts, currency, rates)
    rate = F.when(F.col(currency) == base, F.lit(1.0)).otherwise(F.col("rate"))
    return with_rate.withColumn("amount_base", F.col(amount) * rate).drop("rate")


def shopper_regions(events: DataFrame, key: str | Sequence[str], ts: str, region: str, block_seconds: int) -> DataFrame:
    """Per key: the regions seen, and how often the region changed from one event to the next.

    Changes are counted inside blocks of ``block_seconds``, and between the last region of a block and the first
    of the next, so a hot key spreads over as many tasks as it has blocks. Both read one exchange.
    """
    keys = [key] if isinstance(key, str) else list(key)
    pos = position(ts)
    block = block_of(pos, micros(block_seconds)).alias(BLOCK)
    rows = events.where(F.col(region).isNotNull()).select(*keys, block, pos.alias("pos"), "event_id", F.col(region).alias("_region"))
    here = Window.partitionBy(*keys, BLOCK).orderBy("pos", "event_id")
    inside = rows.repartition(*keys, BLOCK).select(
        *keys,
        BLOCK,
        "_region",
        F.first("_region").over(here).alias("_first"),
        F.lag("_region").over(here).alias("_before"),
        F.lead("_region").over(here).isNull().alias("_tail"),
    )
    changed = lambda a, b: F.coalesce(a != b, F.lit(False)).cast("long").alias("_changes")
    across = Window.partitionBy(*keys).orderBy(BLOCK)
    ends = inside.where("_tail").select(*keys, "_region", changed(F.lag("_region").over(across), F.col("_first")))
    counted = inside.select(*keys, "_region", changed(F.col("_before"), F.col("_region"))).unionByName(ends)
    counted = counted.groupBy(*keys, "_region").agg(F.sum("_changes").alias("_changes"))
    return counted.groupBy(*keys).agg(
        F.array_sort(F.collect_list("_region")).alias("shopper_locations"),
        F.sum("_changes").alias("shopper_region_changes"),
    )
