"""Repeated events: sent twice, they have the same id and the same fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARRIVED, FINGERPRINT = "_arrived", "_fingerprint"
WITHIN = "1 hour"


def event_fingerprint(columns: Sequence[str]) -> Column:
    """SHA-1 over all fields but the id: events that share an id by accident differ in it."""
    return F.sha1(F.to_json(F.struct(*columns)))


def without_repeats(events: DataFrame, event_id: str = "event_id", within: str = WITHIN) -> DataFrame:
    """One row of each (id, fingerprint); another event under the same id stays.

    On a stream a repeat is found if it arrives ``within`` that time of the first. The time is that of arrival, not
    of the event, so that late events are not taken for old ones, and the state ends with it.
    """
    keyed = events.withColumn(FINGERPRINT, event_fingerprint([c for c in events.columns if c != event_id]))
    keys = [event_id, FINGERPRINT]
    if events.isStreaming:
        arrived = keyed.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, within)
        return arrived.dropDuplicatesWithinWatermark(keys).drop(ARRIVED, FINGERPRINT)
    return keyed.dropDuplicates(keys).drop(FINGERPRINT)
