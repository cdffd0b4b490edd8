"""Event time as whole microseconds, and the blocks that cut a key's history into bounded pieces."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
BLOCK = "_block"
BLOCKS_PER_SIZE = 8


def micros(seconds: int) -> int:
    return int(seconds) * MICROS


def position(ts: str | Column) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def floor_to(pos: Column, width: int) -> Column:
    """Exact for dates before 1970 too, where integer division would round towards zero."""
    return pos - F.pmod(pos, F.lit(width))


def ceil_to(pos: Column, width: int) -> Column:
    return pos + F.pmod(-pos, F.lit(width))


def block_of(pos: Column, width: int) -> Column:
    return F.floor(floor_to(pos, width) / F.lit(width)).cast("long")


def common_step(seconds: Iterable[int]) -> int:
    return reduce(gcd, (int(s) for s in seconds))


def default_block(spans: Iterable[int]) -> int:
    """Widest step (microseconds) that divides every span and is at most an eighth of the smallest."""
    spans = list(spans)
    step = common_step(spans)
    pieces = -(-step * BLOCKS_PER_SIZE // min(spans))
    while step % pieces:
        pieces += 1
    return step // pieces
