"""Periodic runs of words, found by uniting suffix classes in descending order of their common prefixes.

The suffixes of a text are sorted; neighbours in that order share a longest common prefix (LCP). Classes of
suffixes are united by decreasing LCP, with union-find over ordered sets of positions. When two positions become
neighbours in a set at an LCP of at least their distance, the text repeats with that distance as its period: a seed.

Each run is seeded exactly once, by its start ``s`` and its period ``q``: both share ``length - q`` words, so they
are united at that LCP, and a class member between them would give the stretch a period below ``q``. A seed
therefore is a run if the word before it does not carry on the period; its end follows from the LCP, and no
longer period of the same stretch can be seeded, as its multiples lie between. Classes of an LCP below half the
least length can seed no run, so texts that repeat no such stretch are not sorted at all.

A text is one row and is worked off whole, with memory and time in proportion to its words (times a logarithm).
There is no shuffle.

Defined results: a null, empty or blank text has no runs and collapses to the empty text. Repeated rows give
repeated results. Other columns are neither read nor changed. An empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import text_of

LEAST_LENGTH = 12
WORD = r"[^\x20\x09-\x0D]+"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
FOUND = "struct<runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"
# odd, so that a product with it loses no bits
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeats(ids: np.ndarray, width: int) -> bool:
    """Whether some ``width`` consecutive words may occur twice (by hash: false only if none does)."""
    n = len(ids) - width + 1
    if n < 2:
        return False
    words = ids.astype(np.uint64)
    mixed = words[:n].copy()
    for k in range(1, width):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + words[k : n + k]
    mixed.sort()
    return bool((mixed[1:] == mixed[:-1]).any())


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Starts of all suffixes, sorted; by ranks of prefixes of doubling length."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < n:
        key = rank * (n + 1)
        key[: n - width] += rank[width:] + 1
        distinct, rank = np.unique(key, return_inverse=True)
        if len(distinct) == n:
            break
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def common_prefixes(words: Sequence[int], order: Sequence[int]) -> list[int]:
    """LCP of each suffix with the next one in order: what one position shares, less one, the next one shares too."""
    n = len(words)
    after = [-1] * n
    for a, b in zip(order, order[1:]):
        after[a] = b
    shared, lcp = 0, [0] * n
    for i in range(n):
        j = after[i]
        if j < 0:
            shared = 0
            continue
        most = n - (i if i > j else j)
        while shared < most and words[i + shared] == words[j + shared]:
            shared += 1
        lcp[i] = shared
        if shared:
            shared -= 1
    return [lcp[a] for a in order[:-1]]


class Classes:
    """Union-find over positions; every class keeps its positions in order."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))
        self.members: dict[int, list[int]] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def unite(self, x: int, y: int) -> Iterator[tuple[int, int]]:
        """Make two classes one; pairs of positions that are neighbours only now."""
        x, y = self.find(x), self.find(y)
        large, few = self.members.pop(x, None) or [x], self.members.pop(y, None) or [y]
        if len(large) < len(few):
            x, y, large, few = y, x, few, large
        self.parent[y] = x
        places, at = [], 0
        for position in few:
            at = bisect_left(large, position, at)
            places.append(at)
        pairs, before = [], -1
        for i, (position, at) in enumerate(zip(few, places)):
            if at and at != before:
                pairs.append((large[at - 1], position))
            if at < len(large) and (i + 1 == len(few) or places[i + 1] != at):
                pairs.append((position, large[at]))
            before = at
        if 64 * len(few) < len(large):
            for position, at in zip(reversed(few), reversed(places)):
                large.insert(at, position)
        else:  # two ordered stretches: sorting merges them
            large += few
            large.sort()
        self.members[x] = large
        return pairs


def runs(ids: np.ndarray, least: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """All runs of a sequence as start, length and smallest period, in order."""
    half = max(1, (least + 1) // 2)
    if not repeats(ids, half):
        return []
    order = suffix_order(ids).tolist()
    words = ids.tolist()
    lcp = np.array(common_prefixes(words, order), np.int64)
    edges = np.flatnonzero(lcp >= half)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    classes, found = Classes(len(words)), []
    for edge, shared in zip(edges.tolist(), lcp[edges].tolist()):
        for first, second in classes.unite(order[edge], order[edge + 1]):
            period = second - first
            if period <= shared and period + shared >= least and (not first or words[first - 1] != words[second - 1]):
                found.append((first, period + shared, period))
    return sorted(found)


def numbered(words: Sequence[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def described(text: str, least: int = LEAST_LENGTH) -> tuple[list[tuple[int, int, int]], str]:
    """Runs of a text's words, and the text with each run cut to its first period, words joined by one space."""
    words = text.encode().split()  # of bytes: at 0x20 and 0x09 to 0x0D only
    found = runs(numbered(words), least) if len(words) >= least else []
    if found:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in found:
            change[start + period] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return found, b" ".join(words).decode()


def periodic_runs(text: str | Column, least: int = LEAST_LENGTH) -> Column:
    """``runs`` (word number of the start, length and period in words; by start, then period) and ``collapsed``."""

    @F.arrow_udf(FOUND)
    def found(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            rows = [described(t, least) for t in texts.to_pylist()]
            flat = [r for of_text, _ in rows for r in of_text]
            columns = [pa.array([r[i] for r in flat], pa.int64()) for i in range(3)]
            offsets = np.cumsum([0, *(len(of_text) for of_text, _ in rows)])
            listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_RUN)))
            yield pa.StructArray.from_arrays([listed, pa.array([c for _, c in rows], pa.string())], fields=list(_FOUND))

    return found(text_of(text))


def with_periods(text: str | Column, number: str | Column) -> Column:
    """The text, for a tenth of the numbers with its end made periodic.

    ``h`` is the CRC-32 of the decimal number. Where ``h`` is a multiple of 10, the words from a place on repeat the
    first ones there. A null number changes nothing.
    """
    text = text_of(text)
    h = F.crc32((F.col(number) if isinstance(number, str) else number).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    rest = n - a
    p = (F.lit(1) + F.floor(rest / (F.lit(3) + g % 8))).cast("int")
    unit = F.slice(words, a + 1, p)
    repeated = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / p).cast("int"))), F.lit(1), rest)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), repeated), " ")
    return F.when(h % 10 == 0, F.when(n > 0, changed).otherwise(text)).otherwise(text)


def digests(documents: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one, and digests of all runs and of the collapsed text."""
    found = documents.select("doc_id", periodic_runs(with_periods("text", "doc_id")).alias("_found"))
    found = found.select("doc_id", "_found.runs", "_found.collapsed")
    # the longest, of these the first, of these the shortest period
    ranked = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    out = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        ranked.alias("_best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    period = -F.col("_best.p")
    return out.select(
        "doc_id",
        "n_runs",
        (-F.col("_best.s")).alias("start"),
        F.col("_best.length").alias("length"),
        period.alias("period"),
        F.expr("1000 * _best.length div -_best.p").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
