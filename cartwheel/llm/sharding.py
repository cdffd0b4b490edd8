"""K-d tree sharding: leaves of nearly equal bytes, cut at weighted medians of metadata dimensions.

The points are groups of equal texts, so that copies are never separated; a point weighs the bytes of all its
rows. Dimensions are the text's size (logarithm), the smallest id, language and source of the group. A point
that is larger than an equal share of what is left is a leaf of its own; the tree shares out the others. A node
is cut along its widest dimension, at the weighted quantile of (coordinate, hash) that leaves each side as many
bytes as its number of leaves asks: the hash decides among equal coordinates, as in a source that holds a third
of all rows. Where a large point lies on the quantile, the numbers of leaves follow the bytes on either side.
Quantiles are found digit by digit from counts that combine before the shuffle; per digit the driver sees
``DIGIT`` sums per node, whatever the number of rows. The tree itself (one cut per inner node) becomes one expression.

Defined results: a null text has no bytes, size 1, and is grouped with the empty text. Null ids, languages
and sources have the lowest coordinate. Repeated rows each get a slot. A group larger than a leaf stays whole,
so that its leaf is larger than the others, which are equal among themselves. A leaf is empty only if there are
fewer points than leaves. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import materialise

SHARDS = 16
COORDINATE_BITS, HASH_BITS = 16, 40
# bits found in one pass
DIGIT_BITS = 12
DIGIT = 1 << DIGIT_BITS
# a quantile is near enough if what is left undecided is this share of the node
TOLERANCE = 1 / 4096
# slots are counted in so many blocks per shard
BLOCKS = 1024
DIMENSIONS = ("size", "id", "lang", "source")


@dataclass
class Node:
    """Inner node: the dimension and the first key of the upper side. Leaf: its number, and the leaves it is to be cut into."""

    dimension: str | None = None
    cut: int = 0
    lower: Node | None = None
    upper: Node | None = None
    leaf: int = 0
    leaves: int = 1

    def expression(self) -> Column:
        if self.dimension is None:
            return F.lit(self.leaf)
        return F.when(key(self.dimension) < self.cut, self.lower.expression()).otherwise(self.upper.expression())


def key(dimension: str) -> Column:
    """Coordinate, then hash, as one number."""
    tie = F.col("hash").bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    return F.shiftleft(F.col(f"x_{dimension}").cast("long"), HASH_BITS) + tie


def described(documents: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        "doc_id", "lang", "source", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("hash")
    )


def points(rows: DataFrame) -> DataFrame:
    """One row per group of equal texts: weight and coordinates from 0 to 2^16 - 1."""
    groups = rows.groupBy("hash", "text_crc32", "size").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("id"), F.min("lang").alias("lang"), F.min("source").alias("source")
    )
    span = rows.agg(F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high"), F.max("size").alias("_most")).first()
    low, high, most = span._low or 0, span._high or 0, span._most or 1
    top = (1 << COORDINATE_BITS) - 1

    def name(c: str) -> Column:
        return F.coalesce(F.floor(F.crc32(F.col(c).cast("binary")) / F.lit(float(1 << 32)) * top), F.lit(0))

    place = (F.col("id").cast("double") - float(low)) / float(max(1, high - low))
    return groups.select(
        "hash",
        "text_crc32",
        "size",
        (F.col("n") * F.col("size")).alias("weight"),
        F.floor(F.log2(F.col("size").cast("double")) / F.log2(F.lit(float(max(2, most)))) * top).cast("int").alias("x_size"),
        F.coalesce(F.floor(place * top), F.lit(0)).cast("int").alias("x_id"),
        name("lang").cast("int").alias("x_lang"),
        name("source").cast("int").alias("x_source"),
    )


@dataclass
class Cut:
    """The first key of the upper side, and the leaves of the lower one."""

    key: int
    leaves: int


def split_leaves(leaves: int, below: tuple[int, int], above: tuple[int, int]) -> tuple[tuple[int, float], int]:
    """Best number of leaves for the lower side, and how good it is: empty leaves, bytes of the largest share.

    ``below``, ``above``: bytes and points of either side.
    """

    def cost(k: int) -> tuple[int, float]:
        empty = max(0, k - below[1]) + max(0, leaves - k - above[1])
        return empty, max(below[0] / k, above[0] / (leaves - k))

    best = min(range(1, leaves), key=cost)
    return cost(best), best


def quantiles(rows: DataFrame, widest: dict[int, str], totals: dict[int, tuple[int, int]], leaves: dict[int, int]) -> dict[int, Cut]:
    """Per node where it is cut. ``rows``: node, weight and coordinates; ``totals``: bytes and points."""
    bits = COORDINATE_BITS + HASH_BITS
    along = F.lit(None).cast("long")
    for node, dimension in widest.items():
        along = F.when(F.col("node") == node, key(dimension)).otherwise(along)
    keyed = rows.select("node", "weight", along.alias("key")).where("key IS NOT NULL")
    prefix = dict.fromkeys(widest, 0)
    below = dict.fromkeys(widest, (0, 0))
    cuts: dict[int, Cut] = {}
    left = bits
    while len(cuts) < len(widest):
        step = min(DIGIT_BITS, left)
        left -= step
        inside = F.lit(False)
        for node in set(widest) - set(cuts):
            inside = inside | ((F.col("node") == node) & (F.shiftright("key", left + step) == prefix[node]))
        digit = F.shiftright("key", left).bitwiseAND(F.lit((1 << step) - 1))
        sums: dict[int, dict[int, tuple[int, int]]] = defaultdict(dict)
        for r in keyed.where(inside).groupBy("node", digit.alias("digit")).agg(F.sum("weight").alias("w"), F.count("*").alias("n")).collect():
            sums[r.node][r.digit] = (r.w, r.n)
        for node, own in sums.items():
            total, points_ = totals[node]
            wanted, (reached, n) = total * (leaves[node] // 2) / leaves[node], below[node]
            for d in sorted(own):
                if reached + own[d][0] >= wanted:
                    break
                reached, n = reached + own[d][0], n + own[d][1]
            below[node], prefix[node] = (reached, n), (prefix[node] << step) | d
            w, m = own[d]
            if w <= TOLERANCE * total or not left:
                places = (((reached, n), 0), ((reached + w, n + m), 1))
                found = [(*split_leaves(leaves[node], x, (total - x[0], points_ - x[1])), after) for x, after in places]
                _, lower, after = min(found)
                cuts[node] = Cut((prefix[node] + after) << left, lower)
    return cuts


def tree(rows: DataFrame, leaves: int = SHARDS) -> Node:
    """Cut nodes in two until each is one leaf."""
    root = Node(leaves=leaves)
    ends = [root]
    while any(x.leaves > 1 for x in ends):
        for i, node in enumerate(ends):
            node.leaf = i
        wanted = {i: x.leaves for i, x in enumerate(ends) if x.leaves > 1}
        at = rows.withColumn("node", root.expression()).where(F.col("node").isin(list(wanted)))
        sides = [f(f"x_{d}").alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("low", F.min), ("high", F.max))]
        found = {r.node: r for r in at.groupBy("node").agg(F.sum("weight").alias("total"), F.count("*").alias("points"), *sides).collect()}
        widest = {n: max(DIMENSIONS, key=lambda d: (r[f"high_{d}"] - r[f"low_{d}"], d)) for n, r in found.items()}
        cuts = quantiles(at, widest, {n: (r.total, r.points) for n, r in found.items()}, wanted)
        below = []
        for i, node in enumerate(ends):
            if i not in wanted:
                below.append(node)
                continue
            cut = cuts.get(i, Cut(0, node.leaves // 2))
            node.dimension, node.cut = widest.get(i, DIMENSIONS[0]), cut.key
            node.lower, node.upper = Node(leaves=cut.leaves), Node(leaves=node.leaves - cut.leaves)
            below += [node.lower, node.upper]
        ends = below
    for i, node in enumerate(ends):
        node.leaf = i
    return root


def large_points(groups: DataFrame, leaves: int) -> list[Row]:
    """The largest points, as long as one has an equal share of the bytes and leaves that are left."""
    total = groups.agg(F.sum("weight")).first()[0] or 0
    found = []
    for r in groups.select("hash", "text_crc32", "size", "weight").orderBy(F.desc("weight"), "hash", "text_crc32", "size").limit(leaves).collect():
        if r.weight * (leaves - len(found)) < total:
            break
        found.append(r)
        total -= r.weight
    return found


def leaves_for(total: int, target_bytes: int) -> int:
    """Smallest power of two of leaves that do not exceed the target on average."""
    return 1 << max(0, (-(-total // max(1, target_bytes)) - 1).bit_length())


def with_shards(rows: DataFrame, leaves: int) -> DataFrame:
    groups = materialise(points(rows), "points")
    large = large_points(groups, leaves)
    shard = F.lit(None).cast("int")
    for i, r in enumerate(large, leaves - len(large)):
        own = (F.col("hash") == r.hash) & (F.col("text_crc32") == r.text_crc32) & (F.col("size") == r["size"])
        shard = F.when(own, i).otherwise(shard)
    others = groups.where(shard.isNull())
    if len(large) < leaves:
        shard = F.coalesce(shard, tree(others, leaves - len(large)).expression())
    placed = groups.select("hash", "text_crc32", "size", shard.cast("int").alias("shard"))
    return rows.join(placed, ["hash", "text_crc32", "size"])


def with_slots(rows: DataFrame) -> DataFrame:
    """``slot``: 0, 1, 2 ... within each shard, counted in blocks so that no shard is one task."""
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("doc_id", "hash"), F.lit(BLOCKS)))
    sizes = rows.groupBy("shard", "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("shard", "_block").orderBy("doc_id", "hash"))
    return rows.withColumn("_place", inside).join(starts, ["shard", "_block"]).withColumn("slot", F.col("_start") + F.col("_place") - 1)


def shards(documents: DataFrame, leaves: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Each row's shard and slot; the number of leaves, or the bytes that a leaf should have."""
    rows = described(documents)
    if leaves is None:
        leaves = leaves_for(rows.agg(F.sum("size")).first()[0] or 0, target_bytes or 1 << 30)
    placed = with_slots(materialise(with_shards(rows, leaves), "shards"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
