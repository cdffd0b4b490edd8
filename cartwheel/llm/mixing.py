"""Mixing sources to target weights: a splitting tree of multivariate hypergeometric draws over blocks of words.

The words of a source lie on a line, its documents in the order of a hash, cut into blocks of equal length.
A source gives a quota of words: whole passes over its line, then blocks of a permutation until the quota is met,
the last block cut to fit. So every source gives its quota exactly, and a document at most one copy a pass.

Which output shard gets which of these draws is settled by a tree over the shards. A node holds how many draws
of each source its shards take together; its left half gets a multivariate hypergeometric draw of them, as if
all draws had been shuffled and dealt out. Leaves hold exact counts, and as consecutive numbers of a source's
permuted draws, so shards are disjoint and nothing is lost. Within a shard the order is shuffled by a hash.

Scale: texts are read once for the number of their words and never shuffled. Positions on a line are running sums
inside hash buckets plus the sums of the buckets before. The tree is worked off by its nodes, several levels a task;
each node's random numbers follow from its shards, so retried tasks draw the same. Blocks become longer with
the corpus, so that there are at most ``2**28`` and one for each source. What one task holds of the sources is a few
numbers each.

Defined results: a null text has no words. Sources are ordered by code point, a null source is one of its own and
the last. Weights repeat in that order. Repeated rows are each documents of their own; among rows alike in id,
source and text it is not defined which gives what. An empty table gives an empty table; a corpus without words
has targets of 0. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import materialise, small, text_of

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 512
# a draw of the tree takes fewer than 10**9 blocks together
MOST_BLOCKS = 1 << 28
SHARD_BLOCKS = 4096
BUCKET_ROWS = 256
TREE_LEVELS = 6
SEED = 11
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: Sequence[int], weights: Sequence[int], most: int = MOST_REPEATS) -> np.ndarray:
    """Words each source is to give: the sum of all sizes shared by weight, none above ``most`` times its size.

    Sources are full in the order of size per weight; the rest is shared by the weights of the others.
    """
    size, weight = np.asarray(sizes, np.int64), np.asarray(weights, np.int64)
    out = np.zeros(len(size))
    rest, sharing = int(size.sum()), int(weight.sum())
    order = np.argsort(size / weight, kind="stable")
    for done, i in enumerate(order):
        if most * int(size[i]) * sharing > rest * int(weight[i]):
            others = order[done:]
            out[others] = rest * weight[others].astype(float) / sharing
            break
        out[i] = most * size[i]
        rest, sharing = rest - most * int(size[i]), sharing - int(weight[i])
    return out


def permutation(blocks: int, number: int, seed: int = SEED) -> tuple[int, int]:
    """Factor and shift: ``(factor * k + shift) % blocks`` takes each block once."""
    rng = np.random.default_rng([seed, number, blocks])
    factor = int(rng.integers(1, max(2, blocks)))
    while math.gcd(factor, blocks) != 1:
        factor = factor % blocks + 1
    return factor, int(rng.integers(0, max(1, blocks)))


def drawn(size: int, quota: int, block: int, factor: int, shift: int) -> tuple[int, int]:
    """How many blocks a quota takes, pass after pass, and how many words of the last one."""
    blocks = -(-size // block)
    if not blocks or not quota:
        return 0, 0
    passes, left = divmod(quota, size)
    short = size - (blocks - 1) * block
    if not left:
        last = (factor * (blocks - 1) + shift) % blocks
        return passes * blocks, short if last == blocks - 1 else block
    # the short block's place in the permutation decides whether one more is needed
    place = (blocks - 1 - shift) * pow(factor, -1, blocks) % blocks if blocks > 1 else 0
    whole = -(-left // block)
    missing = block - short if place < whole else 0
    if whole * block - missing < left:
        whole += 1
    last = place == whole - 1
    before = (whole - 1) * block - (block - short if place < whole - 1 else 0)
    return passes * blocks + whole, min(left - before, short if last else block)


def split(low: int, high: int, counts: np.ndarray, capacity, seed: int = SEED) -> np.ndarray:
    """Draws of each source that the left half of a node's shards takes."""
    middle = (low + high) // 2
    rng = np.random.default_rng([seed, low, high])
    return rng.multivariate_hypergeometric(counts, capacity(middle) - capacity(low), method="marginals")


def _shares(sources: DataFrame, weights: Sequence[int], most: int, block: int) -> DataFrame:
    """Per source its target, quota and permutation, and how many draws that takes."""

    def share(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        size = table["size"].to_numpy()
        target = targets(size, [weights[i % len(weights)] for i in range(len(size))], most)
        quota = np.minimum(np.floor(target + 0.5).astype(np.int64), most * size)
        rows = []
        for number, (n, q) in enumerate(zip(size.tolist(), quota.tolist())):
            blocks = -(-n // block)
            factor, shift = permutation(blocks, number) if blocks else (1, 0)
            rows.append((number, n, float(target[number]), q, blocks, factor, shift, *drawn(n, q, block, factor, shift)))
        names = ["number", "source_size", "target", "quota", "blocks", "factor", "shift", "draws", "last"]
        types = [pa.int32(), pa.int64(), pa.float64(), *[pa.int64()] * 6]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    ddl = "number int, source_size bigint, target double, quota bigint, blocks bigint, factor bigint, shift bigint, draws bigint, last bigint"
    return sources.select(F.lit(0).alias("_all"), "number", "size").groupBy("_all").applyInArrow(share, ddl)


def _tree(shares: DataFrame, shards: int, draws: int) -> DataFrame:
    """Leaves of the tree: per shard and source how many of its draws, and which is the first."""

    def capacity(shard: int) -> int:
        return shard * draws // shards

    def grow(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        nodes = [(low, high, table["number"].to_numpy(), table["first"].to_numpy(), table["count"].to_numpy())]
        for _ in range(TREE_LEVELS):
            below = []
            for low, high, number, first, count in nodes:
                if high - low == 1:
                    below.append((low, high, number, first, count))
                    continue
                left, middle = split(low, high, count, capacity), (low + high) // 2
                for lo, hi, begin, n in ((low, middle, first, left), (middle, high, first + left, count - left)):
                    kept = n > 0
                    below.append((lo, hi, number[kept], begin[kept], n[kept]))
            nodes = below
        columns = [pa.array(np.concatenate([np.full(len(n[2]), n[i]) for n in nodes]), pa.int64()) for i in (0, 1)]
        columns += [pa.array(np.concatenate([n[i] for n in nodes]), t) for i, t in ((2, pa.int32()), (3, pa.int64()), (4, pa.int64()))]
        return pa.table(columns, ["low", "high", "number", "first", "count"])

    ddl = "low bigint, high bigint, number int, first bigint, count bigint"
    root = shares.where("draws > 0").select(
        F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), "number", F.lit(0).cast("long").alias("first"), F.col("draws").alias("count")
    )
    nodes, widest = root, shards
    while widest > 1:
        nodes = nodes.groupBy("low", "high").applyInArrow(grow, ddl)
        widest = -(-widest // (1 << TREE_LEVELS))
    return nodes.select(F.col("low").alias("shard"), "number", "first", "count")


def _hash(*columns: str | Column) -> Column:
    return F.xxhash64(F.lit(SEED), *columns)


class Mixture:
    """``sized`` documents, the ``sources`` with their targets, and the ``pieces`` that the mix is made of."""

    def __init__(
        self,
        documents: DataFrame,
        weights: Sequence[int] = WEIGHTS,
        most: int = MOST_REPEATS,
        block: int = BLOCK_WORDS,
        shard_blocks: int = SHARD_BLOCKS,
    ) -> None:
        text = text_of("text")
        rows = documents.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64(text).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
        # rows alike in all of these are one entry with copies
        sized = materialise(rows.groupBy("doc_id", "source", "digest", "size").agg(F.count("*").alias("copies")), "sizes")
        named = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("size"))
        order = Window.orderBy(F.col("source").asc_nulls_last())
        named = materialise(named.withColumn("number", F.row_number().over(order) - 1), "sources")
        total, entries = named.agg(F.sum("size")).first()[0] or 0, sized.count()
        self.block = max(block, -(-total // MOST_BLOCKS))
        shares = materialise(_shares(named, weights, most, self.block), "shares")
        draws = shares.agg(F.sum("draws")).first()[0] or 0
        self.shards = max(1, -(-draws // shard_blocks))
        self.sources = small(materialise(named.drop("size").join(small(shares), "number"), "sources"))
        known = self.sources.select(F.col("source").alias("_source"), "number")
        self.sized = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        self.pieces = self._pieces(shares, max(1, entries // BUCKET_ROWS), draws)

    def _pieces(self, shares: DataFrame, buckets: int, draws: int) -> DataFrame:
        block = F.lit(self.block).cast("long")
        placed = self.sized.where("size > 0").withColumn("_h", _hash("doc_id", "digest")).withColumn("_bucket", F.pmod("_h", F.lit(buckets)))
        words = F.col("size") * F.col("copies")
        sums = placed.groupBy("number", "_bucket").agg(F.sum(words).alias("_sum"))
        before = F.sum("_sum").over(Window.partitionBy("number").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
        begins = sums.select("number", "_bucket", F.coalesce(before, F.lit(0)).alias("_begin"))
        inside = Window.partitionBy("number", "_bucket").orderBy("_h", "doc_id", "digest", "size").rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumn("_at", F.coalesce(F.sum(words).over(inside), F.lit(0))).join(begins, ["number", "_bucket"])
        # each copy has a stretch of its own
        placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        placed = placed.withColumn("_at", F.col("_begin") + F.col("_at") + F.col("copy") * F.col("size"))
        end = F.col("_at") + F.col("size")
        spans = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("_at") / block), F.floor((end - 1) / block))))

        leaves = _tree(shares, self.shards, draws)
        each = leaves.select("shard", "number", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("draw"))
        each = each.join(self.sources.select("number", "source_size", "blocks", "factor", "shift", "draws", "last"), "number")
        turn = F.expr("draw div blocks")
        chosen = each.select(
            "shard",
            "number",
            turn.alias("turn"),
            F.expr("(factor * (draw % blocks) + shift) % blocks").alias("block"),
            F.when(F.col("draw") == F.col("draws") - 1, F.col("last")).otherwise(block).alias("_words"),
        )
        joined = spans.join(chosen, ["number", "block"], "left")
        low = F.greatest("_at", F.col("block") * block)
        high = F.least(end, F.col("block") * block + F.col("_words"))
        return joined.select(
            "doc_id",
            "source",
            "digest",
            "size",
            "number",
            "copy",
            "shard",
            "block",
            "turn",
            (low - F.col("_at")).alias("first_word"),
            F.when(F.col("shard").isNull(), 0).otherwise(F.greatest(high - low, F.lit(0))).alias("n_words"),
        )

    def shuffled(self) -> DataFrame:
        """The mix: pieces of documents by shard and ``slot``, gapless from 0, in shuffled order of their blocks."""
        order = Window.partitionBy("shard").orderBy(_hash("number", "block", "turn"), "number", "block", "turn", "digest", "doc_id", "copy", "first_word")
        return self.pieces.where("n_words > 0").withColumn("slot", F.row_number().over(order).cast("long") - 1)

    def texts(self, documents: DataFrame) -> DataFrame:
        """The mix with its texts: words joined by one space. Cut documents are cut between words."""
        text = text_of("text")
        keyed = documents.select(F.col("doc_id").alias("_id"), F.col("source").cast("string").alias("_source"), F.xxhash64(text).alias("_digest"), text.alias("_text"))
        keyed = keyed.dropDuplicates(["_id", "_source", "_digest"])
        same = F.col("digest").eqNullSafe(F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
        words = F.slice(F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)), (F.col("first_word") + 1).cast("int"), F.col("n_words").cast("int"))
        return self.shuffled().join(keyed, same).select("shard", "slot", "source", "doc_id", "first_word", "n_words", F.array_join(words, " ").alias("text"))

    def taken(self) -> DataFrame:
        """Per document how many of its words the mix takes, and in which shards they are."""
        per = self.pieces.groupBy("doc_id", "source", "digest", "size", "number", "copy").agg(
            F.sum("n_words").alias("taken"), F.array_sort(F.collect_set(F.when(F.col("n_words") > 0, F.col("shard")))).alias("shards")
        )
        none = self.sized.where("size = 0").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        none = none.select("doc_id", "size", "number", F.lit(0).cast("long").alias("taken"), F.array().cast("array<bigint>").alias("shards"))
        rows = per.select("doc_id", "size", "number", "taken", "shards").unionByName(none)
        return rows.join(self.sources.select("number", "source_size", "target"), "number").select("doc_id", "size", "source_size", "target", "taken", "shards")
