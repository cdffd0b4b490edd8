"""N-gram Jaccard join: documents as sets of word shingles, indexed as count vectors in R-trees.

1. Every text becomes the set of its distinct shingles (64-bit hashes). Equal sets are one class; all that
   follows works on classes, so copies are never paired.
2. Tokens of a set are hashed into groups. The numbers per group are the coordinates of the set's point; the
   overlap of two sets is at most the sum of the coordinates' minima.
3. Points are dealt out by shared content. Two sets of sizes x and y within the threshold differ in at most
   (x + y) * (1 - t) / (1 + t) elements; with more parts than that, at least one part of their elements is
   the same. Sets with a whole part in common are in the same tile, and no linked pair is outside a tile.
   Parts depend on the size class; a set near the upper end of its class is in the next one too.
4. Each set of a tile is first held against the tile's middle one: one pair per set joins nearly all groups
   of copies. Only tiles whose sets are still in several components go on, gathered into clusters.
5. A cluster's points are packed into R-trees (by size, then by the widest coordinate; boxes of largest
   coordinates). Boxes whose bound misses the threshold are skipped, as are boxes of one component: pairs
   inside a component cannot change the result. Surviving pairs are verified on the whole sets at once, and
   each link joins components for the pairs to come.
6. Clusters beyond ``BLOCK`` sets are cut into blocks, and pairs of blocks are tasks of their own. Large
   components have blocks to themselves, which are never held against each other.

Defined results: null, empty and blank texts have the empty set and link with nothing. Texts of fewer words
than a shingle are one shingle of all their words. Rows with a null id take part without an id: their
component is the smallest id reachable, null if there is none. Repeated rows are copies of one set.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import LOWER, components, materialise, parallelism, small, text_of

WORDS, THRESHOLD = 3, Fraction(9, 10)
# coordinates of a point
GROUPS = 256
# size classes: each is so many times as wide as the one before
STEP = 1.4
# parts beyond those needed, so that empty parts can be left out
SPARE = 3
# points in a leaf of a tree, boxes in a box
LEAF = 24
# sets of a cluster that one task holds at most twice
BLOCK = 500
# words a worker remembers the hash of
REMEMBERED = 500_000
# entries that one task takes at a time
DECK_ENTRIES = 1_000_000

ENTRY = np.dtype([("sig", "<u8"), ("hash", "<i8")])
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value


_HASHES = _Hashes()


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    tokens = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not tokens:
        return np.empty(0, _U)
    if len(_HASHES) > REMEMBERED:
        _HASHES.clear()
    hashed = np.fromiter(map(_HASHES.__getitem__, tokens), _U, len(tokens))
    width = min(words, len(tokens))
    out = np.full(len(tokens) - width + 1, width, _U)
    for k in range(width):
        out = mixed(out ^ hashed[k : len(hashed) - width + 1 + k]) + _U(k)
    return np.unique(out)


def set_hash(shingles: np.ndarray) -> int:
    """Equal for equal sets; 0 for the empty set."""
    return int(mixed(shingles).sum(dtype=_U).astype(np.int64)) if len(shingles) else 0


def count_vector(shingles: np.ndarray) -> np.ndarray:
    """How many elements of a set fall into each group: its point."""
    return np.bincount((shingles & _U(GROUPS - 1)).astype(np.intp), minlength=GROUPS).astype("<u4")


def most_different(total: int, threshold: Fraction) -> int:
    """Elements in which two linked sets of ``total`` elements together can differ."""
    return int(total * (1 - threshold) / (1 + threshold))


def least_overlap(total: np.ndarray | int, threshold: Fraction) -> np.ndarray | int:
    """Smallest overlap of a linked pair: overlap / (total - overlap) >= threshold, rounded up."""
    return -(-(total * threshold.numerator) // (threshold.numerator + threshold.denominator))


def linked(left: np.ndarray, right: np.ndarray, threshold: Fraction) -> bool:
    both = len(np.intersect1d(left, right, assume_unique=True))
    return both >= least_overlap(len(left) + len(right), threshold)


def class_bounds(threshold: Fraction) -> np.ndarray:
    """Upper ends (included) of the size classes; no class is narrower than the threshold asks."""
    ends, step = [8], max(STEP, float(1 / threshold))
    while ends[-1] < 1 << 31:
        ends.append(int(ends[-1] * step) + 1)
    return np.array(ends)


def parts_of(shingles: np.ndarray, parts: int, needed: int) -> np.ndarray:
    """Signatures of the parts; empty ones only where so many are empty that the rest would not do."""
    part = ((shingles >> _U(32)) * _U(parts)) >> _U(32)
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    sums = np.add.reduceat(mixed(shingles[order]), starts)
    sigs = mixed(sums ^ mixed(part[starts] + _U(parts << 32)))
    if parts - len(starts) > parts - needed:
        empty = np.setdiff1d(np.arange(parts, dtype=_U), part[starts])
        sigs = np.r_[sigs, mixed(empty + _U(parts << 32))]
    return sigs


def entries(shingles: np.ndarray, ends: np.ndarray, threshold: Fraction) -> np.ndarray:
    """The set's hash once for each tile that it belongs to."""
    own, last = np.searchsorted(ends, [len(shingles), int(len(shingles) / threshold)]).tolist()
    sigs = []
    for k in range(own, last + 1):
        differing = most_different(2 * int(ends[k]), threshold)
        sigs.append(parts_of(shingles, differing + 1 + (SPARE if differing else 0), differing + 1) + _U(k))
    out = np.empty(sum(map(len, sigs)), ENTRY)
    out["sig"], out["hash"] = np.concatenate(sigs), set_hash(shingles)
    return out


def sets(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id``, hash of the text, and of the shingle set of each row the size, hash and count vector."""

    @F.arrow_udf("struct<n:int,hash:long,counts:binary>")
    def described(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            found = [shingle_set(t, words) for t in texts.to_pylist()]
            sizes = pa.array([len(x) for x in found], pa.int32())
            hashes, counts = pa.array([set_hash(x) for x in found], pa.int64()), pa.array([count_vector(x).tobytes() for x in found], pa.binary())
            yield pa.StructArray.from_arrays([sizes, hashes, counts], ["n", "hash", "counts"])

    rows = documents.select("doc_id", text_hash().alias("text_hash"), described(text_of("text")).alias("_set"))
    return rows.select("doc_id", "text_hash", "_set.*")


def text_hash() -> Column:
    return F.xxhash64(text_of("text"))


def _packed_entries(documents: DataFrame, words: int, threshold: Fraction, decks: int) -> DataFrame:
    """Entries of all sets, packed by deck (a hash range of tiles); equal sets of a batch give theirs once."""
    ends = class_bounds(threshold)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[int, np.ndarray] = {}
            for text in batch.column(0).to_pylist():
                shingles = shingle_set(text, words)
                if len(shingles) and (key := set_hash(shingles)) not in known:
                    known[key] = entries(shingles, ends, threshold)
            if not known:
                continue
            rows = np.concatenate(list(known.values()))
            deck = ((rows["sig"] >> _U(32)) * _U(decks)) >> _U(32)
            order = np.argsort(deck, kind="stable")
            deck, rows = deck[order], rows[order]
            cuts = np.flatnonzero(np.r_[True, deck[1:] != deck[:-1]])
            blobs = [x.tobytes() for x in np.split(rows, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(deck[cuts].astype(np.int64)), pa.array(blobs, pa.binary())], ["deck", "entries"])

    return documents.select(text_of("text").alias("text")).mapInArrow(packed, "deck long, entries binary")


def tiles(documents: DataFrame, words: int, threshold: Fraction, decks: int) -> DataFrame:
    """Sets of the tiles that have two or more: tile, the set's hash, the hash of the tile's middle set."""

    def joined(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.frombuffer(b"".join(x for batch in groups for x in batch.column("entries").to_pylist()), ENTRY)
        rows = rows[np.lexsort((rows["hash"], rows["sig"]))]
        rows = rows[np.r_[True, (rows["sig"][1:] != rows["sig"][:-1]) | (rows["hash"][1:] != rows["hash"][:-1])]]
        cuts = np.flatnonzero(np.r_[True, rows["sig"][1:] != rows["sig"][:-1], True])
        sizes = np.diff(cuts)
        kept = np.repeat(sizes > 1, sizes)
        middle = np.repeat(cuts[:-1] + sizes // 2, sizes)[kept]
        columns = [rows["sig"][kept].view(np.int64), rows["hash"][kept], rows["hash"][middle]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["tile", "hash", "middle"])

    packed = _packed_entries(documents, words, threshold, decks)
    return packed.groupBy("deck").applyInArrow(joined, "tile long, hash long, middle long")


def whole_sets(documents: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``wanted`` (with ``hash`` and an id of such a row, ``_row``) and the set itself as ``elements``."""

    @F.arrow_udf("binary")
    def found(texts: pa.Array, hashes: pa.Array) -> pa.Array:
        every = [shingle_set(t, words) for t in texts.to_pylist()]
        # an id can have several texts
        own = zip(every, hashes.to_pylist(), strict=True)
        return pa.array([x.tobytes() if set_hash(x) == h else None for x, h in own], pa.binary())

    ids = wanted.select(F.col("_row").alias("_id"), *[c for c in wanted.columns if c != "_row"])
    held = documents.join(small(ids), F.col("doc_id").eqNullSafe(F.col("_id")))
    # the wanted hash is an argument, else the sets of all documents would be computed below the join;
    # repeated rows give a set several times, which does no harm
    held = held.select(*[c for c in wanted.columns if c != "_row"], found(text_of("text"), F.col("hash")).alias("elements"))
    return held.where("elements IS NOT NULL")


def possible_pairs(pairs: DataFrame, described: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs whose points allow a link: the sum of the smaller coordinates bounds the overlap."""

    @F.arrow_udf("boolean")
    def possible(left: pa.Array, right: pa.Array) -> pa.Array:
        a, b = (np.frombuffer(b"".join(x.to_pylist()), "<u4").reshape(-1, GROUPS) for x in (left, right))
        total = a.sum(1, dtype=np.int64) + b.sum(1, dtype=np.int64)
        return pa.array(np.minimum(a, b).sum(1, dtype=np.int64) >= least_overlap(total, threshold))

    points = described.where("n > 0").select("hash", "counts").dropDuplicates(["hash"])
    for side in ("a", "b"):
        pairs = pairs.join(points.withColumnsRenamed({"hash": side, "counts": f"_{side}"}), side)
    return pairs.where(possible("_a", "_b")).select("a", "b")


def linked_pairs(pairs: DataFrame, documents: DataFrame, classes: DataFrame, words: int, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) of sets that are linked; a set that is in many pairs is a hot key of an ordinary join."""

    @F.arrow_udf("boolean")
    def verified(left: pa.Array, right: pa.Array) -> pa.Array:
        both = zip(left.to_pylist(), right.to_pylist(), strict=True)
        return pa.array([linked(np.frombuffer(a, _U), np.frombuffer(b, _U), threshold) for a, b in both], pa.bool_())

    rows = classes.select("hash", "_row")
    second = materialise(pairs.withColumnRenamed("b", "hash").join(rows, "hash"), "pairs")
    first = materialise(pairs.select(F.col("a").alias("hash")).distinct().join(rows, "hash"), "pairs")
    second = whole_sets(documents, second, words).withColumnsRenamed({"hash": "b", "elements": "_y"})
    first = whole_sets(documents, first, words).withColumnsRenamed({"hash": "a", "elements": "_x"})
    return second.join(first, "a").where(verified("_x", "_y")).select("a", "b")


class Box:
    """Points, or boxes, under their largest coordinates."""

    def __init__(self, members: np.ndarray, boxes: list[Box], high: np.ndarray, low_n: int, high_n: int) -> None:
        self.members, self.boxes, self.high, self.low_n, self.high_n = members, boxes, high, low_n, high_n


def packed_tree(at: np.ndarray, n: np.ndarray) -> Box:
    """Bottom-up: points by size, within slices by the coordinate that differs most."""
    leaves = []
    for part in np.array_split(np.argsort(n, kind="stable"), -(-len(n) // (LEAF * LEAF))):
        widest = np.argmax(at[part].max(0) - at[part].min(0))
        part = part[np.argsort(at[part, widest], kind="stable")]
        for x in np.array_split(part, -(-len(part) // LEAF)):
            leaves.append(Box(x, [], at[x].max(0), int(n[x].min()), int(n[x].max())))
    while len(leaves) > 1:
        rows = [leaves[i : i + LEAF] for i in range(0, len(leaves), LEAF)]
        leaves = [
            Box(np.concatenate([x.members for x in r]), r, np.max([x.high for x in r], 0), min(x.low_n for x in r), max(x.high_n for x in r))
            for r in rows
        ]
    return leaves[0]


class Roots:
    """Components while links are found: members of ``first`` and ``second`` by place."""

    def __init__(self, roots: np.ndarray) -> None:
        self.of = np.unique(roots, return_inverse=True)[1]

    def link(self, i: int, j: int) -> None:
        self.of[self.of == self.of[j]] = self.of[i]


def tree_links(sets_of: list[np.ndarray], roots: np.ndarray, sides: np.ndarray | None, threshold: Fraction) -> Iterator[tuple[int, int]]:
    """Links that join components, by places. With ``sides`` only pairs of different sides count."""
    n = np.array([len(x) for x in sets_of])
    at = np.zeros((len(n), GROUPS), np.uint32)
    for row, own in zip(at, sets_of, strict=True):
        row[:] = count_vector(own)
    known = Roots(roots)
    if sides is None:
        root = packed_tree(at, n)
        todo = [(root, root)]
    else:
        places = [np.flatnonzero(sides == x) for x in np.unique(sides)]
        trees = [packed_tree(at[x], n[x]) for x in places]
        for x, t in zip(places, trees, strict=True):
            _renumber(t, x)
        todo = [(trees[0], trees[1])] if len(trees) == 2 else []
    while todo:
        a, b = todo.pop()
        roots_a, roots_b = known.of[a.members], known.of[b.members]
        if (roots_a == roots_a[0]).all() and (roots_b == roots_a[0]).all():
            continue
        if np.minimum(a.high, b.high).sum(dtype=np.int64) < least_overlap(a.low_n + b.low_n, threshold):
            continue
        if min(a.high_n, b.high_n) < threshold * max(a.low_n, b.low_n):
            continue
        if a.boxes or b.boxes:
            if a is b:
                todo += [(x, y) for k, x in enumerate(a.boxes) for y in a.boxes[k:]]
            elif len(a.boxes) >= len(b.boxes):
                todo += [(x, b) for x in a.boxes]
            else:
                todo += [(a, y) for y in b.boxes]
            continue
        bound = np.minimum(at[a.members][:, None], at[b.members][None]).sum(2, dtype=np.int64)
        may = bound >= least_overlap(n[a.members][:, None] + n[b.members][None], threshold)
        may &= roots_a[:, None] != roots_b[None]
        for x, y in zip(*np.nonzero(np.triu(may, 1) if a is b else may), strict=True):
            i, j = int(a.members[x]), int(b.members[y])
            if known.of[i] != known.of[j] and linked(sets_of[i], sets_of[j], threshold):
                known.link(i, j)
                yield i, j


def _renumber(box: Box, places: np.ndarray) -> None:
    box.members = places[box.members]
    for x in box.boxes:
        _renumber(x, places)


def cluster_links(open_sets: DataFrame, documents: DataFrame, words: int, threshold: Fraction) -> DataFrame:
    """Links between the components of each cluster. ``open_sets``: hash, _row, cluster, root."""
    sized = open_sets.groupBy("cluster", "root").agg(F.count("*").alias("_size"))
    alone = F.col("_size") >= BLOCK
    owner = F.when(alone, F.col("root"))
    held = open_sets.join(sized, ["cluster", "root"]).withColumn("_owner", owner)
    blocks = sized.groupBy("cluster", owner.alias("_owner")).agg(F.sum("_size").alias("_total"))
    blocks = blocks.withColumn("_blocks", F.ceil(F.col("_total") / BLOCK))
    named = blocks.select(F.col("cluster").alias("_c"), F.col("_owner").alias("_o"), "_blocks")
    held = held.join(named, (F.col("cluster") == F.col("_c")) & F.col("_owner").eqNullSafe(F.col("_o"))).select(
        "cluster", "_owner", "hash", "_row", "root", F.pmod(F.xxhash64("hash"), F.col("_blocks")).alias("_block")
    )
    every = materialise(blocks.select("cluster", "_owner", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_block")), "blocks")
    block = F.struct(F.coalesce("_owner", F.lit(0)).alias("owner"), F.col("_owner").isNull().alias("mixed"), "_block")
    named = every.select("cluster", block.alias("_x"))
    # blocks of one large component are not held against each other
    tasks = (
        named.join(named.select(F.col("cluster"), F.col("_x").alias("_y")), "cluster")
        .where("_x <= _y AND (_x.mixed OR _x.owner != _y.owner OR _y.mixed)")
        .select("cluster", "_x", "_y", F.xxhash64("cluster", "_x", "_y").alias("_task"))
    )
    sides = tasks.select("cluster", "_task", F.col("_x").alias("_b"), F.lit(0).alias("_side"))
    sides = sides.unionByName(tasks.where("_x != _y").select("cluster", "_task", F.col("_y").alias("_b"), F.lit(1).alias("_side")))
    dealt = held.withColumn("_b", block).join(sides, ["cluster", "_b"]).select("hash", "_row", "root", "_task", "_side")
    rows = whole_sets(documents, materialise(dealt, "open"), words)

    def searched(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(groups))
        task, side = table["_task"].to_numpy(), table["_side"].to_numpy()
        order = np.lexsort((side, task))
        hashes, root = table["hash"].to_numpy(), table["root"].to_numpy()
        elements = table["elements"].to_pylist()
        cuts = np.flatnonzero(np.r_[True, np.diff(task[order]) != 0, True])
        for start, end in zip(cuts, cuts[1:]):
            own = order[start:end]
            two = side[own] if side[own].any() else None
            pairs = tree_links([np.frombuffer(elements[i], _U) for i in own], root[own], two, threshold)
            found = np.array([(hashes[own[i]], hashes[own[j]]) for i, j in pairs], np.int64).reshape(-1, 2)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found.min(1)), pa.array(found.max(1))], ["a", "b"])

    return rows.withColumn("_deal", F.pmod("_task", F.lit(32 * parallelism(rows)))).groupBy("_deal").applyInArrow(searched, "a long, b long")


def _grouped(documents: DataFrame, words: int, threshold: Fraction) -> tuple[DataFrame, DataFrame]:
    """The described rows, and the component (``root``) of each set that is not empty, by its hash."""
    documents = documents.select("doc_id", "text")
    described = materialise(sets(documents, words), "classes")
    classes = described.where("n > 0").groupBy("hash").agg(F.min("doc_id").alias("_row"))
    volume = described.agg(F.sum("n")).first()[0] or 0
    decks = max(4 * parallelism(documents), int(volume * 2 * STEP * (1 - threshold) / (1 + threshold)) // DECK_ENTRIES)

    tiled = materialise(tiles(documents, words, threshold, decks), "tiles")
    star = tiled.where("hash != middle").select(F.col("middle").alias("a"), F.col("hash").alias("b")).distinct()
    star = materialise(possible_pairs(star, described, threshold), "pairs")
    links = materialise(linked_pairs(star, documents, classes, words, threshold), "links")
    roots = components(links)

    def with_root(hashes: DataFrame, roots: DataFrame, name: str = "root") -> DataFrame:
        """The smallest of a component is no node of an edge: its root is itself."""
        known = roots.select(F.col("node").alias("hash"), F.col("root").alias(name))
        return hashes.join(known, "hash", "left").withColumn(name, F.coalesce(name, "hash"))

    rooted = with_root(tiled, roots)
    still_open = rooted.groupBy("tile").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low != _high")
    of_open = materialise(rooted.join(still_open.select("tile"), "tile", "left_semi").select("hash", "middle", "root").distinct(), "open")
    clusters = components(of_open.select(F.col("middle").alias("a"), F.col("hash").alias("b")))
    open_sets = with_root(of_open.select("hash", "root").distinct(), clusters, "cluster")
    more = cluster_links(materialise(open_sets.join(classes, "hash"), "open"), documents, words, threshold)
    roots = components(links.unionByName(more))

    return described, with_root(classes, roots)


def similar_groups(documents: DataFrame, words: int = WORDS, threshold: Fraction = THRESHOLD) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row."""
    described, grouped = _grouped(documents, words, threshold)
    smallest = grouped.groupBy("root").agg(F.min("_row").alias("component_id"))
    of_class = grouped.join(smallest, "root").select("hash", "component_id")
    size = F.col("n").cast("long").alias("n_shingles")
    alone = described.where("n = 0").select("doc_id", size, F.col("doc_id").alias("component_id"))
    return described.where("n > 0").join(of_class, "hash").select("doc_id", size, "component_id").unionByName(alone)


def one_of_each(documents: DataFrame, words: int = WORDS, threshold: Fraction = THRESHOLD) -> DataFrame:
    """One row of each group; rows without words all stay.

    The row with the smallest id stays, one without an id only if no row of its group has one. Rows of a group that
    share the id are told apart by their sets and texts; of rows alike in all of these one stays.
    """
    described, grouped = _grouped(documents, words, threshold)
    rows = described.where("n > 0").join(grouped.select("hash", "root"), "hash")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "text_hash")
    best = rows.groupBy("root").agg(F.min(rank).alias("_best"))
    away = rows.join(best, "root").where(~rank.eqNullSafe(F.col("_best")))
    away = away.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()

    def found_in(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return rows.join(keys, rows["doc_id"].eqNullSafe(keys["_id"]) & (text_hash() == keys["_hash"]), how)

    kept = found_in(documents, away, "left_anti")
    repeated = described.where("n > 0").groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.count("*").alias("_n"))
    repeated = materialise(repeated.where("_n > 1").drop("_n"), "repeated")
    if repeated.isEmpty():
        return kept
    once = found_in(kept, repeated, "left_semi").withColumn("_of_text", text_hash()).dropDuplicates(["doc_id", "_of_text"])
    return found_in(kept, repeated, "left_anti").unionByName(once.drop("_of_text"))
