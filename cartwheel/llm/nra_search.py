"""Ranked lexical search: sequential reads of impact-sorted postings, with an interval of scores per document.

The impact of a posting is what its term adds to a score. Postings are written in tiers of falling impact, cut at
quantiles of all impacts; a tier is sorted by impact. Round ``k`` reads tier ``k`` and nothing else: no document
is ever looked up. For each item and document that was met, the sum of the impacts read is the lower end of
its score's interval; the upper end adds, for each term not met in it yet, the highest impact that term's list
still holds. The tenth highest lower end is the item's threshold. A document whose upper end is below it is
dropped. When the terms' highest unread impacts together are below it, no new document can enter, and further reads
only serve the documents that are held. An item is done when the intervals of all its documents have closed:
then membership, ties and scores are settled. Equal upper ends stay, so ties are settled by the ids.

Scale: texts are read once. What a text holds is filtered by a bit per hash of the items' terms (2**20 bits,
whatever the items hold), then joined to the terms themselves. Rare terms have high impacts, so common terms'
long lists are read last, against the few documents still held. No list, item or document is held by one task; the
best ten of an item are found by partial top-tens. Tables that grow with the items are broadcast only when
counted to be small.

Defined results: a null or empty text has no terms. A term in every document can have a weight of 0 and adds
nothing. Repeated rows, of documents and of items alike, count as rows of their own; equal scores are in the order of
``doc_id``, null ids last. An item without a document above 0 gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import BROADCAST_ROWS, LOWER, materialise, small, text_of
from cartwheel.sources.workspace import new_folder

BEST = 10
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FILTER_BITS = 1 << 20
BROADCAST_BYTES = 64 << 20
# shares of all postings that lie above the lower edges of the tiers; the last tier is the rest
TIERS = (0.002, 0.01, 0.03, 0.08, 0.2, 0.45)
_COUNTED = pa.struct([("n", pa.int64()), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
COUNTED = "struct<n: bigint, terms: array<string>, counts: array<bigint>>"


def terms(text: str | Column, wanted: bytes | None = None) -> Column:
    """``n`` terms of a text; its distinct ``terms`` with their ``counts``, only those whose bit is set in ``wanted``."""

    @F.arrow_udf(COUNTED)
    def counted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            totals, names, counts, ends = [], [], [], [0]
            for text in texts.to_pylist():
                found = TERM.findall(text.encode().translate(LOWER))
                totals.append(len(found))
                for term, count in Counter(found).items():
                    if wanted is not None:
                        bit = zlib.crc32(term) % FILTER_BITS
                        if not wanted[bit >> 3] >> (bit & 7) & 1:
                            continue
                    names.append(term)
                    counts.append(count)
                ends.append(len(names))
            offsets = pa.array(ends, pa.int32())
            listed = pa.ListArray.from_arrays(offsets, pa.array(names, pa.binary()).cast(pa.string()))
            columns = [pa.array(totals, pa.int64()), listed, pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))]
            yield pa.StructArray.from_arrays(columns, fields=list(_COUNTED))

    return counted(text_of(text))


def _listed(rows: DataFrame, *kept: str) -> DataFrame:
    """A row per distinct term of each row: ``term`` and ``tf``."""
    each = rows.select(*kept, F.explode(F.arrays_zip("terms", "counts")).alias("_t"))
    return each.select(*kept, F.col("_t.terms").alias("term"), F.col("_t.counts").alias("tf"))


def _filter(vocabulary: DataFrame) -> bytes:
    bits = bytearray(FILTER_BITS // 8)
    for (bit,) in vocabulary.select((F.crc32(F.col("term").cast("binary")) % FILTER_BITS).cast("int")).distinct().toLocalIterator():
        bits[bit >> 3] |= 1 << (bit & 7)
    return bytes(bits)


def _small_terms(vocabulary: DataFrame) -> DataFrame:
    """With a broadcast hint if rows and bytes are counted to be few."""
    rows, size = vocabulary.agg(F.count("*"), F.sum(F.octet_length("term"))).first()
    return F.broadcast(vocabulary) if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else vocabulary


class Index:
    """Impact-sorted ``postings`` of the items' terms in tiers, and what the items want of them.

    ``wanted``: per item and term how often (``r``) the item has it, and for each tier the highest impact that the
    term's list holds ``after`` it. ``items``: for each tier what all of an item's lists hold after it, together.
    """

    def __init__(self, documents: DataFrame, benchmark: DataFrame, tiers: tuple[float, ...] = TIERS) -> None:
        asked = benchmark.select("item_id", terms("text").alias("_t")).select(F.monotonically_increasing_id().alias("_item"), "item_id", "_t.*")
        asked = _listed(materialise(asked, "items"), "_item", "item_id")
        vocabulary = materialise(asked.select("term").distinct().withColumn("t", F.monotonically_increasing_id()), "vocabulary")
        known = _small_terms(vocabulary)

        found = documents.select("doc_id", terms("text", _filter(vocabulary)).alias("_t"))
        counted = materialise(found.select(F.monotonically_increasing_id().alias("_doc"), "doc_id", "_t.*"), "terms")
        held, words = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        listed = _listed(counted, "_doc", "doc_id", "n").join(known, "term").drop("term")

        weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * held + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
        weights = small(materialise(listed.groupBy("t").agg(F.count("*").alias("df")).select("t", weight.alias("w")), "weights"))
        m = F.expr(f"25 + (75 * n * {held}L) div {max(1, words or 0)}L").alias("m")
        impact = F.expr("w * ((1000000000 * tf) div (1000 * tf + 8 * m))").alias("impact")
        scored = listed.join(weights, "t").select("t", "_doc", "doc_id", "tf", "w", m).select("t", "_doc", "doc_id", impact).where("impact > 0")
        edges = scored.agg(F.percentile_approx("impact", [1.0 - s for s in tiers], 10_000)).first()[0] or []
        tier = sum(((F.col("impact") < e).cast("int") for e in edges), F.lit(0)).alias("tier")
        folder, self.tiers = new_folder(documents.sparkSession, "postings"), len(edges) + 1
        scored.select("*", tier).sortWithinPartitions("tier", F.desc("impact")).write.partitionBy("tier").parquet(folder)
        self.postings = documents.sparkSession.read.schema("t bigint, _doc bigint, doc_id bigint, impact bigint, tier int").parquet(folder)

        highest = [F.coalesce(F.max(F.when(F.col("tier") > k, F.col("impact"))), F.lit(0)) for k in range(self.tiers)]
        bounds = small(materialise(self.postings.groupBy("t").agg(F.array(*highest).alias("after")), "bounds"))
        own = asked.join(known, "term").join(bounds, "t").select("_item", "item_id", "t", F.col("tf").alias("r"), "after")
        self.wanted = materialise(own, "wanted")
        unread = F.array(*[F.sum(F.col("r") * F.get("after", F.lit(k))) for k in range(self.tiers)]).alias("unread")
        self.items = materialise(self.wanted.groupBy("_item", "item_id").agg(unread), "items")


def _upper(k: int) -> Column:
    """Upper end of a score after tier ``k``: what is read, and what the lists of the terms not met still hold."""
    return F.col("lower") + F.get("unread", F.lit(k)) - F.col(f"met_{k}")


def search(index: Index, best: int = BEST) -> DataFrame:
    """The best rows of each item, with final scores."""
    state = None
    flags = index.items.select("_item", "unread", F.lit(0).cast("long").alias("threshold"), F.lit(True).alias("open"), F.lit(False).alias("done"))
    for k in range(index.tiers):
        later = range(k, index.tiers)
        tier = index.postings.where(F.col("tier") == k).select("t", "_doc", "doc_id", "impact")
        asks = index.wanted.join(small(flags.where("NOT done").select("_item", "open")), "_item")
        asks = materialise(asks.select("_item", "t", "r", "after", "open"), "asks")

        def read(postings: DataFrame, asks: DataFrame) -> DataFrame:
            met = [(F.col("r") * F.get("after", F.lit(j))).alias(f"met_{j}") for j in later]
            joined = postings.join(small(asks), "t")
            return joined.select("_item", "_doc", "doc_id", (F.col("r") * F.col("impact")).alias("lower"), *met)

        rows = read(tier, asks.where("open"))
        if state is not None:
            held = state.join(small(flags), "_item").where(_upper(k - 1) >= F.col("threshold"))
            closed = held.where("NOT open AND NOT done")
            few = small(materialise(closed.select("_doc").distinct(), "docs"))
            served = read(tier.join(few, "_doc", "left_semi"), asks.where("NOT open"))
            served = served.join(closed.select("_item", "_doc"), ["_item", "_doc"], "left_semi")
            rows = rows.unionByName(served).unionByName(held.select(rows.columns))
        sums = [F.sum(c).alias(c) for c in ("lower", *(f"met_{j}" for j in later))]
        state = materialise(rows.groupBy("_item", "_doc").agg(F.max("doc_id").alias("doc_id"), *sums), "state")
        flags = materialise(_flags(index, state, k, best), "flags")
        if flags.where("NOT done").isEmpty():
            break
    if state is None:
        return index.items.select("item_id", F.lit(None).cast("int").alias("rank"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("_item").orderBy(F.desc("lower"), F.asc_nulls_last("doc_id"), "_doc")
    ranked = state.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(small(index.items.select("_item", "item_id")), "_item").select("item_id", "rank", "doc_id", F.col("lower").alias("score"))


def _flags(index: Index, state: DataFrame, k: int, best: int) -> DataFrame:
    """Per item the threshold after tier ``k``, whether new documents may still enter, and whether all is settled."""
    order = Window.partitionBy("_item").orderBy(F.desc("lower"), "_doc")
    top = state.select("_item", "_doc", "lower").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= best)
    tenth = F.when(F.count("*") >= best, F.min("lower")).otherwise(0).alias("threshold")
    known = index.items.select("_item", "unread").join(top.groupBy("_item").agg(tenth), "_item", "left")
    left = F.get("unread", F.lit(k))
    known = known.select("_item", "unread", F.coalesce("threshold", F.lit(0)).alias("threshold"))
    known = materialise(known.withColumn("open", (left > 0) & (left >= F.col("threshold"))), "thresholds")
    unsettled = state.join(small(known), "_item").where((_upper(k) >= F.col("threshold")) & (_upper(k) > F.col("lower")))
    unsettled = unsettled.select("_item").distinct().withColumn("_unsettled", F.lit(True))
    return known.join(unsettled, "_item", "left").select("_item", "unread", "threshold", "open", (~F.col("open") & F.col("_unsettled").isNull()).alias("done"))


def top_documents(documents: DataFrame, benchmark: DataFrame, best: int = BEST) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the best documents for each item."""
    return search(Index(documents, benchmark), best)
