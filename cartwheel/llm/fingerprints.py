"""One-permutation MinHash fingerprints with optimal densification, stored as low-order bits.

Shingles of ``WORDS`` words are hashed once. The upper bits of a hash name its bin; a bin keeps its smallest
hash. An empty bin takes the value of the first filled bin in its own fixed pseudo-random sequence of bins
(two texts with the same filled bins choose alike). The sequence has 2^ROUNDS places and is walked by
doubling: in round r a bin still empty looks at one other bin as filled after round r - 1. Of every bin
``BITS`` low-order bits are stored, after its value is hashed with the bin's number: else a short text, whose
few values fill all bins, would agree with another by chance in many bins at once. Two unrelated bins agree
with probability 2^-BITS, which ``likeness`` takes out.

All steps are DataFrame expressions on one row: sorting a text's hashes puts its bins next to each other.

Defined results: null and empty texts, and blank ones, have the empty fingerprint; two of these are alike (1),
one is unlike any other (0). Texts of fewer words than a shingle are one shingle. Equal texts have equal
fingerprints, whatever their other columns are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import materialise, small, text_of

WORDS = 5
BIN_BITS, BITS, ROUNDS = 8, 4, 12
BINS = 1 << BIN_BITS
# values of one packed number
PER_LONG = 64 // BITS
SPACE = " \t\n\u000b\f\r"
# documents of a block that are put in order together, and blocks of a block
BLOCK, SUPER = 512, 4096


def _bin(value: Column) -> Column:
    return F.shiftright(value, 63 - BIN_BITS)


def with_fingerprint(rows: DataFrame, text: str, into: str) -> DataFrame:
    """Adds ``into``: BINS values of BITS bits, PER_LONG in a number; null for texts without words.

    Each step is a column of its own, so that no step is computed once per element of the next.
    """
    count = F.size("_words")

    def shingle(i: Column) -> Column:
        return F.xxhash64(*[F.get("_words", i + k) for k in range(WORDS)])

    hashed = F.when(count < WORDS, F.array(F.xxhash64("_words"))).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(count - WORDS, F.lit(0))), shingle))
    lowest = F.filter("_sorted", lambda x, i: (i == 0) | (_bin(x) != _bin(F.get("_sorted", i - 1))))
    after = lambda i: F.coalesce(_bin(F.get("_lowest", i + 1)), F.lit(BINS).cast("long"))
    none = F.lit(None).cast("long")
    spread = F.flatten(F.transform("_lowest", lambda x, i: F.concat(F.array(x), F.array_repeat(none, (after(i) - _bin(x) - 1).cast("int")))))
    spread = F.concat(F.array_repeat(none, _bin(F.get("_lowest", F.lit(0))).cast("int")), spread)

    def round_(known: Column, r: Column) -> Column:
        return F.transform(known, lambda v, i: F.coalesce(v, F.get(known, F.pmod(F.xxhash64(i, r), F.lit(BINS)).cast("int"))))

    filled = F.when(F.size("_lowest") == BINS, F.col("_bins")).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.col("_bins"), round_))
    mask = F.lit((1 << BITS) - 1)
    low = F.transform("_filled", lambda v, i: F.xxhash64(F.coalesce(v, F.get("_lowest", F.lit(0))), i).bitwiseAND(mask))
    packed = F.transform(
        F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)),
        lambda g: F.aggregate(F.slice("_low", g * PER_LONG + 1, F.lit(PER_LONG)), F.lit(0).cast("long"), lambda a, v: F.shiftleft(a, BITS).bitwiseOR(v)),
    )
    bare = F.btrim(F.lower(text_of(text)), F.lit(SPACE))
    return (
        rows.withColumn("_words", F.when(bare != "", F.transform(F.split(bare, r"\s+"), lambda w: F.xxhash64(w))))
        .withColumn("_hashes", F.when(count > 0, hashed))
        .withColumn("_sorted", F.sort_array(F.transform("_hashes", lambda x: F.shiftrightunsigned(x, 1))))
        .withColumn("_lowest", lowest)
        .withColumn("_bins", spread)
        .withColumn("_filled", filled)
        .withColumn("_low", low)
        .withColumn(into, F.when(F.col("_low").isNotNull(), packed))
        .drop("_words", "_hashes", "_sorted", "_lowest", "_bins", "_filled", "_low")
    )


def as_text(fingerprint: str) -> Column:
    """Hexadecimal, one digit per bin; empty for texts without words."""
    return F.coalesce(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""), F.lit(""))


def likeness(a: str, b: str) -> Column:
    """Estimated share of common shingles, from 0 to 1."""

    def differing(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        for shift in (1, 2):
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
        return F.bit_count(z.bitwiseAND(F.lit(0x1111111111111111)))

    unequal = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, n: s + n)
    chance = 2.0**-BITS
    estimate = F.greatest(F.lit(0.0), (1 - unequal / F.lit(float(BINS)) - chance) / (1 - chance))
    same = F.when(F.col(a).isNull() & F.col(b).isNull(), F.lit(1.0)).when(F.col(a).isNull() | F.col(b).isNull(), F.lit(0.0))
    return F.coalesce(same, estimate)


def with_followers(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``_block``, ``_extra``: all rows, and the first row of each block once more at the
    end of the block before it (of the last block before the first), as ``_extra``.

    Blocks are equal ranges of ids, of BLOCK rows on average; ids that are null come first. Only the numbers
    of the blocks are ordered as a whole, in two steps.
    """
    rows = documents.select("doc_id", text_of("text").alias("text"), F.xxhash64(text_of("text")).alias("_tie"))
    span = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    low, width = span.low or 0, max(1, ((span.high or 0) - (span.low or 0) + 1) * BLOCK // max(1, span.n))
    rows = rows.withColumn("_block", F.coalesce(F.floor((F.col("doc_id") - low) / width), F.lit(-1)).cast("long"))
    heads = materialise(rows.groupBy("_block").agg(F.min(F.struct("doc_id", "_tie")).alias("_h")).select("_block", "_h.*"), "heads")

    upper = heads.withColumn("_super", F.floor(F.col("_block") / SUPER)).withColumn("_before", F.lag("_block").over(Window.partitionBy("_super").orderBy("_block")))
    lasts = upper.groupBy("_super").agg(F.max("_block").alias("_last"))
    order = Window.orderBy("_super")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lasts = lasts.select("_super", F.coalesce(F.lag("_last").over(order), F.last("_last").over(whole)).alias("_previous"))
    before = upper.join(lasts, "_super").select(
        F.col("_block").alias("_own"), F.coalesce("_before", "_previous").alias("_to"), F.col("doc_id").alias("_id"), F.col("_tie").alias("_t")
    )
    before = materialise(before, "heads")
    match = (F.col("_block") == F.col("_own")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_t"))
    extra = rows.join(small(before), match).select("doc_id", "text", "_tie", F.col("_to").alias("_block")).dropDuplicates(["_block"])
    return rows.withColumn("_extra", F.lit(False)).unionByName(extra.withColumn("_extra", F.lit(True)))


def fingerprints(documents: DataFrame) -> DataFrame:
    """Each text, and its edited text with the end replaced by the beginning of the next document's."""
    rows = with_fingerprint(with_followers(documents), "text", "_own")
    order = Window.partitionBy("_block").orderBy("_extra", F.col("doc_id").asc_nulls_first(), "_tie")
    following = rows.withColumn("_next", F.lead("text").over(order)).withColumn("_next_own", F.lead("_own").over(order)).where(~F.col("_extra"))
    length = F.char_length("text").cast("long")
    cut = F.floor(length / 4).cast("int")
    following = following.withColumn("_edited", F.concat(F.left("text", length.cast("int") - cut), F.left("_next", cut)))
    done = with_fingerprint(following.select("doc_id", length.alias("n_chars"), "_edited", "_own", "_next_own"), "_edited", "_other")
    return done.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        as_text("_own").alias("fingerprint"),
        as_text("_other").alias("edited_fingerprint"),
        likeness("_own", "_other").alias("near_edited"),
        likeness("_own", "_next_own").alias("near_next"),
    )
