"""Toxicity by compression distance: two zstandard dictionaries, and what each saves on every window.

Two dictionaries are trained on a bounded sample of labelled texts: one on ordinary texts, one on the stretches of
toxic texts, of up to ``PHRASE`` words, that are typical of them. A stretch is typical if it is ``RATIO`` times as
frequent among toxic texts as among ordinary ones and if chance would not give such an excess to any of the
stretches looked at (their log-likelihood ratio exceeds the logarithm of their number). So a word that some ordinary
texts hold too may be typical, and so may a phrase of ordinary words. What training leaves out of the toxic
dictionary stands before it.

A window is compressed with the ordinary dictionary alone and with both; its gain is the share of its compressed
bytes that the toxic dictionary saves. Windows are the single words, and two and ``PHRASE`` words from each place
where the toxic dictionary has the next two words next to each other. A text's value is the largest gain of its
windows. The threshold is calibrated on sampled texts that the dictionaries have not seen, with errors weighed by
how many labelled texts each class has, and a score of 0.7 stands for it.

zstandard looks for no match in the last bytes of its input and stores what shrinks too little as it is. So
every window is followed by the same anchor, which is in both dictionaries.

The sample is bounded by the number of texts per class (SAMPLE_TEXTS, those of the smallest hash of the id)
and their length (SAMPLE_CHARS); texts to be scored are read whole, whatever their length.

Defined results: null and empty texts have no window and value 0, hence a low score. Without both classes
among the labels there is nothing to learn: every score is the smoothed share of toxic labels, below 0.7
whatever the labels are. Ids labelled several times count as toxic if one label says so; labels or texts
that are null are not learnt from. Repeated documents each give a row.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import text_of
from cartwheel.llm.decontamination import normalise

SAMPLE_TEXTS, SAMPLE_CHARS = 2_500, 16_000
PHRASE = 3
ORDINARY_BYTES, TOXIC_BYTES = 32 << 10, 32 << 10
LEVEL = 9
# a stretch is typical of toxic texts if it is so many times as frequent there, and in so many of them
RATIO, TYPICAL_TEXTS = 8, 3
# a sampled text with this share of its rare words known from another one is a near copy
COPY_SHARE = 0.5
# fewest bytes that count as a gain
LEAST_GAIN = 3
CUT = 0.7
ANCHOR = b"~0123456789~abcdefghij~"
REMEMBERED = 500_000


def words(text: str) -> list[bytes]:
    return normalise(text)[0].encode("latin-1").split()


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """A third of all ids, by the checksum of their text; their labels are never learnt from."""
    name = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(name.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def trained(size: int, samples: list[bytes], segment: int) -> bytes:
    """A dictionary's content; where there is too little for training, the most frequent words themselves."""
    try:
        raw = zstandard.train_dictionary(size, samples, k=segment, d=6, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        often = [w for w, _ in Counter(w for s in samples for w in s.split()).most_common(size // 4)]
        return b" ".join(reversed(often))[-size:]
    # entropy tables stand before the content; both dictionaries are used for their content only
    return raw[min(512, len(raw) // 4) :]


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    threshold: float
    slope: float
    share: float

    def score(self, value: float) -> float:
        if not self.toxic:
            return min(self.share, CUT - 0.01)
        x = self.slope * (value - self.threshold) + math.log(CUT / (1 - CUT))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))


class Gauge:
    """Gains of windows under a model; a worker remembers those of short windows."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.alone, self.both = _compressor(ordinary), _compressor(ordinary + toxic)
        self.base = len(self.alone.compress(ANCHOR))
        self.known: dict[bytes, float] = {}
        content = toxic.split()
        self.pairs = set(zip(content, content[1:]))

    def gain(self, window: bytes) -> float:
        found = self.known.get(window)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            text = b" " + window + b" " + ANCHOR
            without = len(self.alone.compress(text))
            saved = without - len(self.both.compress(text))
            found = saved / max(1, without - self.base) if saved >= LEAST_GAIN else 0.0
            if len(window) < 64:
                self.known[window] = found
        return found

    def value(self, text: str) -> tuple[float, bytes]:
        """Largest gain of the text's windows, and that window."""
        every = words(text)
        windows = set(every)
        for i, pair in enumerate(zip(every, every[1:])):
            if pair in self.pairs:
                windows |= {b" ".join(pair), b" ".join(every[i : i + PHRASE])}
        worst = max(windows, key=lambda w: (self.gain(w), w), default=b"")
        return (self.gain(worst), worst) if worst else (0.0, b"")


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    raw = content + ANCHOR
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL,
        dict_size=len(raw),
        source_size=64,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
    )
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=settings
    )


def stretches(text: list[bytes]) -> set[bytes]:
    return {b" ".join(text[i : i + n]) for n in range(1, PHRASE + 1) for i in range(len(text) - n + 1)}


def excess(toxic: int, toxic_texts: int, ordinary: int, ordinary_texts: int) -> float:
    """Log-likelihood ratio of a stretch's texts being more frequent in one class, against equally frequent."""
    share = toxic_texts / (toxic_texts + ordinary_texts)
    part = toxic / (toxic + ordinary)
    if part <= share:
        return 0.0
    return toxic * math.log(part / share) + (ordinary * math.log((1 - part) / (1 - share)) if ordinary else 0.0)


def typical_stretches(bad: list[list[bytes]], good: list[list[bytes]]) -> set[bytes]:
    """Stretches typical of the texts ``bad``; those that hold a shorter one are left out."""
    counts = Counter(s for d in bad for s in stretches(d))
    asked = {s for s, n in counts.items() if n >= max(1, min(TYPICAL_TEXTS, len(bad) // 3))}
    ordinary = Counter(s for d in good for s in stretches(d) & asked)
    least = math.log(max(1, len(asked)))
    found: set[bytes] = set()
    for s in sorted(asked, key=lambda s: (s.count(b" "), s)):
        n, other = counts[s], ordinary[s]
        if n * len(good) < RATIO * other * len(bad) or excess(n, len(bad), other, len(good)) < least:
            continue
        parts = s.split(b" ")
        if not any(b" ".join(parts[i:j]) in found for i in range(len(parts)) for j in range(i + 1, len(parts) + 1)):
            found.add(s)
    return found


def without_copies(texts: list[list[bytes]], usual: set[bytes]) -> list[list[bytes]]:
    """Texts that are no near copies of earlier ones, by the words that ordinary texts do not have."""
    met: set[bytes] = set()
    first: list[list[bytes]] = []
    for text in texts:
        rare = set(text) - usual
        if rare and len(rare & met) > COPY_SHARE * len(rare) > TYPICAL_TEXTS:
            continue
        met |= rare
        first.append(text)
    return first


def without(text: list[bytes], typical: set[bytes]) -> list[bytes]:
    """The words that are in no typical stretch."""
    held = {j for n in range(1, PHRASE + 1) for i in range(len(text) - n + 1) if b" ".join(text[i : i + n]) in typical for j in range(i, i + n)}
    return [w for i, w in enumerate(text) if i not in held]


def learn(toxic: list[str], ordinary: list[str], weight: float = 1.0) -> Model:
    """Dictionaries from two thirds of the texts, the threshold from the rest; ``weight`` of an ordinary text's error."""
    share = (len(toxic) + 1) / (len(toxic) + len(ordinary) + 2)
    if len(toxic) < 2 or len(ordinary) < 2:
        return Model(b"", b"", 0.0, 1.0, share)
    bad, good = ([words(t) for i, t in enumerate(x) if i % 3 != 1] for x in (toxic, ordinary))
    first = without_copies(bad, {w for d in good for w in d})
    typical = typical_stretches(first, good)
    samples = []
    for text in first:
        kept = (b" ".join(text[i : i + n]) for i in range(len(text)) for n in range(1, PHRASE + 1))
        samples.append(b" " + b" ".join(s for s in kept if s in typical) + b" ")
    samples = [s for s in samples if len(s) > 8]
    # ordinary texts that quote a typical stretch must not teach it as ordinary
    usual_content = trained(ORDINARY_BYTES, [b" " + b" ".join(without(d, typical)) + b" " for d in good], 24)
    size = max(1 << 10, min(TOXIC_BYTES, sum(map(len, samples)) // 8))
    toxic_content = trained(size, samples, 20) or b" "
    part = Gauge(usual_content, toxic_content)
    whole = Gauge(usual_content, b" " + b" ".join(sorted(typical)) + b" ")
    missed = sorted(s for s in typical if part.gain(s) < whole.gain(s))
    toxic_content = b" " + b" ".join(missed) + b" " + toxic_content
    gauge = Gauge(usual_content, toxic_content)
    values = [(gauge.value(t)[0], label) for label, x in ((1, toxic), (0, ordinary)) for i, t in enumerate(x) if i % 3 == 1]
    threshold, slope = calibrated(values, weight)
    return Model(usual_content, toxic_content, threshold, slope, share)


def calibrated(values: list[tuple[float, int]], weight: float = 1.0) -> tuple[float, float]:
    """The cut with least errors, in the middle of its gap, and the slope of greatest likelihood."""
    ordered = sorted(values)
    best, cut, errors = None, 0.5, sum(weight for _, label in ordered if not label)
    for (low, label), (high, _) in zip(ordered, [*ordered[1:], (1.0, 1)]):
        errors += 1 if label else -weight
        if high > low and (best is None or (round(errors, 6), low - high) < best):
            best, cut = (round(errors, 6), low - high), (low + high) / 2

    def cost(slope: float) -> float:
        return 0.01 * slope + sum(
            (1 if label else weight) * math.log1p(math.exp(-min(50.0, (1 if label else -1) * (slope * (v - cut) + math.log(CUT / (1 - CUT))))))
            for v, label in ordered
        )

    return cut, min((2.0**k for k in range(1, 9)), key=cost)


def sample(documents: DataFrame, labels: DataFrame) -> tuple[list[str], list[str], float]:
    """At most SAMPLE_TEXTS texts of each class, none of them held out: toxic, ordinary; and how many times as many
    labelled ids an ordinary one stands for."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    found = []
    for wanted in (1, 0):
        # twice as many ids as needed, as some have no text or too long a one
        order = F.xxhash64("doc_id")
        ids = known.where((F.col("_toxic") > 0) == F.lit(bool(wanted))).orderBy(order, "doc_id").limit(2 * SAMPLE_TEXTS)
        texts = (
            documents.select("doc_id", "text")
            .where(F.col("text").isNotNull() & (F.char_length("text") <= SAMPLE_CHARS))
            .join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
        )
        rows = texts.orderBy(order, "doc_id", F.xxhash64("text")).limit(SAMPLE_TEXTS).select("text").collect()
        found.append([r.text for r in rows])
    n = known.agg(F.count_if(F.col("_toxic") > 0), F.count_if(F.col("_toxic") <= 0)).first()
    stands_for = [n[i] / max(1, len(texts)) for i, texts in enumerate(found)]
    return found[0], found[1], stands_for[1] / stands_for[0] if all(stands_for) else 1.0


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    return learn(*sample(documents, labels))


def scored(text: str | Column, model: Model) -> Column:
    """Struct of score, value (largest gain) and the window that has it."""

    @F.arrow_udf("struct<score:double,value:double,worst:binary>")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gauge = Gauge(model.ordinary, model.toxic)
        for texts in parts:
            rows = [gauge.value(t) if model.toxic else (0.0, b"") for t in texts.to_pylist()]
            values = pa.array([v for v, _ in rows], pa.float64())
            scores = pa.array([model.score(v) for v, _ in rows], pa.float64())
            yield pa.StructArray.from_arrays([scores, values, pa.array([w for _, w in rows], pa.binary())], ["score", "value", "worst"])

    return score(text_of(text))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether its label was held out, its score, and whether that reaches the cut."""
    rows = documents.select("doc_id", scored("text", fit(documents, labels)).alias("_s"))
    return rows.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_s.score").alias("score"),
        (F.col("_s.score") >= CUT).cast("int").alias("predicted"),
        F.col("_s.value").alias("value"),
        F.decode("_s.worst", "UTF-8").alias("worst"),
    )


def acceptable(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the cut, with their columns."""
    model = fit(documents, labels)
    return documents.withColumn("_toxicity", scored("text", model)).where(F.col("_toxicity.score") < CUT).select(*[documents[c] for c in documents.columns])
