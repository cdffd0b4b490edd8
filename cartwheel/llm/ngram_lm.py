"""Stupid-backoff scores: n-gram counts partitioned by hash, joined to every document's n-grams, summed.

A word scores count(pair) / count(first word) if its pair with the word before occurs ``CUTOFF`` times or more, else
BACKOFF * count(word) / all words. The word before the first one is a mark that occurs once per document. A
document's score is the sum of the logarithms; counts are of all documents.

* Documents are dealt into blocks. A block asks about each of its distinct pairs once, and the pairs are dealt out
  by the hash of their second word: that group holds all its occurrences, so count(pair) and count(word) are both
  known there. The answers go back to the block in the order of its questions, without keys, and the block
  scores its documents with them: every first word of a pair is the second word of the pair before it.
* Words with a share of HEAVY or more are hot keys. At most 2 / HEAVY of them can be, so their exact counts are
  sent to all tasks, and pairs that end in one are dealt out by the hash of the pair. A frequent pair is no hot
  key, as each block asks about it once.

Words are taken as runs of non-space characters, A-Z in lower case. They are known by 40 bits of their hash,
within a group by the lower 32 and the group itself; groups and blocks grow in number with the corpus.

Defined results: null, empty and blank texts have no words, score 0 and no mean. Rows that repeat an id and its
text have the same score each. Null ids are kept, and so is every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import LOWER, materialise, parallelism, text_of

CUTOFF, BACKOFF = 2, 0.4
HEAVY = 1 / 16384
# words of a block and pairs of a group, each of which one task holds
BLOCK_WORDS, GROUP_PAIRS = 1_000_000, 1_500_000
REMEMBERED = 500_000
MARK = 0
_U = np.uint64
_40 = _U((1 << 40) - 1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = 1 + xxhash.xxh3_64_intdigest(word) % ((1 << 40) - 1)
        return value


_HASHES = _Hashes()


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split()


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of some texts, the words before them, and the place of their text."""
    if len(_HASHES) > REMEMBERED:
        _HASHES.clear()
    tokens = [words(t) for t in texts]
    sizes = np.array([len(t) for t in tokens])
    flat = np.fromiter((_HASHES[w] for t in tokens for w in t), _U, int(sizes.sum()))
    before = np.r_[_U(MARK), flat[:-1]] if len(flat) else flat
    starts = np.cumsum(sizes) - sizes
    before[starts[sizes > 0]] = MARK
    return flat, before, np.repeat(np.arange(len(texts)), sizes)


def pair_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first * _U(0x9E3779B97F4A7C15) ^ second
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _counts(documents: DataFrame, candidates: np.ndarray | None) -> DataFrame:
    """Per kind (0: words, 1: all words, 2: texts with words) hash and count: of a batch's frequent words, or of the candidates."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, before, _ = hashed(batch.column(0).to_pylist())
            own, n = np.unique(flat if candidates is None else flat[_among(flat, candidates)], return_counts=True)
            if candidates is None:
                often = n >= max(2, HEAVY / 2 * len(flat))
                own, n = own[often], n[often]
            kinds = np.r_[1, 2, np.zeros(len(own), int)].astype(np.int32)
            hashes, counts = np.r_[0, 0, own.view(np.int64)], np.r_[len(flat), (before == MARK).sum(), n].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(hashes), pa.array(counts)], ["kind", "hash", "n"])

    return documents.select(text_of("text").alias("text")).mapInArrow(count, "kind int, hash long, n long").groupBy("kind", "hash").agg(F.sum("n").alias("n"))


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def heavy_counts(documents: DataFrame) -> SimpleNamespace:
    """Exact counts of the hot words (``words``: ordered hashes), of all words and of texts with words.

    A word with a share of HEAVY has half of that at least in the batches that hold half of its occurrences;
    sums that reach half of HEAVY there are few.
    """
    first = materialise(_counts(documents, None), "counts")
    totals = {r.kind: r.n for r in first.where("kind > 0").collect()}
    every = totals.get(1, 0)
    frequent = first.where((F.col("kind") == 0) & (F.col("n") >= HEAVY / 2 * every)).collect()
    names = np.sort(np.array([r.hash for r in frequent], np.int64).view(_U))
    found = _counts(documents, names).where("kind = 0").collect() if len(names) else []
    own = sorted((r.hash % (1 << 64), r.n) for r in found)
    return SimpleNamespace(all=every, marks=totals.get(2, 0), words=np.array([h for h, _ in own], _U), counts=np.array([n for _, n in own], np.int64))


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, most of them small: a byte each, and eight more from 255 on."""
    large = values >= 255
    return np.where(large, 255, values).astype(np.uint8).tobytes() + values[large].astype("<i8").tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    values = np.frombuffer(data, np.uint8, n).astype(np.int64)
    values[values == 255] = np.frombuffer(data, "<i8", offset=n)
    return values


class Question:
    """The distinct pairs of a block in the order of their groups: group, second word's name, first word, number."""

    def __init__(self, texts: list[str], heavy: SimpleNamespace, groups: int) -> None:
        flat, before, self.place = hashed(texts)
        self.first = before == MARK
        often = _among(flat, heavy.words)
        pair = pair_of(before, flat)
        # heavy words are in groups of their own, named by their place among the heavy ones
        group = np.where(often, ((pair >> _U(32)) * _U(groups) >> _U(32)) + _U(groups), (((flat & _40) >> _U(8)) * _U(groups)) >> _U(32))
        name = np.where(often, np.searchsorted(heavy.words, flat).astype(_U), flat & _U(0xFFFFFFFF))
        key = name << _U(32) | before & _U(0xFFFFFFFF)
        order = np.lexsort((key, group))
        key, group = key[order], group[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])][: len(key)]
        self.at = np.empty(len(order), np.int64)
        self.at[order] = np.cumsum(new) - 1
        self.key, self.group = key[new], group[new].astype(np.int64)
        self.n = np.diff(np.r_[np.flatnonzero(new), len(key)])
        self.cuts = np.flatnonzero(np.r_[True, self.group[1:] != self.group[:-1], True]) if len(self.key) else np.zeros(1, int)

    def segments(self) -> Iterator[tuple[int, slice]]:
        for start, end in zip(self.cuts, self.cuts[1:]):
            yield int(self.group[start]), slice(start, end)


def _runs(names: np.ndarray) -> np.ndarray:
    """Where runs of the same second word begin, and the end."""
    return np.flatnonzero(np.r_[True, names[1:] != names[:-1], True])


ASKED = "group long, block long, names binary, runs binary, firsts binary, numbers binary"
TOLD = "block long, group long, pairs binary, words binary"


def asked(dealt: DataFrame, heavy: SimpleNamespace, groups: int) -> DataFrame:
    sent = dealt.sparkSession.sparkContext.broadcast(heavy)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        block, question = table["block"][0].as_py(), Question(table["text"].to_pylist(), sent.value, groups)
        rows = []
        for group, own in question.segments():
            names = (question.key[own] >> _U(32)).astype("<u4")
            cuts = _runs(names)
            firsts = (question.key[own] & _U(0xFFFFFFFF)).astype("<u4")
            rows.append((group, block, names[cuts[:-1]].tobytes(), _packed(np.diff(cuts)), firsts.tobytes(), _packed(question.n[own])))
        if rows:
            names = ["group", "block", "names", "runs", "firsts", "numbers"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows, strict=True)], names)

    return dealt.groupBy("block").applyInArrow(ask, ASKED)


def told(questions: DataFrame) -> DataFrame:
    """Per question the counts of its pairs and of its second words, over all blocks."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        names, keys, numbers, sizes = [], [], [], []
        for own, runs, firsts, n in zip(*(table[c].to_pylist() for c in ("names", "runs", "firsts", "numbers")), strict=True):
            own, firsts = np.frombuffer(own, "<u4").astype(_U), np.frombuffer(firsts, "<u4").astype(_U)
            every = np.repeat(own, _unpacked(runs, len(own)))
            names.append(own)
            keys.append(every << _U(32) | firsts)
            numbers.append(_unpacked(n, len(firsts)))
            sizes.append((len(firsts), len(own)))
        weight = np.concatenate(numbers)
        key = np.concatenate(keys)
        pairs, at = np.unique(key, return_inverse=True)
        totals = np.bincount(at, weight, len(pairs)).astype(np.int64)
        # pairs are in the order of their second word
        seconds = pairs >> _U(32)
        cuts = _runs(seconds)
        words_, of_word = seconds[cuts[:-1]], np.add.reduceat(totals, cuts[:-1])
        pair_counts = np.split(totals[at], np.cumsum([m for m, _ in sizes])[:-1])
        word_counts = [of_word[np.searchsorted(words_, own)] for own in names]
        columns = [table["block"], table["group"], pa.array([_packed(x) for x in pair_counts]), pa.array([_packed(x) for x in word_counts])]
        yield from pa.Table.from_arrays(columns, names=["block", "group", "pairs", "words"]).to_batches()

    return questions.groupBy("group").applyInArrow(answer, TOLD)


def scores(documents: DataFrame) -> DataFrame:
    """Per document: number of words, score (sum of natural logarithms), mean score per word."""
    documents = documents.select("doc_id", text_of("text").alias("text"))
    heavy = heavy_counts(documents)
    blocks = max(parallelism(documents), heavy.all // BLOCK_WORDS)
    groups = max(4, heavy.all // (2 * GROUP_PAIRS))
    dealt = documents.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"))
    answers = told(asked(dealt, heavy, groups))
    sent = documents.sparkSession.sparkContext.broadcast(heavy)

    def score(docs: pa.Table, told_: pa.Table) -> pa.Table:
        known, question = sent.value, Question(docs["text"].to_pylist(), sent.value, groups)
        pairs, singles = np.zeros(len(question.key), np.int64), np.zeros(len(question.key), np.int64)
        found = dict(zip(told_["group"].to_pylist(), zip(told_["pairs"].to_pylist(), told_["words"].to_pylist(), strict=True), strict=True))
        for group, own in question.segments():
            names = question.key[own] >> _U(32)
            cuts = _runs(names)
            of_pairs, of_words = found[group]
            pairs[own] = _unpacked(of_pairs, len(names))
            counts = known.counts[names[cuts[:-1]].astype(np.int64)] if group >= groups else _unpacked(of_words, len(cuts) - 1)
            singles[own] = np.repeat(counts, np.diff(cuts))
        pair, single = pairs[question.at], singles[question.at]
        before = np.where(question.first, known.marks, np.r_[0, single[:-1]][: len(single)])
        value = np.log(np.where(pair >= CUTOFF, pair / np.maximum(before, 1), BACKOFF * single / max(1, known.all)))
        n = np.bincount(question.place, minlength=len(docs))
        total = np.bincount(question.place, value, len(docs))
        mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
        return pa.table({"doc_id": docs["doc_id"], "n_words": pa.array(n.astype(np.int64)), "score": pa.array(total), "mean_score": mean})

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, "doc_id long, n_words long, score double, mean_score double")
