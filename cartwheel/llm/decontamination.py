"""Benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark, texts scanned once.

Words are maximal runs of letters, digits and non-ASCII characters after A-Z are lower-cased. A window is
``size`` consecutive words of an item; a shorter item is one window. Every window is a pattern of the
automaton, with a space on both sides, so that it matches whole words only; overlapping and nested matches
are all reported.

Defined results: null or empty text, and text of separators only: no words, not contaminated. Items without
words have no window. An item given twice counts once; items with a null id mark words but are not listed.
Repeated documents each give a row; columns of the documents besides the text pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import LOWER, text_of

WINDOW = 13
# benchmark bytes that one automaton (and one broadcast) holds: about 400 bytes of trie for each, 0.4 GB in all; more
# make several automata, one pass each
AUTOMATON_BYTES = 1 << 20
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
# lower case first, so that A-Z are no separators
NORMAL = LOWER.translate(bytes.maketrans(SEPARATORS, b" " * len(SEPARATORS)))
SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
MATCH = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)


def normalise(text: str) -> tuple[str, int]:
    """Words with one space around each, as a string of bytes, and their number."""
    words = text.encode("utf-8", "surrogatepass").translate(NORMAL).split()
    return (f" {b' '.join(words).decode('latin-1')} " if words else "", len(words))


def windows(text: str, size: int = WINDOW) -> set[str]:
    words = normalise(text)[0].split(" ")[1:-1]
    if not words:
        return set()
    return {f" {' '.join(words[i : i + size])} " for i in range(max(1, len(words) - size + 1))}


def automaton(items: list[tuple[str | None, str]], size: int = WINDOW) -> ahocorasick.Automaton:
    """Each window leads to its number of words, its length and the ids of the items that have it."""
    owners: dict[str, set[str]] = {}
    for item, text in items:
        for window in windows(text, size):
            owners.setdefault(window, set()).update([] if item is None else [item])
    found = ahocorasick.Automaton()
    for window, ids in owners.items():
        found.add_word(window, (window.count(" ") - 1, len(window), tuple(sorted(ids))))
    if owners:
        found.make_automaton()
    return found


def spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as start and end in the original text."""
    at = [m.span() for i, m in enumerate(WORD.finditer(text.lower() if text.isascii() else text.translate(_LOWER_STR)))]
    runs: list[tuple[int, int]] = []
    last = -2
    for i in hit.tolist():
        runs.append((runs.pop()[0] if i == last + 1 else at[i][0], at[i][1]))
        last = i
    return runs


_LOWER_STR = {ord(a): ord(a.lower()) for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def scan(text: str, found: ahocorasick.Automaton, hits: list[int], items: list[str]) -> tuple:
    """What one automaton adds to the hit words and items known before."""
    normal, n_words = normalise(text)
    ids, ends = set(items), []
    if len(found) and n_words:
        ends = [(end, *value) for end, value in found.iter(normal)]
    if not ends and not len(hits):
        return n_words, [], [], []
    marked = np.zeros(n_words, bool)
    marked[np.asarray(hits, int)] = True
    # the word that begins after the k-th space is word k
    first = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), np.uint8) == 32)
    for end, words, length, owners in ends:
        start = int(np.searchsorted(first, end - length + 1))
        marked[start : start + words] = True
        ids.update(owners)
    hit = np.flatnonzero(marked)
    return n_words, hit.tolist(), sorted(ids), spans(text, hit)


def matches(documents: DataFrame, text: str, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, into: str = "match") -> DataFrame:
    """``documents`` with a struct column ``into``: number of words, indexes of hit words, items, spans.

    The benchmark is the side that is sent out. Its bytes are counted first; beyond AUTOMATON_BYTES its
    items are dealt into as many groups by the hash of their text, and the documents pass one automaton
    after the other, each adding its hits.
    """
    spark = documents.sparkSession
    wanted = benchmark.select(F.col(item_id).cast("string").alias("item"), text_of(item_text).alias("text")).distinct()
    volume = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = 1 + int(volume // AUTOMATON_BYTES)
    documents = documents.withColumn(into, F.lit(None).cast(MATCH))
    for group in range(groups):
        own = wanted.where(F.pmod(F.xxhash64("text"), F.lit(groups)) == group)
        sent = spark.sparkContext.broadcast([(r.item, r.text) for r in own.toLocalIterator()])

        @F.pandas_udf(MATCH)
        def match(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            found = automaton(sent.value, size)  # noqa: B023
            for texts, hits, items in parts:
                rows = [
                    scan(t, found, [] if h is None else h, [] if i is None else i)
                    for t, h, i in zip(texts, hits, items, strict=True)
                ]
                yield pd.DataFrame(rows, columns=["n_words", "hits", "items", "spans"])

        documents = documents.withColumn(into, match(text_of(text), F.col(f"{into}.hits"), F.col(f"{into}.items")))
    return documents


def contaminated(match: str = "match") -> Column:
    """At least one word is hit, and hit words are a twentieth of all or more."""
    hit = F.size(f"{match}.hits")
    return (hit > 0) & (20 * hit >= F.col(f"{match}.n_words"))


def decontamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document what the benchmark covers of it."""
    found = matches(documents.select("doc_id", "text"), "text", benchmark, into="_match")
    return found.select(
        "doc_id",
        F.col("_match.n_words").alias("n_words"),
        F.size("_match.hits").cast("long").alias("n_hit"),
        F.size("_match.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_match.items", ","), 256).alias("items_sha256"),
        contaminated("_match").alias("contaminated"),
        F.col("_match.spans").alias("spans"),
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    found = matches(documents, "text", benchmark, into="_match")
    return found.where(~contaminated("_match")).select(*[found[c] for c in documents.columns])
