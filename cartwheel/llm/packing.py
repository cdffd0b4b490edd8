"""Token sequences of a fixed length: best-fit decreasing, found by a segment tree over free capacity.

Documents' ids are cut into pieces of at most ``LENGTH`` tokens, one after the other, so that nothing is lost.
Each task packs its pieces in blocks of at most ``BLOCK_TOKENS`` tokens: the longest first, each into the row
with the least free capacity that still holds it. The segment tree has a leaf per free capacity; the first
leaf at or above a length that has an open row is found in log(LENGTH) steps. A row of ``ids`` is padded to the full
length; rows of one block are one matrix. Nothing is shuffled, and no task holds more than a block.

Columns of the written table: ``matrix``, ``row``, ``ids`` (LENGTH values of ``width`` bytes, little-endian),
``cu_seqlens`` (0, then the end of each segment), ``resets`` (where position ids begin again at 0, the start of
each segment), ``doc_ids``, ``numbers`` (the document within its matrix, as ids can repeat) and ``offsets``
(the segment's first token within its document).

Defined results: a null or empty text is a segment of no tokens, so that every document is in the table.
Null ids stay null. Ties in length keep the order of arrival. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.byte_bpe import codec
from cartwheel.llm.common import materialise, text_of

LENGTH = 2048
# the fast tokenizer's pattern runs out of stack on long blank stretches; these texts go to the tree's encoder
LONG_BLANK = re.compile(r"\s{4096}")
BLOCK_TOKENS = 4 << 20
PACKED = "matrix string, row int, width int, n_tokens int, ids binary, cu_seqlens array<int>, resets array<int>, doc_ids array<long>, numbers array<int>, offsets array<int>"

_ENCODINGS: dict[tuple[str, str], tiktoken.Encoding] = {}


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """One per worker process and file; no special tokens."""
    if (path, pattern) not in _ENCODINGS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODINGS[path, pattern] = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path, pattern]


def token_ids(text: str | Column, path: str, pattern: str) -> Column:
    """Ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    def ids(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoding(path, pattern)

        def of(text: str) -> bytes:
            if LONG_BLANK.search(text):
                return codec(path, pattern).encode(text)
            return np.asarray(own.encode_ordinary(text), "<u4").tobytes()

        for texts in parts:
            yield pa.array([of(t) for t in texts.to_pylist()], pa.binary())

    return ids(text_of(text))


class Capacities:
    """Segment tree over free capacities 0 to ``most``: which have an open row."""

    def __init__(self, most: int) -> None:
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        node = self.size + capacity
        while node:
            self.count[node] += by
            node //= 2

    def take(self, length: int) -> tuple[int, int] | None:
        """An open row of the least capacity that holds the length, and that capacity; it is no longer open."""
        node = self.size + length
        while not self.count[node]:
            # to the next subtree on the right
            while node & 1:
                node //= 2
            if not node:
                return None
            node += 1
        while node < self.size:
            node *= 2
            node += not self.count[node]
        capacity = node - self.size
        self._change(capacity, -1)
        return self.rows[capacity].pop(), capacity


def packed_rows(lengths: list[int], most: int = LENGTH) -> list[list[int]]:
    """Pieces per row, best-fit decreasing."""
    free = Capacities(most)
    rows: list[list[int]] = []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = free.take(lengths[piece])
        if found is None:
            rows.append([])
            found = len(rows) - 1, most
        row, capacity = found
        rows[row].append(piece)
        free.add(capacity - lengths[piece], row)
    return rows


_SCHEMA = pa.schema(
    [("matrix", pa.string()), ("row", pa.int32()), ("width", pa.int32()), ("n_tokens", pa.int32()), ("ids", pa.binary())]
    + [("cu_seqlens", pa.list_(pa.int32())), ("resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64()))]
    + [("numbers", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int32()))]
)


def matrix(name: str, documents: list[tuple[int | None, int, int, np.ndarray]], length: int, pad: int, vocabulary: int) -> Iterator[pa.RecordBatch]:
    """One block's rows. ``documents``: id, number, offset of the piece, its ids."""
    kind = np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")
    out = []
    for row, members in enumerate(packed_rows([len(d[3]) for d in documents], length)):
        ends = np.cumsum([0, *(len(documents[i][3]) for i in members)])
        ids = np.full(length, pad, kind)
        ids[: ends[-1]] = np.concatenate([documents[i][3] for i in members])
        own = [documents[i] for i in members]
        out.append(
            {
                "matrix": name,
                "row": row,
                "width": kind.itemsize,
                "n_tokens": int(ends[-1]),
                "ids": ids.tobytes(),
                "cu_seqlens": ends.tolist(),
                "resets": ends[:-1].tolist(),
                "doc_ids": [d[0] for d in own],
                "numbers": [d[1] for d in own],
                "offsets": [d[2] for d in own],
            }
        )
        if len(out) == 256:
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, _SCHEMA)


def packed(documents: DataFrame, pad: int, vocabulary: int, length: int = LENGTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Packed rows of ``documents`` (``doc_id``, ``ids`` as binary)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, blocks, held, pieces, number = TaskContext.get().partitionId(), 0, 0, [], 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                every = np.frombuffer(ids, "<u4")
                for offset in range(0, max(1, len(every)), length):
                    pieces.append((doc_id, number, offset, every[offset : offset + length]))
                held, number = held + len(every), number + 1
                if held >= block_tokens:
                    yield from matrix(f"{part:06d}-{blocks:05d}", pieces, length, pad, vocabulary)
                    blocks, held, pieces, number = blocks + 1, 0, [], 0
        if pieces:
            yield from matrix(f"{part:06d}-{blocks:05d}", pieces, length, pad, vocabulary)

    return documents.select("doc_id", "ids").mapInArrow(pack, PACKED)


def unpacked(rows: DataFrame) -> DataFrame:
    """The documents again: ``matrix``, ``number``, ``doc_id``, ``ids`` (binary, ``width`` bytes each)."""
    each = rows.select("matrix", "width", "ids", "cu_seqlens", F.posexplode("numbers").alias("_i", "number"), "doc_ids", "offsets")
    start, end = F.get("cu_seqlens", F.col("_i")), F.get("cu_seqlens", F.col("_i") + 1)
    piece = F.substring(F.col("ids"), start * F.col("width") + 1, (end - start) * F.col("width"))
    each = each.select("matrix", "number", F.get("doc_ids", "_i").alias("doc_id"), F.struct(F.get("offsets", "_i").alias("o"), F.hex(piece).alias("p")).alias("_p"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("_p")), lambda x: x.p), "")
    return each.groupBy("matrix", "number", "doc_id").agg(F.unhex(joined).alias("ids"))


def written(documents: DataFrame, path: str, pattern: str, pad: int, vocabulary: int) -> DataFrame:
    """Encode, pack, write, and the written table."""
    return materialise(packed(documents.select("doc_id", token_ids("text", path, pattern).alias("ids")), pad, vocabulary), "packed")


def summary(rows: DataFrame) -> DataFrame:
    """One row per packed sequence, with a digest in place of its ids."""
    return rows.select("matrix", "row", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "cu_seqlens", "resets", "doc_ids", "numbers", "offsets")
