"""Byte-level BPE by tree reduction; decoding by concatenation.

A text is cut into pieces by the tokenizer's pattern; each piece is encoded on its own. Encodings of the
same rank table form a monoid: two of them join into the encoding of the concatenated bytes. ``encode``
splits a long piece into halves, encodes both and joins them. ``join`` re-encodes the bytes around the
border, and widens that window until both its outer borders are stable.

Why that is enough: a sequence of tokens is the encoding of its bytes exactly if each two neighbours are the
encoding of theirs (a merge that crosses a border would already happen between these two). Left and right of
the window all neighbours come from true encodings, inside it too; ``stable`` tests the two that remain.

Defined results: null and empty texts have no tokens and decode to no bytes. Special tokens do not exist:
their spelling is ordinary text. A text of one unbroken run is one piece, and costs n log n.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import text_of

# longest piece that is merged directly
LEAF_BYTES = 32
# pieces, and pairs of tokens, whose ids a worker remembers; the memory starts anew beyond
REMEMBERED = 400_000
# longest piece that is remembered
REMEMBERED_BYTES = 48
# from here on merging by a heap is faster
HEAP_BYTES = 96
# characters for which the standard library's classes agree with the Unicode classes of the pattern
PLAIN = re.compile("[\t-\r -~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*")


def plain_pattern(pattern: str) -> re.Pattern | None:
    """The same pattern for the standard library, usable on PLAIN texts only; None if it cannot be said."""
    if re.search(r"\\p\{(?![LN]\})|\\P", pattern):
        return None
    said = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
    return None if r"\p" in said else re.compile(said)


class Codec:
    """Encoder and decoder of one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF_BYTES) -> None:
        self.ranks = ranks
        self.leaf = leaf
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.none = len(self.tokens)
        self.single = [ranks.get(bytes([x]), self.none) for x in range(256)]
        # every way to make a token of two
        self.merges = {
            (ranks[t[:i]], ranks[t[i:]]): rank
            for t, rank in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        }
        self.pattern = regex.compile(pattern)
        self.plain = plain_pattern(pattern)
        self.pairs: dict[tuple[int, int], list[int]] = {}
        self.seen = _Seen(self)

    @classmethod
    def from_file(cls, path: str, pattern: str) -> Codec:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return cls(ranks, pattern)

    def merged(self, piece: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, the leftmost first, until none is left."""
        if len(piece) > HEAP_BYTES:
            return self._merged_long([piece[i : i + 1] for i in range(len(piece))])
        rank_of, none = self.merges.get, self.none
        parts = [self.single[x] for x in piece]
        last = len(parts) - 2
        of = [rank_of(x, none) for x in zip(parts, parts[1:])]
        while last >= 0:
            low = min(of)
            if low == none:
                break
            i = of.index(low)
            parts[i] = low
            del parts[i + 1], of[i]
            last -= 1
            if i:
                of[i - 1] = rank_of((parts[i - 1], low), none)
            if i <= last:
                of[i] = rank_of((low, parts[i + 1]), none)
        return parts

    def _merged_long(self, parts: list[bytes]) -> list[int]:
        """The same with a heap of (rank, place), for windows that grew."""
        ranks, n = self.ranks, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, length = heapq.heappop(heap)
            j = after[i]
            # outdated if either part has changed since
            if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != length:
                continue
            parts[i] += parts[j]
            parts[j] = b""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := ranks.get(whole := parts[left] + parts[right])) is not None:
                    heapq.heappush(heap, (r, left, len(whole)))
        return [ranks[p] for p in parts if p]

    def pair(self, left: int, right: int) -> list[int]:
        """The encoding of two tokens' bytes."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merged(self.tokens[left] + self.tokens[right])
        return known

    def stable(self, left: int, right: int) -> bool:
        """Whether two neighbours are the encoding of their bytes."""
        return self.pair(left, right) == [left, right]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of both byte strings together."""
        middle, width = self.pair(left[-1], right[0]), 1
        while True:
            i, j = max(0, len(left) - width), min(width, len(right))
            if (not i or self.stable(left[i - 1], middle[0])) and (j == len(right) or self.stable(middle[-1], right[j])):
                return left[:i] + middle + right[j:]
            width *= 2
            middle = self.merged(b"".join([self.tokens[t] for t in left[-width:] + right[:width]]))

    def tree(self, piece: bytes) -> list[int]:
        if len(piece) <= self.leaf:
            return self.merged(piece)
        half = len(piece) // 2
        return self.join(self.tree(piece[:half]), self.tree(piece[half:]))

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return self.tree(piece) if whole is None else [whole]

    def pieces(self, text: str) -> list[str]:
        if self.plain is not None and PLAIN.fullmatch(text):
            return self.plain.findall(text)
        return self.pattern.findall(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        return b"".join(map(self.seen.__getitem__, self.pieces(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def pack(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class _Seen(dict):
    """Packed ids of pieces met before; long pieces are not kept."""

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        ids = pack(self.codec.encode_piece(piece.encode()))
        if len(piece) <= REMEMBERED_BYTES:
            self[piece] = ids
        return ids


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One per worker process and file."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec.from_file(path, pattern)
    return _CODECS[path, pattern]


def encoded(text: str | Column, path: str, pattern: str) -> Column:
    """Ids of a text as one binary value, four bytes each."""

    @F.arrow_udf("binary")
    def ids(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern)
        for texts in parts:
            yield pa.array((own.encode(t) for t in texts.to_pylist()), pa.binary(), size=len(texts))

    return ids(text_of(text))


def decoded(ids: str | Column, path: str, pattern: str) -> Column:
    """Bytes of a binary value of ids."""

    @F.arrow_udf("binary")
    def texts(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern)
        for packed in parts:
            yield pa.array((own.decode(x or b"") for x in packed.to_pylist()), pa.binary(), size=len(packed))

    return texts(F.col(ids) if isinstance(ids, str) else ids)


def round_trip(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document its ids (binary), their number, and the bytes they decode to."""
    ids = documents.select("doc_id", encoded("text", path, pattern).alias("ids"))
    return ids.select(
        "doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), decoded("ids", path, pattern).alias("decoded")
    )


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    return round_trip(documents, path, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
