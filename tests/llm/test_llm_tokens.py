"""Byte-level BPE and packing against the public encoder and exact round trips."""

import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm import byte_bpe, packing
from cartwheel.llm.common import prepare

PATH = P.path("byte_bpe_50k.tiktoken")
THEIRS = packing.encoding(PATH, P.PATTERN)
OURS = byte_bpe.Codec.from_file(PATH, P.PATTERN)
# tiny leaves: nearly all work is joining
JOINING = byte_bpe.Codec(OURS.ranks, P.PATTERN, leaf=2)


def theirs(text):
    return np.asarray(THEIRS.encode_ordinary(text), "<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    for own in (OURS, JOINING):
        assert own.encode(text) == theirs(text)
    assert OURS.decode(theirs(text)) == text.encode()


@pytest.mark.parametrize("alphabet", ["ab", "aehtinsr", "éüßñ漢字", "=-_", "0123456789", "a\x1c\x85 \n\t²½'s"])
def test_random_runs(alphabet):
    random.seed(3)
    for _ in range(150):
        text = "".join(random.choices(alphabet, k=random.randint(0, 300)))
        assert OURS.encode(text) == JOINING.encode(text) == theirs(text)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "=" * 7001, " " * 3000, "<|endoftext|>", "\n\n x"])
def test_long_and_special(text):
    assert OURS.encode(text) == theirs(text)


def test_join_of_any_split():
    random.seed(1)
    for _ in range(200):
        piece = "".join(random.choices("thinsoagre", k=random.randint(2, 60))).encode()
        cut = random.randrange(1, len(piece))
        assert OURS.join(OURS.tree(piece[:cut]), OURS.tree(piece[cut:])) == OURS.merged(piece)


ROWS = [(1, "the cat and the dog", "x"), (2, None, "y"), (3, "", "z"), (3, "", "z"), (None, "naïve café " * 3000, "w"), (4, "a" * 9000, None)]
SCHEMA = "doc_id long, text string, ids string"


def test_round_trip(spark):
    docs = prepare(spark).createDataFrame(ROWS, SCHEMA)
    rows = byte_bpe.round_trip(docs, PATH, P.PATTERN).collect()
    assert len(rows) == len(ROWS)
    want = sorted((-1 if i is None else i, theirs(t or ""), (t or "").encode()) for i, t, _ in ROWS)
    assert sorted((-1 if r.doc_id is None else r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in rows) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in rows)
    assert byte_bpe.digests(docs.limit(0), PATH, P.PATTERN).collect() == []


def test_best_fit():
    random.seed(2)
    lengths = [random.randint(0, 100) for _ in range(500)]
    rows = packing.packed_rows(lengths, 100)
    assert sorted(p for r in rows for p in r) == list(range(500))
    assert all(sum(lengths[p] for p in r) <= 100 for r in rows)
    free = []
    for p in sorted(range(500), key=lambda i: -lengths[i]):
        fitting = [c for c in free if c >= lengths[p]]
        if fitting:
            free.remove(min(fitting))
        free.append((min(fitting) if fitting else 100) - lengths[p])
    assert sorted(free) == sorted(100 - sum(lengths[p] for p in r) for r in rows)


def test_packing_is_lossless(spark):
    docs = prepare(spark).createDataFrame(ROWS, SCHEMA)
    ids = docs.select("doc_id", packing.token_ids("text", PATH, P.PATTERN).alias("ids"))
    rows = packing.packed(ids, 50_256, 50_257, length=64, block_tokens=4000)
    for r in rows.collect():
        row = np.frombuffer(r.ids, "<u2")
        assert len(row) == 64 and r.cu_seqlens[-1] == r.n_tokens and (row[r.n_tokens :] == 50_256).all()
        assert r.cu_seqlens[:-1] == r.resets and len(r.doc_ids) == len(r.resets) == len(r.offsets) == len(r.numbers)
    back = [(-1 if r.doc_id is None else r.doc_id, np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) for r in packing.unpacked(rows).collect()]
    assert sorted(back) == sorted((-1 if i is None else i, theirs(t or "")) for i, t, _ in ROWS)
    assert packing.packed(ids.limit(0), 50_256, 50_257).collect() == []


def test_packing_survives_long_blanks(spark):
    """Texts of one long stretch, on which the fast tokenizer runs out of stack."""
    texts = [" " * 2_000_000, "a" + "\n" * 60_000 + "b", "^" * 2_000_000, "\t " * 500_000, "word " * 1000 + " " * 300_000]
    docs = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.packed(docs.select("doc_id", packing.token_ids("text", PATH, P.PATTERN).alias("ids")), 50_256, 50_257)
    back = {r.doc_id: np.frombuffer(r.ids, "<u2").tolist() for r in packing.unpacked(rows).collect()}
    for i, text in enumerate(texts):
        assert b"".join(THEIRS.decode_single_token_bytes(t) for t in back[i]).decode() == text
