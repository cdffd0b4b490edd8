"""Periodic runs, mixing and ranked search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from cartwheel.llm import mixing, nra_search, oracle, periodic_runs, queries
from cartwheel.llm.common import prepare
from tests.conftest import DATA

SF = DATA / "sf0.001"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- periodic runs -----------------------------------------------------------------------------------------


def brute_runs(w, least=12):
    """Every period, shortest first: stretches that keep it and have no shorter one."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            long_enough = j > i and length >= max(least, 2 * q)
            if long_enough and not any(all(w[x] == w[x + p] for x in range(i, j + q - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = max(i + 1, j)
    return sorted(out)


def brute_periodic(doc_id, text):
    w = split(text)
    n, h = len(w), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc_id,
        len(found),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest(),
    )


def test_runs_of_random_words():
    random.seed(3)
    for _ in range(1500):
        k, n = random.choice([1, 2, 2, 3, 6]), random.randint(0, 60)
        w = [random.randrange(k) for _ in range(n)]
        if n > 10 and random.random() < 0.5:
            p, a = random.randint(1, n // 2), random.randrange(n // 2)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        for least in (12, 5):
            assert periodic_runs.runs(np.array(w, np.int64), least) == brute_runs(w, least)


def test_long_runs():
    n = 200_000
    assert periodic_runs.runs(np.zeros(n, np.int64)) == [(0, n, 1)]
    assert periodic_runs.runs(np.arange(n, dtype=np.int64) % 777) == [(0, n, 777)]
    assert periodic_runs.runs(np.arange(n, dtype=np.int64)) == []


def test_periodic_runs(spark):
    random.seed(4)
    texts = [None, "", " \n\t\v", "one", "a " * 11, "a " * 12, "é b c " * 6, "x y z " * 200 + "end", "Zeile " * 3 + "\n" + "p q " * 20 + "p", "　   " * 9]
    rows = [(i, t) for i, t in enumerate(texts)]
    for i in range(10, 400):  # a tenth of these becomes periodic
        rows.append((i, " ".join(random.choices("abcdefgh"[: random.choice([1, 2, 8])], k=random.randint(0, 90)))))
    rows += [rows[7], rows[7], (None, "k " * 30), (None, None), (-5, "q r " * 40)]
    docs = prepare(spark).createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, period int")
    got = [tuple(r) for r in periodic_runs.digests(docs).collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted((brute_periodic(*r) for r in rows), key=key)
    assert sum(r[1] > 0 for r in got) > 40
    assert periodic_runs.digests(docs.limit(0)).count() == 0
    found = docs.where("doc_id = 7").limit(1).select(periodic_runs.periodic_runs("text").alias("f")).first().f
    assert found.runs[0][:] == (0, 600, 3) and found.collapsed == "x y z end"


def test_periodic_runs_of_documents(spark):
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in queries.op12_periodic_runs(spark, str(SF)).collect()}
    assert got == {brute_periodic(*r) for r in docs if len(split(r.text)) < 800} | {r for r in got if len(split(dict(docs)[r[0]])) >= 800}


# --- mixing ------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights, most=3):
    full = set()
    while True:
        rest = sum(sizes) - sum(most * sizes[i] for i in full)
        left = sum(w for i, w in enumerate(weights) if i not in full)
        out = [most * s if i in full else rest * w / left if left else 0 for i, (s, w) in enumerate(zip(sizes, weights))]
        over = {i for i, t in enumerate(out) if i not in full and t > most * sizes[i]}
        if not over:
            return out
        full |= over


def test_targets_and_quotas():
    random.seed(5)
    for _ in range(500):
        sizes = [random.choice([0, 1, 7, 100, 10**6]) * random.randint(0, 9) for _ in range(random.randint(1, 9))]
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        assert np.allclose(mixing.targets(sizes, weights), brute_targets(sizes, weights))
    for _ in range(3000):
        size, block = random.randint(1, 200), random.randint(1, 40)
        quota, blocks = random.randint(0, 3 * size), -(-size // block)
        factor, shift = mixing.permutation(blocks, random.randint(0, 9))
        order = [(factor * k + shift) % blocks for k in range(blocks)]
        assert sorted(order) == list(range(blocks))
        draws, last = mixing.drawn(size, quota, block, factor, shift)
        length = lambda b: min(block, size - b * block)
        assert sum(length(order[g % blocks]) for g in range(draws - 1)) + last == quota
        assert not draws or 0 < last <= length(order[(draws - 1) % blocks])


def mixed_rows():
    random.seed(6)
    rows = [(i, f"w{i} " * random.choice([0, 1, 3, 20, 300]), random.choice(["b", "ä", "a", "Z", "𝄞", None])) for i in range(300)]
    rows += [(1000, "one very long text " * 5000, "a"), (1001, None, "a"), (1002, "", "only empty"), (None, "no id", "b"), (None, None, None)]
    return rows + [(7, "same row", "Z")] * 40 + [(2000, "w", None)]


@pytest.mark.parametrize("block", [512, 5])
def test_mixture(spark, block):
    rows = mixed_rows()
    docs = prepare(spark).createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, source string, size int, shard string, taken int")
    mix = mixing.Mixture(docs, block=block, shard_blocks=20)
    got = mix.taken().collect()
    key = lambda r: str(tuple(r))
    assert sorted(((r.doc_id, r["size"]) for r in got), key=key) == sorted(((i, len(split(t))) for i, t, _ in rows), key=key)
    names = sorted({s for _, _, s in rows if s is not None}) + [None]
    sizes = [sum(len(split(t)) for _, t, s in rows if s == n) for n in names]
    want = brute_targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])
    assert {(r.source_size, round(r.target, 6)) for r in got} == {(s, round(t, 6)) for s, t in zip(sizes, want)}
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    assert sorted(map(key, got)) == sorted(map(key, mixing.Mixture(docs.repartition(3), block=block, shard_blocks=20).taken().collect()))

    pieces = mix.shuffled().collect()
    by_source, used, shards = Counter(), defaultdict(list), defaultdict(list)
    for p in pieces:
        by_source[p.source] += p.n_words
        used[p.doc_id, p.source, p.digest, p.copy, p.turn].append((p.first_word, p.n_words))
        shards[p.shard].append((p.slot, p.number, p.block, p.turn))
        assert 0 <= p.first_word and p.first_word + p.n_words <= p["size"]
    for name, target in zip(names, want):
        assert abs(by_source[name] - target) <= 0.5
    for spans in used.values():  # a pass takes no word twice
        spans.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert len(shards) == mix.shards > 1
    sizes = []
    for slots in shards.values():
        assert sorted(s for s, *_ in slots) == list(range(len(slots)))
        sizes.append(len({tuple(x[1:]) for x in slots}))
    assert max(sizes) - min(sizes) <= 1

    texts = mix.texts(docs).collect()
    assert len(texts) == len(pieces)
    whole = {(i, s, len(split(t))): split(t) for i, t, s in rows}
    digests = {(p.shard, p.slot): p["size"] for p in pieces}
    for r in texts:
        assert split(r.text) == whole[r.doc_id, r.source, digests[r.shard, r.slot]][r.first_word : r.first_word + r.n_words]


def test_splitting_tree_is_hypergeometric():
    """Halves are as even draws would be: means and variances of the marginals."""
    counts = np.array([600, 300, 100])
    lefts = np.array([mixing.split(0, 2, counts, lambda s: s * 500, seed) for seed in range(4000)])
    assert (lefts.sum(1) == 500).all()
    share = counts / 1000
    assert np.allclose(lefts.mean(0), 500 * share, atol=1)
    assert np.allclose(lefts.var(0), 500 * share * (1 - share) * 500 / 999, rtol=0.12)


def test_mixing_without_words(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.Mixture(prepare(spark).createDataFrame([], schema)).taken().count() == 0
    got = mixing.Mixture(spark.createDataFrame([(1, " ", "a"), (2, None, None)], schema)).taken().collect()
    assert sorted((r.doc_id, r["size"], r.source_size, r.target, r.taken, r.shards) for r in got) == [(1, 0, 0, 0.0, 0, []), (2, 0, 0, 0.0, 0, [])]


def test_mixing_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()
    got = {r.doc_id: r for r in queries.op11_mixing(spark, str(SF)).collect()}
    names = sorted({r.source for r in docs})
    sizes = [sum(len(split(r.text)) for r in docs if r.source == n) for n in names]
    want = dict(zip(names, brute_targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])))
    taken = Counter()
    for r in docs:
        assert got[r.doc_id]["size"] == len(split(r.text)) and math.isclose(got[r.doc_id].target, want[r.source])
        taken[r.source] += got[r.doc_id].taken
    assert all(abs(taken[n] - want[n]) <= 0.5 for n in names)


# --- ranked search -----------------------------------------------------------------------------------------


def lexical(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute_search(docs, items, best=10):
    bags = [(i, Counter(lexical(t))) for i, t in docs]
    held, words = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for number, (doc, bag) in enumerate(bags):
            score, n = 0, sum(bag.values())
            for term in lexical(text):
                if bag[term]:
                    w = math.floor(1000 * math.log((2 * held + 2) / (2 * df[term] + 1)))
                    score += w * (10**9 * bag[term] // (1000 * bag[term] + 8 * (25 + 75 * n * held // words)))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc, number))
        for rank, (score, _, _, doc, _) in enumerate(sorted(scored)[:best], 1):
            out.append((item, rank, doc, -score))
    return out


def found_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("tiers", [(0.05, 0.3, 0.6)])
def test_search(spark, tiers):
    random.seed(7)
    vocabulary = [f"T{i}" for i in range(60)] + ["É", "ß9", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(random.choices(vocabulary, weights, k=random.choice([0, 1, 3, 10, 60, 400])))) for i in range(300)]
    docs += [(None, "T1 T2"), (None, "T1 T2"), (500, None), (501, ""), (502, "-.-"), (17, "T1, t2!"), (17, "t1 T2"), (503, "rare" * 3000 + " T1")]
    docs += [(600 + i, "copy of T5_T6 T7") for i in range(60)]
    items = [(i, " ".join(random.choices(vocabulary, k=random.choice([1, 2, 9, 40])))) for i in range(12)]
    items += [(50, None), (51, "unknown"), (52, "t5 T6 t7"), (52, "T5 t6 T7 T7"), (None, "É ß9 ß9"), (53, "T0")]
    spark = prepare(spark)
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, rank int, t int")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    index = nra_search.Index(d, b, tiers)
    assert found_rows(nra_search.search(index)) == sorted(brute_search(docs, items), key=str)


def test_search_of_nothing(spark):
    spark = prepare(spark)
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "doc_id long, text string")
    item = spark.createDataFrame([(1, "b")], "item_id long, text string")
    for docs, items in ((none, item), (some, item), (some, item.limit(0))):
        got = nra_search.top_documents(docs, items)
        assert got.collect() == [] and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_search_of_documents(spark):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    got = found_rows(queries.op13_nra_search(spark, str(SF)))
    assert got == sorted(db.execute(oracle.ORACLE["op13_nra_search"]).fetchall(), key=str)
    tables = [spark.read.parquet(f"{SF}/{t}.parquet").collect() for t in ("documents", "benchmark")]
    assert got == sorted(brute_search([(r.doc_id, r.text) for r in tables[0]], [(r.item_id, r.text) for r in tables[1]]), key=str)
