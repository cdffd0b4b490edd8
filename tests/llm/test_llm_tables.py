"""Operators on tables against brute force: similarity groups, URL verdicts, WARC archives, shards, the pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartwheel.llm import decontamination, jaccard_join, oracle, queries, sharding, toxicity, url_filters, warc
from cartwheel.llm.common import components, prepare
from tests.conftest import DATA


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- Jaccard join ------------------------------------------------------------------------------------------


def brute_groups(rows, words=3, percent=90):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = defaultdict(list)
    for g, (i, _) in zip(group, rows):
        ids[g].append(i)
    return [(i, len(s), min((x for x in ids[g] if x is not None), default=None)) for (i, _), s, g in zip(rows, sets, group)]


def near_copies(seed):
    random.seed(seed)
    vocabulary = [f"W{i}" for i in range(400)]
    rows = [(900, None), (901, ""), (902, " \n\t"), (903, "One"), (904, "one"), (905, "One two"), (906, "one TWO"), (907, "one, two"), (908, "one two three four"), (None, "one two three four")]
    for _ in range(14):
        base = random.choices(vocabulary, k=random.choice([5, 9, 12, 30, 100, 300, 900]))
        for _ in range(random.choice([1, 2, 5, 45])):
            words = list(base)
            for _ in range(random.randint(0, max(1, len(words) // 25))):
                at = random.randrange(len(words))
                words[at : at + random.randint(0, 1)] = random.choices(vocabulary, k=random.randint(0, 1))
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [2000, 25])
def test_similar_groups(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = near_copies(block)
    docs = prepare(spark).createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, hash int")
    got = [tuple(r) for r in jaccard_join.similar_groups(docs).collect()]
    key = lambda r: (-1 if r[0] is None else r[0], r[1])
    assert sorted(got, key=key) == sorted(brute_groups(rows), key=key)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in got})


def test_one_of_each_tells_rows_apart(spark):
    """Repeated and null ids: only rows of a group go, and one of each group stays."""
    a, b, c, other = "one two three four five six", "seven eight nine ten eleven", "twelve thirteen fourteen fifteen", "ONE two three four five six"
    rows = [(1, a, 0), (5, a, 1), (5, b, 2), (None, a, 3), (None, c, 4), (None, None, 5), (None, "", 6), (8, " ", 7), (8, " ", 8)]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string, hash int")
    assert sorted(r["hash"] for r in jaccard_join.one_of_each(docs).collect()) == [0, 2, 4, 5, 6, 7, 8]
    rows = [(3, a, 0), (3, a, 1), (3, other, 2), (4, b, 3), (4, b, 4), (None, c, 5), (None, c, 6), (7, c + " sixteen", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash int")
    kept = jaccard_join.one_of_each(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text.lower()) for r in kept) == [(False, 3, a), (False, 4, b), (False, 7, c + " sixteen"), (True, None, c)]
    assert kept[0].__fields__ == docs.columns
    assert jaccard_join.one_of_each(docs.limit(0)).collect() == []


def test_one_of_each_at_other_values(spark):
    """Five words and a similarity of 0.8."""
    rows = near_copies(7)
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    kept = jaccard_join.one_of_each(docs, 5, Fraction(4, 5)).collect()
    numbered = brute_groups([(n, t) for n, (_, t) in enumerate(rows)], 5, 80)
    assert len(kept) == len({group for _, _, group in numbered})


def test_points_lose_no_link():
    """The bound is never below the overlap, and tells most unrelated sets apart."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        own = rng.integers(0, 2**63, rng.integers(1, 900), dtype=np.uint64)
        other = np.union1d(rng.choice(own, rng.integers(0, len(own) + 1), replace=False), rng.integers(0, 2**63, rng.integers(0, 300), dtype=np.uint64))
        a, b = np.unique(own), np.unique(other)
        bound = np.minimum(jaccard_join.count_vector(a), jaccard_join.count_vector(b)).sum()
        assert bound >= len(np.intersect1d(a, b))


def test_pipeline_on_repeated_and_null_ids(spark):
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet").limit(60)
    again = docs.where("doc_id % 3 = 0").withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType))
    shifted = docs.where("doc_id % 3 = 1").withColumn("doc_id", (F.col("doc_id") + 1).cast(docs.schema["doc_id"].dataType))
    every = docs.unionByName(again).unionByName(shifted).unionByName(docs.where("doc_id % 5 = 0"))
    kept = dict(corpus_pipeline.STAGES)["jaccard_join"](spark, every, str(SF)).collect()
    rows = [(r.doc_id, r.text) for r in every.collect()]
    numbered = brute_groups([(n, t) for n, (_, t) in enumerate(rows)])
    of_text = {rows[n][1]: group for n, _, group in numbered}
    assert sorted(of_text[r.text] for r in kept) == sorted({group for _, _, group in numbered})
    least = {}
    for n, _, group in numbered:
        least[group] = min(least.get(group, (True, 0)), (rows[n][0] is None, rows[n][0] or 0))
    assert all((r.doc_id is None, r.doc_id or 0) == least[of_text[r.text]] for r in kept)


def test_no_linked_pair_is_outside_a_tile():
    ends = jaccard_join.class_bounds(jaccard_join.THRESHOLD)
    random.seed(1)
    for _ in range(400):
        n = random.choice([9, 10, 20, 57, 300, 1200])
        a = {random.getrandbits(60) for _ in range(n)}
        b = set(a)
        for x in random.sample(sorted(a), random.randint(0, n // 15)):
            b.discard(x)
            if random.random() < 0.5:
                b.add(random.getrandbits(60))
        x, y = (jaccard_join.np.array(sorted(s), "u8") for s in (a, b))
        if jaccard_join.linked(x, y, jaccard_join.THRESHOLD):
            own, other = (set(jaccard_join.entries(s, ends, jaccard_join.THRESHOLD)["sig"].tolist()) for s in (x, y))
            assert own & other


def test_large_coordinates_lose_no_link():
    """All elements in one group: the coordinate is beyond 16 bits, as in sets of many million shingles."""
    np = jaccard_join.np
    a = np.arange(70_000, dtype="u8") * np.uint64(jaccard_join.GROUPS)
    found = list(jaccard_join.tree_links([a, a[:-1000]], np.array([1, 2]), None, jaccard_join.THRESHOLD))
    assert len(found) == 1


def test_empty_table_has_no_groups(spark):
    assert jaccard_join.similar_groups(prepare(spark).createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    random.seed(3)
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 140)] + [(5, 5)]
    got = dict(components(prepare(spark).createDataFrame(edges, "a long, b long")).collect())
    root = list(range(200))
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {i: r for i, r in enumerate(root) if r != i}


# --- URL filter --------------------------------------------------------------------------------------------

URLS = [
    ("HTTPS://A.Example.ORG/de/1?x#y", "a.example.org", "/de/1", "org/", "allow"),
    ("https://example.org/es/9", "example.org", "/es/9", "example.org/es/", "block"),
    ("https://b.example.org/en/12", "b.example.org", "/en/12", "example.org/en/1", "block"),
    ("http://x.com/fr/a.html", "x.com", "/fr/a.html", "com/fr/", "allow"),
    ("http://com/de/", "com", "/de/", "com/de/", "block"),
    ("http://xcom/de/", "xcom", "/de/", None, None),
    ("http://y.org", "y.org", "", None, None),
    ("http://y.org?q=/", "y.org", "", None, None),
    ("http://Ä.com#/de/", "Ä.com", "", None, None),
    ("://h/p://q", "h", "/p://q", None, None),
    ("no scheme/de/", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def test_rules(spark):
    pages = prepare(spark).createDataFrame([(i, u[0], "t") for i, u in enumerate(URLS)] + [(0, URLS[0][0], "t")], "page_id long, url string, template string")
    got = url_filters.verdicts(pages).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        _, host, path, rule, verdict = URLS[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert url_filters.verdicts(pages.limit(0)).collect() == []


def test_templates_learn_from_rules(spark):
    urls = [f"http://s.com/{'de' if i % 2 else 'fr'}/{i}.html" for i in range(200)] + [f"http://t.net/de/{i}.html" for i in range(40)] + [f"http://t.net/fr/{i}.html" for i in range(40)]
    pages = prepare(spark).createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filters.verdicts(pages).collect()
    assert {(r.template, r.verdict) for r in rows if r.host == "t.net"} == {("/de/{number}.html", "block"), ("/fr/{number}.html", "allow")}
    assert len({r.branch for r in rows if r.host == "s.com"}) == 2


def test_siblings_without_labels_do_not_join_branches(spark):
    """On s.com /fr/ is allowed, /de/ blocked, /en/ and /es/ have no label and lie between them."""
    urls = [f"http://s.com/{lang}/{i}.html" for lang, n in (("fr", 21), ("en", 9), ("es", 9), ("de", 29)) for i in range(n)]
    urls += [f"http://a.org/{lang}/{i}.html" for lang in ("en", "es") for i in range(30)]
    pages = prepare(spark).createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = [r for r in url_filters.verdicts(pages).collect() if r.host == "s.com"]
    by = {r.template.split("/")[1]: r for r in rows}
    assert len({r.branch for r in by.values()}) == 4 and len(rows) == 68
    assert {lang for lang, r in by.items() if r.verdict == "block"} == {"de"}
    # 29 of 29 blocked, smoothed with five labels of the same template elsewhere; nothing else is smoothed in
    assert by["de"].purity > 0.95 and by["fr"].purity < 0.1 and by["en"].purity < 0.3


def test_a_branch_ends_where_it_differs_from_all_before(spark):
    """Shares that rise in small steps: each neighbour is near, the ends are not."""
    rules = [("h", f"/s{k:02d}/{i}-", "block" if i < k else "allow") for k in range(0, 21, 2) for i in range(20)]
    urls = [f"http://h{r[1]}x.html" if r[0] == "h" else "" for r in rules]
    pages = prepare(spark).createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filters.verdicts(pages, rules=rules).collect()
    branch = {r.template.split("/")[1]: r.branch for r in rows}
    assert branch["s00"] == branch["s02"] == 0 and branch["s20"] >= 2


# --- WARC --------------------------------------------------------------------------------------------------


def archive(sizes=(0, 50, 3000, 70000, 10, 99, 400)):
    random.seed(5)
    payloads = [random.randbytes(n) for n in sizes]
    records = [warc.record(i, 0, "http://x", p, hashlib.sha256(p).hexdigest(), None, False) for i, p in enumerate(payloads)]
    return payloads, records


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage_after_damage(compressed):
    payloads, records = archive()
    if not compressed:
        records = [zlib.decompress(r, 31) for r in records]
    whole = b"".join(records)
    starts = [sum(map(len, records[:i])) for i in range(len(records) + 1)]
    assert [x.payload for x in warc.salvage(whole)] == payloads
    for bad in range(len(records)):
        for cut in (3, len(records[bad]) // 2, len(records[bad]) - 3):
            data = whole[: starts[bad] + 1] + b"##" + whole[starts[bad] + cut :]
            found = list(warc.salvage(data))
            assert [x.payload for x in found if not x.reason] == payloads[:bad] + payloads[bad + 1 :]
            assert found[0].start == 0 and found[-1].end == len(data)
            assert all(a.end == b.start for a, b in zip(found, found[1:]))
            assert sum(1 for x in found if x.reason) == 1
    cut = list(warc.salvage(whole[:-5]))
    assert len(cut) == len(records) and cut[-1].reason and not cut[-2].reason
    assert list(warc.salvage(b"")) == []


def test_archives_on_disk(spark, tmp_path):
    prepare(spark)
    payloads, records = archive()
    (tmp_path / "a.warc.gz").write_bytes(b"".join(records[:3]) + b"junk" + b"".join(records[3:]))
    (tmp_path / "b.warc.gz").write_bytes(records[0][:-2])
    found = warc.archives(spark, str(tmp_path))
    assert sorted(bytes(r.payload) for r in warc.read_records(found).collect()) == sorted(payloads)
    gaps = {(r.archive[-9:], r.end - r.start, r.reason) for r in warc.read_gaps(found).collect()}
    assert gaps == {("a.warc.gz", 4, "neither member nor version line"), ("b.warc.gz", len(records[0]) - 2, "member is cut off")}


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    html = [None, "", "é" * 49, "é" * 50, "é" * 50, "x" * 5000, "x" * 5000, "short", "short", "x" * 5000]
    rows = [(20 - i, "http://a b\r\nc" if i % 2 else None, h, "d") for i, h in enumerate(html)]
    pages = prepare(spark).createDataFrame(rows, "page_id long, url string, html string, digest string")
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert len(got) == len(rows)
    for page, _, h, _ in rows:
        data = (h or "").encode()
        first = min(p for p, _, x, _ in rows if x == h)
        again = len(data) >= 100 and first != page
        r = got[page]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", first) if again else ("response", None))
    assert warc.round_trip(pages.limit(0)).collect() == []
    assert warc.round_trip(spark.createDataFrame([(None, None, "x" * 200, ""), (None, None, "x" * 200, "")], pages.schema)).count() == 2


def test_member_of_several_records():
    payloads, records = archive()
    plain = [zlib.decompress(r, 31) for r in records]

    def member(raw):
        packer = zlib.compressobj(3, zlib.DEFLATED, 31)
        return packer.compress(raw) + packer.flush()

    found = list(warc.salvage(records[0] + member(b"".join(plain[1:4])) + records[4]))
    assert [x.payload for x in found] == payloads[:5] and not any(x.reason for x in found)
    assert found[1].start == found[3].start == found[0].end and found[1].end == found[3].end == found[4].start
    found = list(warc.salvage(member(plain[1] + b"junk" + plain[2]) + records[3]))
    assert [x.payload for x in found if not x.reason] == payloads[1:4] and sum(1 for x in found if x.reason) == 1


@pytest.mark.parametrize("compressed", [True, False])
def test_long_headers(compressed):
    url = "data:text/html," + "x" * 100_000
    records = [warc.record(i, 0, url, b"p", hashlib.sha256(b"p").hexdigest(), None, False) for i in range(2)]
    found = list(warc.salvage(b"".join(records if compressed else [zlib.decompress(r, 31) for r in records])))
    assert [x.headers.get("warc-target-uri") for x in found] == [url, url]


def test_round_trip_of_long_urls(spark, monkeypatch):
    rows = [(i, "http://h/" + "u" * 100_000, "x" * 200, "d") for i in range(3)]
    pages = prepare(spark).createDataFrame(rows, "page_id long, url string, html string, digest string")
    assert sorted((r.page_id, r.payload_bytes) for r in warc.round_trip(pages).collect()) == [(0, 200), (1, 200), (2, 200)]
    monkeypatch.setattr(warc, "archives", lambda spark, folder: spark.createDataFrame([], "path string, content binary"))
    with pytest.raises(ValueError, match="3 records were written, 0 are read"):
        warc.round_trip(pages)


# --- shards ------------------------------------------------------------------------------------------------


def test_shards(spark):
    random.seed(7)
    texts = ["".join(random.choices("abc é", k=random.randint(1, 400))) for _ in range(3000)]
    rows = [(i, texts[i % 2500], random.choice(["en", None]), "hot" if i % 3 else f"s{i % 7}", 0) for i in range(3000)]
    rows += [(3000, None, None, None, 0), (3001, "", None, None, 0), (5, "again", "en", "s1", 0), (5, "again", "en", "s1", 0), (None, "null", "en", "s1", 0)]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string, hash int")
    out = sharding.shards(docs, leaves=16).collect()
    assert len(out) == len(rows)
    text_of = {(len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in rows}
    assert {(r["size"], r.text_crc32) for r in out} == text_of
    groups, slots, volume = defaultdict(set), defaultdict(list), Counter()
    for r in out:
        groups[r["size"], r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
        volume[r.shard] += r["size"]
        assert r.law == "bytes" and r.grown_shard is None
    assert all(len(s) == 1 for s in groups.values())
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(volume.values()) < 1.05 * min(volume.values())
    assert sharding.shards(docs.limit(0), leaves=16).collect() == []
    assert {r.shard for r in sharding.shards(docs, target_bytes=200_000).collect()} == set(range(4))


def test_a_group_larger_than_a_leaf_stays_whole(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}", "en", "a") for i in range(300)]
    out = sharding.shards(prepare(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string"), leaves=8).collect()
    assert len(out) == 300 and len({r.shard for r in out if r.doc_id % 3 == 0}) == 1


def test_other_leaves_share_what_a_large_group_leaves(spark):
    rows = [(i, "x" * 99 if i % 3 == 0 else f"{i:099d}", "en", f"s{i % 5}") for i in range(3000)]
    out = sharding.shards(prepare(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string"), leaves=16).collect()
    counts = Counter(r.shard for r in out)
    assert sorted(counts) == list(range(16))
    *others, hot = sorted(counts.values())
    assert hot == 1000 and others[0] >= 125 and others[-1] <= 142
    # groups of a little less than a leaf: no leaf is empty
    rows = [(i, f"group {i % 20:02d}" if i % 2 else f"single {i}", "en", "a") for i in range(1600)]
    out = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), leaves=16).collect()
    assert len({r.shard for r in out}) == 16
    # as many points as leaves, of very different sizes
    rows = [(i, "y" * (i * i), "en", "a") for i in range(6)]
    out = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), leaves=6).collect()
    assert len({r.shard for r in out}) == 6


def test_shards_stay_in_the_jvm(spark):
    docs = prepare(spark).createDataFrame([(1, "a", "en", "s")], "doc_id long, text string, lang string, source string")
    assert not re.search("Python|Arrow|Pandas", sharding.shards(docs, leaves=2)._jdf.queryExecution().executedPlan().toString())


# --- whole queries -----------------------------------------------------------------------------------------

SF = DATA / "sf0.001"


@pytest.mark.parametrize("name", list(oracle.ORACLE))
def test_query_against_sql(spark, name):
    db = duckdb.connect()
    for path in SF.glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    theirs = db.execute(oracle.ORACLE[name])
    columns = [c[0] for c in theirs.description]
    got = queries.QUERIES[name](spark, str(SF))
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, theirs.fetchall()))


def test_pipeline(spark):
    """Each stage on what its predecessor kept, held against brute force on its own input."""
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    gauge = toxicity.Gauge(model.ordinary, model.toxic)
    want = [(r.doc_id, r.text) for r in docs.collect() if model.score(gauge.value(r.text)[0] if model.toxic else 0.0) < 0.7]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "jaccard_join", "decontamination", "byte_bpe"]

    kept = stages["toxicity"](spark, docs, str(SF))
    assert kept.columns == columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in want)
    want = [(i, t) for (i, t), (_, _, c) in zip(want, brute_groups(want)) if i == c]
    kept = stages["jaccard_join"](spark, kept, str(SF))
    assert kept.columns == columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in want)
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = decontamination.automaton(items)
    hits = {i: decontamination.scan(t, found, [], []) for i, t in want}
    want = sorted(i for i, (n, hit, _, _) in hits.items() if not (hit and 20 * len(hit) >= n))
    kept = stages["decontamination"](spark, kept, str(SF))
    assert kept.columns == columns and sorted(r.doc_id for r in kept.collect()) == want
    rows = corpus_pipeline.run(spark, str(SF)).collect()
    assert sorted(r.doc_id for r in rows) == want and all(r.n_tokens > 0 for r in rows)


# --- URL templates against a second tree -------------------------------------------------------------------


def brute_shape(segment):
    ending = re.search(r"(\.[A-Za-z]{1,5})$", segment)
    stem = segment[: ending.start()] if ending else segment
    kinds = (("{}", stem == ""), ("{number}", re.fullmatch(r"[0-9]+", stem)), ("{hex}", re.fullmatch(r"[0-9a-fA-F-]{8,}", stem)), ("{word}", re.fullmatch(r"[^\W\d]+|[^\W\d_-]*[_-][\w-]*", stem) and not re.search(r"\d", stem)))
    return next((k for k, found in kinds if found), "{other}") + (ending.group() if ending else "")


def brute_templates(urls):
    """Level by level over lists: a template for each (host, path)."""
    rows = [(h, (p[1:] if p.startswith("/") else p).split("/")) for h, p in urls]
    templates = [""] * len(rows)
    for level in range(max(len(s) for _, s in rows)):
        below = [i for i, (_, s) in enumerate(rows) if len(s) > level]
        all_ = Counter((rows[i][0], templates[i]) for i in below)
        own = Counter((rows[i][0], templates[i], rows[i][1][level]) for i in below)
        named = {}
        for i in below:
            host, segment = rows[i][0], rows[i][1][level]
            n = own[host, templates[i], segment]
            literal = n >= 8 and n >= 0.02 * all_[host, templates[i]] and not re.fullmatch("[0-9]+", segment)
            named[i] = templates[i] + "/" + (segment if literal else brute_shape(segment))
        for i, t in named.items():
            templates[i] = t
    return templates


def test_templates_of_any_depth(spark):
    rng = random.Random(13)
    hosts, words = ["a.com", "b.net", ""], ["de", "fr", "en", "x1", "12", "ab12cd34ef", "page.html", "", "lang-x"]
    urls = [(rng.choice(hosts), "/" + "/".join(rng.choices(words, [9, 9, 5, 1, 3, 1, 2, 1, 1], k=rng.choice([0, 1, 3, 6, 9])))) for _ in range(1500)]
    urls += [("c.org", f"/a/b/c/d/{lang}/{i}") for lang in ("de", "fr") for i in range(20)] + [("d.org", ""), ("d.org", "/" + "z/" * 60)]
    rows = prepare(spark).createDataFrame(urls, "host string, path string")
    got = Counter((r.host, r.path, r.template) for r in url_filters.with_templates(rows).collect())
    assert got == Counter((h, p, t) for (h, p), t in zip(urls, brute_templates(urls)))
    assert {t for (h, _, t) in got if h == "c.org"} == {"/a/b/c/d/de/{number}", "/a/b/c/d/fr/{number}"}
