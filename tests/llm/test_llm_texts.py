"""Operators on texts against brute force: toxicity, decontamination, language model, fingerprints."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from cartwheel.llm import decontamination, fingerprints, ngram_lm, toxicity
from cartwheel.llm.common import prepare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- decontamination ---------------------------------------------------------------------------------------


def brute_matches(text, items, size):
    words = WORD.findall(lower(text))
    hit, ids = set(), set()
    for item, content in items:
        own = WORD.findall(lower(content))
        for i in range(max(1, len(own) - size + 1) if own else 0):
            window = own[i : i + size]
            for j in range(len(words) - len(window) + 1):
                if words[j : j + len(window)] == window:
                    hit |= set(range(j, j + len(window)))
                    ids |= {str(item)} - {"None"}
    return len(words), len(hit), sorted(ids)


def benchmark_case():
    random.seed(4)
    vocabulary = ["Aa", "b", "cc", "é", "x1", "Y"]
    items = [(i, " ".join(random.choices(vocabulary, k=random.choice([1, 3, 13, 20])))) for i in range(12)]
    items += [(10, items[10][1]), (None, "b cc b cc b"), (77, "..."), (78, None), (79, "")]
    texts = [", ".join(random.choices(vocabulary, k=random.choice([0, 2, 20, 80]))) for _ in range(40)]
    texts += [None, "", " -- ", "À" * 50, f"pre {items[3][1].upper()} post", texts[5]]
    return items, [(i, t, "en", 0) for i, t in enumerate(texts)] + [(None, "b", "en", 0)]


@pytest.mark.parametrize("per_automaton", [1 << 24, 40])
def test_decontamination(spark, monkeypatch, per_automaton):
    monkeypatch.setattr(decontamination, "AUTOMATON_BYTES", per_automaton)
    items, rows = benchmark_case()
    prepare(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string, hits int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontamination(docs, bench).collect()
    assert len(got) == len(rows)
    want = {i: brute_matches(t, items, 13) for i, t, _, _ in rows}
    for r in got:
        n, hit, ids = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(ids))
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
        text = next(t for i, t, _, _ in rows if i == r.doc_id) or ""
        assert sum(len(WORD.findall(lower(text[s.start : s.end]))) for s in r.spans) == hit
    clean = decontamination.clean(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not r.contaminated for r in got)
    assert decontamination.decontamination(docs.limit(0), bench).collect() == []
    assert not any(r.n_hit for r in decontamination.decontamination(docs, bench.limit(0)).collect())


# --- toxicity ----------------------------------------------------------------------------------------------


def toxic_case(spark):
    random.seed(6)
    syllables = ["tha", "on", "re", "ing", "ble", "an", "sh", "ou", "er", "ti"]
    vocabulary = ["".join(random.choices(syllables, k=random.randint(1, 4))) for _ in range(3000)]
    bad = ["grubbox", "fizmonk", "dwarple", "quazzit"]
    rows, labels = [], []
    for i in range(900):
        words = random.choices(vocabulary, k=random.choice([5, 40, 200, 3000] if i % 50 == 0 else [5, 40, 200]))
        if i % 4 == 0:
            for _ in range(random.randint(1, 3)):
                words.insert(random.randrange(len(words)), random.choice(bad))
        rows.append((i, " ".join(words), 1.0))
        labels.append((i, int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, toxic int")


def learnt(toxic_stretches, quoted=0):
    """Texts of one vocabulary; each toxic one holds a stretch, and so do ``quoted`` of a hundred ordinary ones. Marked of both."""
    rng = random.Random(5)
    vocabulary = [f"w{rng.randrange(10**6):x}" for _ in range(800)]
    stretches = toxic_stretches(rng, vocabulary)

    def text(stretch=None):
        every = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 120))]
        if stretch:
            every.insert(rng.randrange(len(every)), stretch)
        return " ".join(every)

    ordinary = [text(rng.choice(stretches) if i % 100 < quoted else None) for i in range(1200)]
    model = toxicity.learn([text(rng.choice(stretches)) for _ in range(1200)], ordinary, 9.0)
    gauge = toxicity.Gauge(model.ordinary, model.toxic)
    marked = lambda texts: sum(model.score(gauge.value(t)[0]) >= 0.7 for t in texts)
    return marked(text(rng.choice(stretches)) for _ in range(200)), marked(text() for _ in range(200))


def test_toxic_phrases_of_ordinary_words():
    found, wrong = learnt(lambda rng, words: [" ".join(rng.sample(words, 3)) for _ in range(5)])
    assert found >= 195 and wrong <= 2


def test_toxic_words_that_ordinary_samples_quote():
    found, wrong = learnt(lambda rng, words: ["sludgeface", "grimtoad", "vilebert"], quoted=1)
    assert found >= 195 and wrong <= 2


def test_toxic_words_beyond_the_trained_dictionary():
    """Thirty words without common parts, one in each toxic text: what training leaves out is added.

    With sixty, the rarest are in too few of the 800 texts learnt from to be told from chance.
    """
    found, wrong = learnt(lambda rng, words: [f"q{rng.randrange(10**7):x}z" for _ in range(30)])
    assert found >= 190 and wrong <= 2


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_case(prepare(spark))
    odd = spark.createDataFrame([(2000, None, 0.0), (2001, "", 0.0), (None, "grubbox", 0.0), (0, "again", 0.0)], docs.schema)
    rows = toxicity.toxicity(docs.unionByName(odd), labels.unionByName(spark.createDataFrame([(None, 1), (5, None)], labels.schema))).collect()
    assert len(rows) == 904
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert len(held) > 200
    right = sum((r.predicted == 1) == (r.doc_id % 4 == 0) for r in held)
    assert right / len(held) > 0.97
    assert not any(r.predicted for r in held if r.doc_id % 4)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[2000].score == by[2001].score < 0.7 and by[None].predicted == 1 and not by[None].held_out
    kept = toxicity.acceptable(docs.unionByName(odd), labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted} | {0}


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = toxic_case(prepare(spark))
    model = toxicity.fit(docs, labels)
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    assert toxicity.fit(docs, flipped) == model


def test_nothing_to_learn(spark):
    docs, labels = toxic_case(prepare(spark))
    rows = toxicity.toxicity(docs.limit(5), labels.where("toxic = 1")).collect()
    assert len({r.score for r in rows}) == 1 and not any(r.predicted for r in rows)
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


# --- language model ----------------------------------------------------------------------------------------


def brute_scores(rows):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) for _, t in rows]
    single = Counter(w for d in tokens for w in d)
    pairs = Counter(p for d in tokens for p in zip([None, *d], d))
    single[None] = sum(1 for d in tokens if d)
    every = sum(map(len, tokens))
    value = lambda a, b: math.log(pairs[a, b] / single[a]) if pairs[a, b] >= 2 else math.log(0.4 * single[b] / every)
    return [(i, len(d), sum(value(a, b) for a, b in zip([None, *d], d))) for (i, _), d in zip(rows, tokens)]


def test_language_model(spark, monkeypatch):
    random.seed(9)
    monkeypatch.setattr(ngram_lm, "HEAVY", 1 / 50)
    monkeypatch.setattr(ngram_lm, "GROUP_PAIRS", 200)
    monkeypatch.setattr(ngram_lm, "BLOCK_WORDS", 500)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(300):
        words = []
        while len(words) < random.randint(1, 60):
            words += ["The", "of"] if random.random() < 0.2 else [random.choice(vocabulary[: random.choice([5, 300])])]
        rows.append((i, " ".join(words)))
    rows += [(7, rows[7][1]), (400, None), (401, ""), (402, " \n"), (None, "the of"), (403, "only once here")]
    docs = prepare(spark).createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, score double")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, round(r.score, 6)) for r in ngram_lm.scores(docs).collect())
    assert got == sorted((-1 if i is None else i, n, round(s, 6)) for i, n, s in brute_scores(rows))
    means = {r.doc_id: r.mean_score for r in ngram_lm.scores(docs).collect()}
    assert means[400] is None and means[403] < 0
    assert ngram_lm.scores(docs.limit(0)).collect() == []


# --- fingerprints ------------------------------------------------------------------------------------------


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark, monkeypatch):
    random.seed(8)
    monkeypatch.setattr(fingerprints, "BLOCK", 7)
    monkeypatch.setattr(fingerprints, "SUPER", 3)
    vocabulary = [f"wörd{i}" for i in range(500)]
    rows = [(i * 3, " ".join(random.choices(vocabulary, k=random.choice([1, 4, 30, 400])))) for i in range(120)]
    rows[10], rows[20] = (30, rows[11][1]), (60, None)
    rows += [(1000, ""), (1001, " "), (1002, "tail 𝄞𝄞𝄞𝄞")]
    docs = prepare(spark).createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string")
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    assert len(got) == len(rows)
    errors = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        errors += [r.near_edited - jaccard(shingles(text), shingles(edited)), r.near_next - jaccard(shingles(text), shingles(after))]
        assert max(map(abs, errors[-2:])) < 0.35, (text, edited, after, r)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert abs(sum(errors) / len(errors)) < 0.02 and max(map(abs, errors)) < 0.35
    assert got[30].fingerprint == got[33].fingerprint != got[36].fingerprint
    assert got[30].near_next == 1.0 and got[60].fingerprint == got[1000].fingerprint == got[1001].fingerprint == ""
    assert fingerprints.fingerprints(docs.limit(0)).collect() == []
    alone = fingerprints.fingerprints(docs.where("doc_id = 0")).first()
    assert alone.near_next == 1.0


def test_null_and_repeated_ids_keep_their_rows(spark):
    docs = prepare(spark).createDataFrame([(None, "a b c d e f"), (None, "x"), (5, "p q"), (5, "p q"), (5, "r")], "doc_id long, text string")
    assert fingerprints.fingerprints(docs).count() == 5


def test_fingerprints_stay_in_the_jvm(spark):
    docs = prepare(spark).createDataFrame([(1, "a")], "doc_id long, text string")
    plan = fingerprints.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_an_automaton_at_its_limit():
    """Varied text of a quarter of the limit takes less than a quarter of 0.6 GB."""
    rng = random.Random(12)
    items, size = [], 0
    while size < decontamination.AUTOMATON_BYTES // 4:
        text = " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(60))
        items.append((str(len(items)), text))
        size += len(text)
    assert decontamination.automaton(items).get_stats()["total_size"] < 150e6
