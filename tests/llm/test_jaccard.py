"""The Jaccard join, components and n-gram hashes against brute force."""

import random

import numpy as np

from pricelens.llm import jaccard, shingles
from pricelens.llm.components import components
from tests.llm.test_texts import docs


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_ngram_hashes_follow_the_words():
    words = ["a", "bb", "é", "x" * 5000, "a", "bb"]
    h = shingles.word_hashes(words)
    assert h[0] == h[4] and h[1] == h[5] and len(set(h.tolist())) == 4
    assert len(shingles.ngram_hashes(h, 2)) == 5 and shingles.ngram_hashes(h, 2)[0] == shingles.ngram_hashes(h, 2)[4]
    assert len(shingles.ngram_hashes(h[:2], 5)) == 1 and len(shingles.ngram_hashes(np.zeros(0, np.uint64), 5)) == 0


def test_band_plan_reaches_its_recall():
    b, r = jaccard.band_plan()
    assert b * r <= jaccard.MAX_HASHES and 1 - (1 - 0.8**r) ** b >= jaccard.RECALL


def brute(texts, ids):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = {i: i for i in ids if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = {i: set() for i in root}
    for a, (i, s) in enumerate(zip(ids, sets, strict=True)):
        for j, t in list(zip(ids, sets, strict=True))[:a]:
            if i is not None and j is not None and s and t and len(s & t) / len(s | t) >= 0.8:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
                if s != t:
                    links[i].add(frozenset(t))
                    links[j].add(frozenset(s))
    return {i: (find(i), len(links[i])) for i in root}


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    texts = []
    for _ in range(14):
        base = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(1, 9)):
            x = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                x[rng.randrange(len(x))] = rng.choice(words)
            texts.append(" ".join(x))
    return texts + [None, "", "  ", "two words", "Two  WORDS", "one"]


def check(spark, texts, ids):
    df = docs(spark, texts, ids=ids).withColumnRenamed("lang", "class_id").withColumnRenamed("source", "node")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(df).collect()}
    want = brute(texts, ids)
    assert got == want
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(i for i, (c, _) in want.items() if c == i)


def test_join_equals_brute_force(spark):
    texts = corpus(2)
    check(spark, texts, list(range(len(texts))))


def test_join_in_small_blocks_with_null_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", 3)
    texts = corpus(3)
    ids = list(range(len(texts)))
    ids[4], ids[11] = None, None
    check(spark, texts + texts[:9], ids + ids[:9])


def test_unrelated_texts_of_one_id_stay(spark):
    rng = random.Random(5)
    a, b, c = (" ".join(f"{k}{rng.randrange(900)}" for _ in range(60)) for k in "abc")
    texts = [a, b, b.upper(), c, c + " more", a, None, "", "one", None]
    ids = [7, 7, 7, 9, 3, 4, 5, 5, None, None]
    df = docs(spark, texts, ids=ids)
    left = sorted(((r["doc_id"], r["text"]) for r in jaccard.keep_one(df).collect()), key=str)
    assert left == sorted([(4, a), (7, min(b, b.upper())), (3, c + " more"), (5, None), (5, ""), (None, "one"), (None, None)], key=str)
    got = {r["doc_id"]: r["class_id"] for r in jaccard.near_duplicates(df).collect()}
    assert got == {7: 4, 4: 4, 9: 3, 3: 3, 5: 5}


def test_a_chain_of_weak_candidates_and_a_long_text(spark):
    """Neighbours share a third of their words, so their bands often meet, yet none is linked."""
    rng = random.Random(8)
    words = [[f"w{rng.randrange(10**6)}" for _ in range(40)] for _ in range(60)]
    texts = [" ".join(words[i] + words[i + 1] + words[i + 2]) for i in range(58)] + [" ".join(f"v{i}" for i in range(40_000))] * 2
    got = [r for r in jaccard.near_duplicates(docs(spark, texts)).collect()]
    assert {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in got} == {i: (min(i, 58), 0, int(i > 57)) for i in range(60)}


def test_join_of_nothing(spark):
    assert jaccard.near_duplicates(docs(spark, [])).count() == 0 and jaccard.keep_one(docs(spark, [])).count() == 0


def test_bands_are_shuffled_once(spark, monkeypatch):
    plans = []
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    keep = jaccard.stash
    monkeypatch.setattr(jaccard, "stash", lambda df, what: (plans.append(plan(df)), keep(df, what))[1])
    rows = [(b"a", [1, 2, 3]), (b"b", [1, 2, 4]), (b"c", [3, 5, 6]), (b"d", [7, 8, 9])]
    out = jaccard.buckets(spark.createDataFrame(rows, "digest binary, bands array<bigint>"))
    plans.append(plan(out))
    assert sum(p.count("Generate explode(bands") for p in plans) == 1
    got = sorted((r["band"], bytes(r["digest"]), r["n"]) for r in out.collect())
    assert got == [(1, b"a", 2), (1, b"b", 2), (3, b"a", 2), (3, b"c", 2)]


def test_texts_travel_packed():
    rng = random.Random(4)
    texts = ["", "É \ud800 x", *(" ".join(f"w{rng.randrange(4000)}" for _ in range(n)) for n in (1, 300, 20_000))]
    assert [jaccard.unpack(*jaccard.pack(t)) for t in texts] == texts
    assert all(3 * len(jaccard.pack(t)[1]) < jaccard.grams_of(t).nbytes for t in texts[3:])
