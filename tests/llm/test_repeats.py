"""Shared passages against brute force."""

import random

from pricelens.llm import repeats
from tests.llm.test_texts import docs


def brute(texts, ids):
    """Positions of each id whose fifty-word windows another id has too."""
    n = repeats.MIN_WORDS
    where = {}
    for i, t in zip(ids, texts, strict=True):
        w = (t or "").lower().split()
        for p in range(len(w) - n + 1):
            where.setdefault(tuple(w[p : p + n]), set()).add((i, p))
    out = {}
    for spots in where.values():
        if len({i for i, _ in spots if i is not None}) > 1:
            for i, p in spots:
                if i is not None:
                    out.setdefault(i, set()).update(range(p, p + n))
    return out


def test_passages_equal_brute_force(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(3000)]
    prose = lambda n: [rng.choice(vocab) for _ in range(n)]
    shared = [prose(n) for n in (49, 50, 51, 60, 75, 120, 400)]
    texts = []
    for p in shared:
        for _ in range(rng.choice([2, 3, 12])):
            texts.append(" ".join(prose(rng.randint(0, 90)) + p + prose(rng.randint(0, 90))))
    whole = prose(300)
    texts += [" ".join(whole)] * 3 + [" ".join(whole[:120] + prose(1) + whole[121:])]
    own = prose(60)
    texts += [" ".join(own + prose(20) + own), " ".join(prose(200)), None, "", "short text"]
    ids = list(range(len(texts)))
    df = docs(spark, texts, ids=ids).withColumnRenamed("lang", "head").withColumnRenamed("source", "id")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    got = {}
    for r in repeats.repeated_passages(df).collect():
        assert r["n_words"] == r["end_word"] - r["start_word"] >= 50
        got.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(texts, ids)


def test_one_passage_in_many_contexts(spark):
    """The best partner to the left is another one than the best to the right."""
    rng = random.Random(4)
    core = [f"c{i}" for i in range(45)]
    tails = [[f"t{k}{i}" for i in range(40)] for k in range(4)]
    fronts = [[f"f{k}{i}" for i in range(40)] for k in range(4)]
    texts = []
    for _ in range(60):
        f, t = rng.choice(fronts), rng.choice(tails)
        a, b = rng.randint(0, 12), rng.randint(0, 12)
        texts.append(" ".join([f"x{rng.random()}"] * 8 + f[40 - a :] + core + t[:b] + [f"y{rng.random()}"] * 8))
    ids = list(range(len(texts)))
    got = {}
    for r in repeats.repeated_passages(docs(spark, texts, ids=ids)).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    assert got == brute(texts, ids)


def test_nothing_null_and_repeated_ids(spark):
    assert repeats.repeated_passages(docs(spark, [])).count() == 0
    t = " ".join(f"v{i}" for i in range(80))
    assert repeats.repeated_passages(docs(spark, [t, t, t], ids=[None, 3, 3])).count() == 0


def pairs_around_one_phrase(spark, n, partitions):
    """n texts with one phrase of 48 words, which pairs of them share with five words before it; all have other words behind it."""
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        core = " ".join(f"c{i}" for i in range(48))
        text = f"concat_ws(' ', transform(sequence(0, 4), i -> concat('f', id div 2, '_', i)), '{core}', concat('a', id % 400), concat('b', id div 400), 'end of text')"
        df = spark.range(n, numPartitions=8).selectExpr("id AS doc_id", f"{text} AS text")
        return {tuple(r) for r in repeats.repeated_passages(df).select("doc_id", "start_word", "end_word").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_a_large_head_on_several_partitions(spark):
    assert pairs_around_one_phrase(spark, 12_000, 4) == {(i, 0, 53) for i in range(12_000)}


def test_a_head_of_many_suffixes(spark):
    assert pairs_around_one_phrase(spark, 70_000, 1) == {(i, 0, 53) for i in range(70_000)}


def test_a_head_in_many_range_partitions(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PART_ROWS", 500)
    assert pairs_around_one_phrase(spark, 6_000, 2) == {(i, 0, 53) for i in range(6_000)}


def test_partitions_of_few_rows_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PART_ROWS", 9)
    test_passages_equal_brute_force(spark)
    test_one_passage_in_many_contexts(spark)
    test_nothing_null_and_repeated_ids(spark)


def test_partitions_of_one_document(spark, monkeypatch):
    """A document repeats a passage so often that its suffixes fill whole partitions between those of the others."""
    monkeypatch.setattr(repeats, "PART_ROWS", 20)
    rng = random.Random(6)
    p = [f"p{i}" for i in range(70)]
    texts = [" ".join(sum((p + [f"z{k}{j}"] for j in range(n)), [])) for k, n in enumerate([1, 150, 1])] + [" ".join(f"q{rng.random()}" for _ in range(90))]
    got = {}
    for r in repeats.repeated_passages(docs(spark, texts, ids=[2, 5, 9, 11])).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    assert got == brute(texts, [2, 5, 9, 11])
