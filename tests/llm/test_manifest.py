"""Merkle manifests, cuts for filling in the middle, word BPE and bounded slices against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricelens.llm import common, fim, merkle, word_bpe

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, hash string, `path` string"
H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row, lower=False):
    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    row = list(row[:5])
    if lower and row[4] is not None:
        row[4] = re.sub("[A-Z]", lambda m: m[0].lower(), row[4])
    return H("".join(map(part, row)))


def grown(hashes):
    """Levels of a tree, and for each leaf the pairs of what is left and right of it, upwards."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    paths = []
    for i in range(len(hashes)):
        path = []
        for level in levels[:-1]:
            at = i // 16 * 16
            path.append(("".join(level[at:i]), "".join(level[i + 1 : at + 16])))
            i //= 16
        paths.append(path)
    return levels[-1][0], paths


def brute_force(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        held = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = (held, *grown([leaf_of(r) for r in held]))
    root, above = grown([trees[s][1] for s in names])
    out = []
    for s, up in zip(names, above, strict=True):
        held, subroot, paths = trees[s]
        for r, path in zip(held, paths, strict=True):
            path = path + up
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            x = leaf_of(r, tampered)
            for a, b in path:
                x = H(a + x + b)
            out.append((r[0], leaf_of(r), subroot, root, H("".join(a + b for a, b in path)), x, x == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 300, "b": 16, None: 17, "": 2, "é": 1, "B": 257}, {f"s{i}": 1 + i % 3 for i in range(40)}])
def test_merkle_manifest(spark, sizes):
    rng, rows = random.Random(7), []
    for s, n in sizes.items():
        for i in range(n):
            doc = rng.choice([None, 5, 5, *range(1000)]) if n > 2 else i
            text = rng.choice([None, "", "lower only", "Upper é Ä", "A:1", "x" * 5000 + "Y"])
            rows.append((doc, s, rng.choice([None, "", "en"]), rng.choice([None, 3]), text, "t", "h", "p"))
    rows += rows[:3]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    manifest = merkle.build(docs, COLUMNS, "doc_id", "source", {"text": merkle.lowered(docs["text"], docs["doc_id"])})
    got = sorted((tuple(r) for r in merkle.digests(merkle.check(manifest)).collect()), key=str)
    assert got == brute_force(rows)
    whole = manifest.nodes().filter("tree = ''").orderBy(F.desc("level")).first()
    assert (whole["lo"], whole["hi"], whole["hash"]) == (0, len(sizes), got[0][3])


def test_an_empty_dataset_has_no_proofs(spark):
    docs = spark.createDataFrame([], DOCS)
    assert merkle.check(merkle.build(docs, COLUMNS, "doc_id", "source")).collect() == []


def test_a_change_is_found_and_nothing_else(spark):
    rows = [(i, "s" if i % 3 else "t", "en", i, f"Text {i}", "", "", "") for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    seen = F.when(F.col("doc_id") == 77, F.lit("other")).otherwise(F.col("text"))
    out = merkle.digests(merkle.check(merkle.build(docs, COLUMNS, "doc_id", "source", {"text": seen})))
    assert [r["doc_id"] for r in out.filter("not verified").collect()] == [77]


# ---- filling in the middle ----------------------------------------------------------------------------------------------------


def cut(doc, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = H(f"42:{'' if doc is None else doc}")
    a, b, r, q = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((a % (len(units) + 1), b % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or r % 100 >= 50:
        return (doc, len(units), "plain", None, None, H(text), H(text))
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if q % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return (doc, len(units), form, len(p), len(m), H(out), H(text))


def test_fill_in_middle(spark):
    rng = random.Random(3)
    pieces = ["a", "word", " ", "  ", "\n", "\t\r\x0b\x0c", "é", "😀", "\xa0", "$1", "\\", "<", "<P", ">", "S>", "<M>", "{2}", "\x1c", "　"]
    texts = ["".join(rng.choice(pieces[:15] if rng.random() < 0.8 else pieces) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", " ", "x", " \n", "w " * 200_000, " " * 300_000, "é" * 300_000, "a <P> b"]
    rows = [(i if i % 50 else None, t, i) for i, t in enumerate(texts)]
    rows += rows[:2]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_units int")
    got = sorted((tuple(r) for r in fim.digests(fim.transform(docs)).collect()), key=str)
    assert got == sorted((cut(i, t) for i, t, _ in rows), key=str)
    held = fim.transform(docs, keep=["n_units", "doc_id"])
    assert held.columns == ["n_units", "doc_id", "n_units", "fim_form", "fim_output"]
    assert fim.transform(docs.limit(0)).count() == 0


# ---- word BPE -----------------------------------------------------------------------------------------------------------------

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORDS)
    t.no_truncation()
    t.no_padding()
    return t


def odd_texts():
    rng = random.Random(5)
    pieces = ["<|endoftext|>", "<|startoftext|>", "<|", "a", "'s", "'LL", "'", " ", "é", "é", "Σ", "ΑΣ", "İ", "́", "1", "23", "\x1c", "\x85", "　", "漢字", "<", ">", "</w>", "😀", "lower", "low", "the", "ing"]
    out = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(400)]
    out += ["".join(rng.choice("aabhint") for _ in range(rng.randint(1, 90))) for _ in range(400)]
    return out + [None, "", " ", "x" * 50_000, "ab" * 40_000, "long words " * 20_000]


def test_word_bpe_is_the_librarys(spark, library):
    texts = odd_texts()
    docs = spark.createDataFrame([(i % 300 or None, t, "p") for i, t in enumerate(texts)], "doc_id long, text string, packed string")
    want = []
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        raw = np.array(ids, dtype="<u4").tobytes()
        want.append((i % 300 or None, len(ids), hashlib.sha256(raw).hexdigest(), H(library.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in word_bpe.digests(word_bpe.round_trip(docs, WORDS)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    ids = word_bpe.encode(docs.filter("doc_id < 20"), WORDS)
    back = word_bpe.decode(ids, WORDS).collect()
    assert sorted(r["decoded"] for r in back) == sorted(library.decode(r["token_ids"], skip_special_tokens=False) for r in ids.collect())
    assert word_bpe.round_trip(docs.limit(0), WORDS).count() == 0


def test_words_share_their_prefixes_and_nothing_else():
    merges = word_bpe.encoder(WORDS).merges
    final = lambda w: w[:-1] + chr(ord(w[-1]) + 0x1000)
    words = {final(w) for w in ("low", "lower", "lowest", "lows", "l", "lo" * 50, "lo" * 50 + "x")}
    asked = []
    first = merges.last_token
    merges.last_token = lambda spelled, at, ends: asked.append(spelled[:at]) or first(spelled, at, ends)
    try:
        together = word_bpe.encode_words(merges, words)
    finally:
        del merges.last_token
    short = [p for p in asked if len(p) <= word_bpe.DEPTH]
    assert len(short) == len(set(short))
    assert together == {w: word_bpe.encode_words(merges, {w})[w] for w in words}


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(word_bpe, "REMEMBERED_BYTES", 1000)
    monkeypatch.setattr(word_bpe, "REMEMBERED_BORDERS", 50)
    run = word_bpe.Encoder(WORDS)
    for t in odd_texts()[:300]:
        assert np.frombuffer(run.encode([t])[0], dtype="<u4").tolist() == library.encode(t or "", add_special_tokens=False).ids


# ---- slices ---------------------------------------------------------------------------------------------------------------------


def test_slices_are_bounded_by_rows_and_bytes():
    texts = ["a" * n for n in (10, 3_000_000, 9_000_000, 2_000_000, 2_500_000)] + ["b"] * 1000
    batch = pa.record_batch({"t": texts}).slice(1)
    parts = list(common.slices(batch))
    assert [x for p in parts for x in p.column(0).to_pylist()] == texts[1:]
    assert all(p.num_rows <= common.SLICE_ROWS and (p.num_rows == 1 or p.nbytes <= common.SLICE_BYTES) for p in parts)
    assert list(common.slices(batch.slice(0, 0))) == []
