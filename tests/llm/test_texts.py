"""BPE, PII, secrets, host rules and decontamination against brute force on small tables."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pricelens.llm import bpe, decontaminate, host_rules, pii, secret_scan

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None, sources=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", sources[n] if sources else f"src{n % 3}", len(t or "")) for n, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", " ", "a", "word " * 3000, "x" * 5000, "tab\t next\n\n line  two   spaces ", "é ñ 漢字 🙂 end", "don't we'll 123 456", "\x1c odd \x85 gap", " lead"]


def test_bpe_equals_whole_text_encoding(spark):
    enc = bpe.encoding(RANKS, PATTERN)
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab 1\n\t'é.") for _ in range(200)) for _ in range(60)]
    out = {r["doc_id"]: r for r in bpe.digests(bpe.round_trip(docs(spark, texts), RANKS, PATTERN)).collect()}
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert out[i]["n_tokens"] == len(ids)
        assert out[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert out[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_splits_change_nothing():
    enc = bpe.encoding(RANKS, PATTERN)
    rng = random.Random(8)
    for _ in range(300):
        t = "".join(rng.choice(["ab", " ", "1", "\n", "\t", "'s", "\x1c", "\x85", "\u3000", ".", "é"]) for _ in range(60))
        parts = bpe.split_safely(t, 5)
        assert "".join(parts) == t
        assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(t)


def test_bpe_encode_then_decode(spark):
    """Long texts with and without safe places to cut, and columns that are called like working ones."""
    enc = bpe.encoding(RANKS, PATTERN)
    texts = [*ODD, "word and " * 20_000, "é\t" * 90_000, "x" * 120_000, "\n\n a  b" * 30_000]
    df = docs(spark, texts).withColumnRenamed("lang", "_ids").withColumnRenamed("source", "_text")
    coded = bpe.encode(df.select("doc_id", "_ids", F.col("_text").alias("_k0"), "text"), RANKS, PATTERN, keep=["doc_id", "_ids", "_k0"])
    out = bpe.decode(coded, RANKS, PATTERN)
    assert out.columns == ["doc_id", "_ids", "_k0", "token_ids", "decoded"]
    for r in out.collect():
        t = texts[r["doc_id"]] or ""
        assert r["token_ids"] == enc.encode_ordinary(t) and bytes(r["decoded"]) == t.encode() and r["_ids"] == "en"
    empty = spark.createDataFrame([(1, None), (2, [])], "doc_id long, token_ids array<int>")
    assert [bytes(r["decoded"]) for r in bpe.decode(empty, RANKS, PATTERN).collect()] == [b"", b""]


def test_bpe_empty_table_null_ids_and_repeats(spark):
    assert bpe.round_trip(docs(spark, []), RANKS, PATTERN).count() == 0
    assert bpe.round_trip(docs(spark, ["a b", "a b", None], ids=[None, 1, 1]), RANKS, PATTERN).count() == 3


BASE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
BASE_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def brute_pii(t):
    out = [("email", *m.span()) for m in BASE_EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in BASE_IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and pii.luhn(d)]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_pii_base_equals_the_patterns(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["@", ".", "a", "b-", "1", "23", "256", " ", "_", "%", "+", "(", "4111 1111 1111 1111", "x@y.z"]) for _ in range(60)) for _ in range(300)]
    for t in texts + [x or "" for x in ODD]:
        assert pii.plain_spans(t) == brute_pii(t), t
    out = pii.digests(pii.find(docs(spark, texts))).collect()
    for r in out:
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b in brute_pii(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("write jane (at) mail (dot) example (dot) com now", ("email", "jane (at) mail (dot) example (dot) com")),
        ("write jane at mail dot example dot com now", ("email", "jane at mail dot example dot com")),
        ("write jаne@mаil.com now", ("email", "jаne@mаil.com")),
        ("write jane＠mail．com now", ("email", "jane＠mail．com")),
        ("call plus four nine three zero one two three four five six end", ("phone", "plus four nine three zero one two three four five six")),
        ("card ４111 1111 1111 1111 end", ("card", "４111 1111 1111 1111")),
        ("jane​@ma​il.com", ("email", "jane​@ma​il.com")),
    ],
)
def test_pii_disguises_map_back(text, found):
    spans = pii.disguised_spans(text, pii.plain_spans(text))
    assert [(k, text[a:b]) for k, a, b in spans] == [found]


@pytest.mark.parametrize("text", ["call plus 49 151 2345678", "Plus 1 (555) 867-5309"])
def test_pii_plus_before_plain_digits(text):
    start = text.lower().index("plus")
    for more in ("", " or x dot y"):
        assert pii.disguised_spans(text + more, []) == [("phone", start, len(text))]


def brute_transducer(text):
    """Character by character, with rules tried in order at every place."""
    chars = [(pii._MAP.get(c, c), i) for i, c in enumerate(text) if c not in pii._UNSEEN]
    plain = "".join(c for c, _ in chars)
    white, word = lambda p: p < len(plain) and plain[p].isspace(), "|".join(pii._SPELLED)
    out, p = [], 0
    while p < len(plain):
        hit = None
        bracketed = re.compile(r"\s*[(\[{<]\s*(at|dot)\s*[)\]}>]\s*", re.I | re.A).match(plain, p)
        spaced = re.compile(r"\s+(at|dot)\s+(?=([A-Za-z0-9].*)?)", re.I | re.A | re.S).match(plain, p)
        if bracketed and not (white(p) and p and plain[p - 1].isspace()):
            hit = [("@" if bracketed[1].lower() == "at" else ".", p, bracketed.end())]
        elif spaced and p and re.match("[A-Za-z0-9]", plain[p - 1]):
            ahead = plain[spaced.end() :]
            if spaced[1].lower() == "dot" and re.match("[A-Za-z0-9]", ahead):
                hit = [(".", p, spaced.end())]
            elif spaced[1].lower() == "at":
                more = re.match(rf"(?:[A-Za-z0-9-]+\s+dot\s+)+{pii._ENDING}\b|[A-Za-z0-9-]+\s*[(\[{{<]\s*dot\s*[)\]}}>]", ahead, re.I | re.A)
                hit = [("@", p, spaced.end())] if more else None
        elif p == 0 or not re.match(r"\w", plain[p - 1], re.A):
            plus = re.compile(rf"plus\s+(?=(?:{word})\b|[0-9])", re.I | re.A).match(plain, p)
            run = re.compile(rf"(?:{word})(?:[\s,-]+(?:{word}|[0-9]+))+\b", re.I | re.A).match(plain, p)
            if plus:
                hit = [("+", p, plus.end())]
            elif run:
                hit = [(pii._SPELLED.get(t[0].lower(), t[0]), p + t.start(), p + t.end()) for t in re.finditer(f"{word}|[0-9]", run[0], re.I)]
                out += [(c, chars[a][1], chars[b - 1][1] + 1) for c, a, b in hit]
                p = run.end()
                continue
        if hit:
            out += [(c, chars[a][1], chars[b - 1][1] + 1) for c, a, b in hit]
            p = hit[-1][2]
        else:
            out.append((plain[p], chars[p][1], chars[p][1] + 1))
            p += 1
    return "".join(c for c, _, _ in out), [a for _, a, _ in out], [b for _, _, b in out]


def test_pii_transducers_equal_brute_force():
    rng = random.Random(3)
    bits = ["jane", " ", "  ", " at ", " (at) ", "[ dot ]", " dot ", "mail", "com", "-", "one", "two ", "nine", " 4", "12", "plus ", "Plus one", "е", "４", "\u200b", "．", "@", "+", "(", "AT", ",", "\u00a0", "x"]
    for _ in range(1500):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))
        normal, starts, ends = pii.transduce(t)
        assert (normal, starts.tolist(), ends.tolist()) == brute_transducer(t), repr(t)
        base = pii.plain_spans(t)
        want = [(k, starts[a], ends[b - 1]) for k, a, b in pii.plain_spans(normal)]
        want = [(k, a, b) for k, a, b in want if not any(k == j and a < y and x < b for j, x, y in base)]
        assert pii.disguised_spans(t, base) == want


@pytest.mark.parametrize("text", ["a (at) b " + " " * 1_000_000 + "(", "jane at mail dot com " * 50_000, "one " + " " * 1_000_000 + "x dot y", "a@b.co " * 140_000 + "x (at) y", "1 " * 500_000 + "x dot y", "(" * 1_000_000 + "at) dot y"])
def test_pii_of_a_million_characters(text):
    began = time.process_time()
    pii.disguised_spans(text, pii.plain_spans(text))
    assert time.process_time() - began < 20


def test_pii_leaves_plain_words_alone_and_masks():
    for t in ("they met at noon and one two went home", "the dot on the i", "look at this dot there", "at the at of dot"):
        assert pii.plain_spans(t) + pii.disguised_spans(t, []) == []


def test_pii_mask(spark):
    df = docs(spark, ["mail a@b.co and 10.0.0.1", None, "", "clean"]).withColumn("_c0", F.lit(1)).withColumn("base", F.lit(2))
    out = {r["doc_id"]: r for r in pii.mask(df).collect()}
    assert out[0]["text"] == "mail [EMAIL] and [IP]" and out[0]["n_chars"] == len(out[0]["text"])
    assert out[1]["text"] is None and out[3]["text"] == "clean" and out[0]["base"] == 2 and pii.mask(df).columns == df.columns
    assert pii.mask(docs(spark, [])).count() == 0
    found = pii.find(df, keep=["doc_id", "base"])
    assert found.columns == ["doc_id", "base", "base", "extra"] and found.count() == 4


def brute_secrets(t):
    out = [("assign", *m.span()) for m in re.finditer(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t) if len(m[1]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return out


def test_secrets_base_equals_the_patterns(spark):
    rng = random.Random(2)
    bits = ["token", "API_KEY", "apikey", "=", ": ", '"', "AKIA", "ABCD1234EFGH5678IJKL", "0123456789abcdef" * 2, " ", "x", "PassWd", "abc", "ſecret"]
    texts = ["".join(rng.choice(bits) for _ in range(30)) for _ in range(200)]
    order = ["assign", "access", "hex"]
    out = secret_scan.digests(secret_scan.find(docs(spark, texts + ODD))).collect()
    assert len(out) == len(texts + ODD)
    for r in out:
        t = (texts + ODD)[r["doc_id"]] or ""
        assert secret_scan.plain_spans(t) == brute_secrets(t)
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(brute_secrets(t), key=lambda x: (x[1], order.index(x[0]))))
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
    assert secret_scan.find(docs(spark, [])).count() == 0


def test_randomness_battery_tells_tokens_from_words(spark):
    rng = random.Random(3)
    alnum = secret_scan._ALPHABETS["alnum"]
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    prose = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(60)]
    keys = ["".join(rng.choice(alnum) for _ in range(40)) for _ in range(60)]
    texts = [p + " " + k for p, k in zip(prose, keys, strict=True)] + ["thisisaverylongwordwithoutanygapatall " * 3, "_" * 60, "abcdefghijklmnopqrstuvwxyz0123456789"]
    out = {r["doc_id"]: r["spans"] for r in secret_scan.digests(secret_scan.find(docs(spark, texts))).collect()}
    caught = sum(out[i] == f"random:{len(prose[i]) + 1}:{len(texts[i])}" for i in range(60))
    assert caught >= 54
    assert out[60] == out[61] == out[62] == ""


def brute_battery(x, size):
    n = len(x)
    classes = min(size, max(2, n // 5))
    of = [i * classes // size for i in range(size)]
    chi = sum((sum(of[v] == j for v in x) - n * of.count(j) / size) ** 2 / (n * of.count(j) / size) for j in range(classes))
    df = classes - 1
    z = ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    p_chi = math.erfc(z / math.sqrt(2)) / 2
    high = [v >= size / 2 for v in x]
    n1, n2 = sum(high), n - sum(high)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    mean = 2 * n1 * n2 / n + 1
    p_runs = math.erfc(9 / math.sqrt(2)) if not n1 or not n2 else math.erfc(min(abs(runs - mean) / math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9)), 9) / math.sqrt(2))
    c = [v - sum(x) / n for v in x]
    power = sum(v * v for v in c)
    r = sum(a * b for a, b in zip(c, c[1:], strict=False)) / power if power else 1.0
    p_serial = math.erfc(min(abs(r + 1 / n) * math.sqrt(n), 9) / math.sqrt(2))
    half = -sum(math.log(min(max(p, 1e-30), 1)) for p in (p_chi, p_runs, p_serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def test_the_battery_equals_brute_force():
    rng = random.Random(9)
    for _ in range(300):
        size = rng.choice([16, 32, 62, 64])
        x = [min(size - 1, int(rng.random() ** rng.choice([1, 1, 3]) * size)) for _ in range(rng.randint(20, 140))]
        got = secret_scan.battery(np.array([x, x], dtype=np.int16), size)
        assert got[0] == got[1] and abs(got[0] - brute_battery(x, size)) < 1e-4 + 1e-3 * got[0]


def brute_plain(text):
    """Stretches of one text, by encoding: words in the encoding's characters, cut one after the other."""
    shift = zlib.crc32(text.encode()) % (180 * len(secret_scan.STRETCH))
    words = [w for w in re.split("[^A-Za-z0-9]+", text) if w]
    words = [w[0].upper() + w[1:] if (i + shift) // 90 % 2 else w for i, w in enumerate(words)]
    signed = []
    for i, w in enumerate(words):
        kind = (i + shift) // 30 % 3
        signed += [secret_scan._TABLES["base64"][ord(c)] for c in w] + ([62 + (i + shift) % 2 if kind == 2 else 62 + kind] if i < len(words) - 1 else [])
    joined = "".join(words)
    symbols = {k: [secret_scan._ALPHABETS[k].index(c) for c in f(joined) if c in secret_scan._ALPHABETS[k]] for k, f in (("hex", str.lower), ("base32", str.upper), ("alnum", str))} | {"base64": signed}
    for k, x in symbols.items():
        i = shift % len(secret_scan.STRETCH)
        while len(x) >= secret_scan.STRETCH[0]:
            n = secret_scan.STRETCH[i] if secret_scan.STRETCH[i] <= len(x) else max(s for s in secret_scan.STRETCH if s <= len(x))
            i = (i + 1) % len(secret_scan.STRETCH) if secret_scan.STRETCH[i] <= len(x) else secret_scan.STRETCH.index(n)
            yield k, secret_scan.STRETCH.index(n), x[:n]
            x = x[n:]
            if n != secret_scan.STRETCH[(i - 1) % len(secret_scan.STRETCH)]:
                i = max((j for j, s in enumerate(secret_scan.STRETCH) if s <= len(x)), default=0)


def key_corpus():
    rng = random.Random(12)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    texts = []
    for i in range(90):
        key = "".join(rng.choice(secret_scan._ALPHABETS[("alnum", "base64", "base32")[i % 3]]) for _ in range(rng.randint(20, 90)))
        texts.append(" ".join([*(rng.choice(words) for _ in range(rng.randint(0, 300))), key, rng.choice(words) * 8, "é", rng.choice(words)]))
    return texts + [None, "", "x" * 500_000]


def test_thresholds_equal_brute_force_in_every_layout(spark):
    texts = key_corpus()
    tail = lambda c, key, low: sum(n for (k, b), n in c.items() if k == key and b >= low)
    plain, seen = Counter(), Counter()
    for t in texts:
        base = secret_scan.plain_spans(t or "")
        for r in secret_scan.tokens(t or "", base):
            seen[r["stratum"], r["bin"]] += 1
        for k, i, x in brute_plain(secret_scan._rest(t or "", base)):
            p = secret_scan.battery(np.array([x], dtype=np.int16), len(secret_scan._ALPHABETS[k]))
            plain[secret_scan.ENCODINGS.index(k) * len(secret_scan.STRATA) + i, int(secret_scan._bin(p)[0])] += 1
    strata = range(len(secret_scan.ENCODINGS) * len(secret_scan.STRATA))
    p = {(s, b): (1 + tail(plain, s, b)) / (1 + tail(plain, s, 0)) if b >= 20 else 1.0 for s in strata for b in range(secret_scan.BINS)}  # bin 20 is MIN_P
    tested = sorted(p[k] for k, n in seen.items() for _ in range(n))
    passed = [q for i, q in enumerate(tested, 1) if q < 1 and q * len(tested) <= secret_scan.MAX_FDR * i]
    want = [min((b for b in range(secret_scan.BINS) if passed and p[s, b] <= max(passed)), default=secret_scan.BINS) for s in strata]
    df = docs(spark, texts).withColumnRenamed("lang", "base").withColumnRenamed("source", "tokens")
    spans = set()
    for parts, batch in ((1, 10_000), (4, 7), (60, 1)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        assert secret_scan.thresholds(secret_scan.scan(df.repartition(parts))) == want
        spans.add(tuple(sorted(secret_scan.digests(secret_scan.find(df.repartition(parts))).select("doc_id", "spans").collect())))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(spans) == 1 and sum("random" in r["spans"] for r in spans.pop()) > 60
    assert secret_scan.find(df, keep=["doc_id", "base", "tokens"]).columns == ["doc_id", "base", "tokens", "base", "extra"]


def test_slugs_are_no_secrets(spark):
    words = "the of side effects well known state art house water market report garden people history river music winter paper travel".split()
    rng = random.Random(6)
    prose = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(60)]
    slugs = ["well-known-side-effects", "Frankfurt/Main-Flughafen", "state-of-the-art-thing"]
    slugs += ["-".join(rng.choice(words) for _ in range(5)) for _ in range(37)] + ["".join(rng.choice(words) for _ in range(6)).upper() for _ in range(20)]
    texts = [f"{p} {x}" for p, x in zip(prose, slugs, strict=True)]
    out = secret_scan.digests(secret_scan.find(docs(spark, texts))).collect()
    assert [r["spans"] for r in out] == [""] * 60


def test_a_source_of_many_keys_hides_none(spark):
    """Keys are a third of all letters, and are found all the same, in two encodings."""
    rng = random.Random(7)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    prose = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(120)]
    code = ["alnum", "base64"]
    keys = [" ".join("".join(rng.choice(secret_scan._ALPHABETS[code[i % 2]]) for _ in range(40)) for _ in range(12)) for i in range(120)]
    texts = [f"{p} {k}" for p, k in zip(prose, keys, strict=True)]
    out = secret_scan.digests(secret_scan.find(docs(spark, texts))).collect()
    assert sum(r["spans"].count("random") for r in out) >= 0.9 * 120 * 12


def brute_signals(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {x for x in g if g.count(x) > 1}
    cover = {i + j for i, x in enumerate(g) if x in twice for j in range(3)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(cover)


def test_host_rules_signals(spark):
    rng = random.Random(4)
    texts = [x for x in ODD if x is None or len(x) < 6000] + ["".join(rng.choice(["a ", "b ", "c\n", "\n", " ", "#", " ", "dd "]) for _ in range(80)) for _ in range(80)]
    texts = [t for t in texts if t is None or len(t.split()) < 400]
    rows = host_rules.signals(docs(spark, texts), ["doc_id"]).collect()
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_signals(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_host_rates_are_shrunk_by_hand(spark):
    """Four hosts and one rule that fails: the prior's mean and weight by moments, written out."""
    good, junk = " ".join(f"word{i}" for i in range(80)), " ".join(f"w{i}###" for i in range(80))
    counts = {"a": (20, 1), "b": (40, 10), "c": (6, 5), "d": (2, 2)}  # documents and failures
    texts, sources = [], []
    for h, (n, k) in counts.items():
        texts += [junk] * k + [good] * (n - k)
        sources += [h] * n
    n, k = sum(n for n, _ in counts.values()), sum(k for _, k in counts.values())
    m = k / n
    v = (sum(a * (b / a - m) ** 2 for a, b in counts.values()) - 3 * m * (1 - m)) / n
    weight = m * (1 - m) / v - 1
    assert 2 < weight < 1e6
    measured = host_rules.signals(docs(spark, texts, sources=sources), ["doc_id", "source"])
    got = {r["source"]: r for r in host_rules.host_verdicts(host_rules.host_rates(measured)).collect()}
    for h, (a, b) in counts.items():
        assert abs(got[h]["rate_symbols"] - (b + m * weight) / (a + weight)) < 1e-12
        assert got[h]["host_rejected"] == ((b + m * weight) / (a + weight) > 0.5)
    assert got["c"]["host_rejected"] and not got["b"]["host_rejected"]


def test_host_rules_verdicts(spark):
    good = " ".join(f"word{i}" for i in range(80))
    junk = " ".join(f"w{i}###" for i in range(80))
    texts = [good] * 30 + [junk] * 40 + [good] * 4 + ["short"] + [good]
    sources = ["fine"] * 30 + ["bad"] * 40 + ["bad"] * 4 + [None, None]
    df = docs(spark, texts, sources=sources).withColumn("kept", F.lit("x")).withColumn("n_words", F.lit(1))
    out = {r["doc_id"]: r for r in host_rules.host_quality(df).collect()}
    assert all(out[i]["kept"] for i in range(30)) and not any(out[i]["kept"] for i in range(30, 75))
    assert out[74]["base_failed"] and not out[70]["base_failed"] and out[70]["host_rejected"] and out[75]["kept"]
    kept = host_rules.keep_good(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [*range(30), 75]
    assert host_rules.host_quality(docs(spark, [])).count() == 0 == host_rules.keep_good(docs(spark, [])).count()


def brute_distance(p, t):
    prev = list(range(len(p) + 1))
    best = prev[-1]
    for c in t:
        cur = [0]
        for i in range(1, len(p) + 1):
            cur.append(min(prev[i] + 1, cur[-1] + 1, prev[i - 1] + (p[i - 1] != c)))
        prev, best = cur, min(best, cur[-1])
    return best


def test_myers_equals_dynamic_programming():
    rng = random.Random(6)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))
        assert decontaminate.myers(p, t)[0] == brute_distance(p, t)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [prose(30) for _ in range(12)] + [None, "", "tiny"]
    texts = [None, "", prose(50)]
    for item in items[:12]:
        for edits in (0, 3, 9, 40):
            x = list(item)
            for _ in range(edits):
                x[rng.randrange(len(x))] = rng.choice("abcdefgh ,.")
            texts.append(prose(20) + " " + "".join(x).upper() + ". " + prose(20))
    df = docs(spark, texts).withColumn("hits", F.lit(1)).withColumn("item_id", F.lit(2))
    bench = spark.createDataFrame(list(enumerate(items)) + [(0, items[0])], "item_id long, text string")
    want = set()
    for i, t in enumerate(texts):
        for j, item in enumerate(items):
            n = decontaminate.normalise(item)
            if n and brute_distance(f" {n} ", f" {decontaminate.normalise(t)} ") <= decontaminate.budget(len(n)):
                want.add((i, j))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(df, bench).collect()}
    assert got == want and len(want) > 30
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(df, bench, block_bytes=300).collect()} == want
    clean = decontaminate.remove(df, bench)
    assert clean.columns == df.columns and {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {i for i, _ in want}
    assert decontaminate.remove(df, bench.limit(0)).count() == len(texts)
    assert decontaminate.contaminations(docs(spark, []), bench).count() == 0


@pytest.mark.parametrize("block_bytes", [10**6, 20])
def test_decontamination_rows_words_and_offsets(spark, block_bytes):
    long = " ".join(f"word{i}" for i in range(60_000))
    texts = ["a concatenated Cat!", "concatenate", "the  CAT\tsat; ", "the  CAT\tsat; ", "the cat sat", "İ—the cat, sat", long + " the cat sat on " + long, "我们使用猫咪模型", None, ""]
    ids = [1, 2, 3, 3, None, None, 4, 5, 6, None]
    bench = spark.createDataFrame([("x", "cat"), ("y", "The cat sat"), ("z", "猫咪"), (None, "cat"), (None, "CAT SAT"), ("e", ""), ("n", None)], "item_id string, text string")
    df = docs(spark, texts, ids=ids).withColumnRenamed("lang", "row").withColumnRenamed("source", "hits")
    want = []
    for i, t in zip(ids, texts, strict=True):
        for item, patterns in (("x", ["cat"]), ("y", ["the\\s+cat[,\\s]+sat"]), ("z", ["猫咪"]), (None, ["cat", "cat[,\\s]+sat"])):
            edge = "" if item == "z" else r"(?<![a-z])"
            spans = [m.span() for p in patterns for m in re.finditer(edge + p + edge.replace("<", ""), (t or "").lower().replace("i̇", "İ"))]
            want += [(i, item, 0, *min(spans))] if spans else []
    got = [tuple(r) for r in decontaminate.contaminations(df, bench, block_bytes=block_bytes).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 12
    left = decontaminate.remove(df, bench, block_bytes=block_bytes)
    assert sorted([r["text"] for r in left.collect()], key=str) == sorted(["concatenate", None, ""], key=str)
