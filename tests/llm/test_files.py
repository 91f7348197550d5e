"""Archives, shards and the URL filter: round trips, brute force and held-out accuracy."""

import base64
import gzip
import hashlib
import io
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from pricelens.llm import bpe, training_order, url_filter, warc
from tests.llm.test_texts import ODD, docs

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PAGES = "page_id long, url string, html string"


def test_warc_round_trip(spark):
    html = ["<p>a</p>", "<p>a</p>", None, "", "é" * 70000, "x", "x", "x\r\n\r\ny", "<p>a</p>"]
    ids = [5, 3, 7, 8, 1, None, 2, 9, 3]
    rows = [(i, None if i == 7 else f"http://a.b/{i}\r\n?é", h) for i, h in zip(ids, html, strict=True)]
    df = spark.createDataFrame(rows, PAGES).withColumnRenamed("html", "payload").withColumnRenamed("url", "digest")
    out = warc.round_trip(df.repartition(3), payload="payload", url="digest").collect()
    want = []
    for i, h in zip(ids, html, strict=True):
        same = [j for j, g in zip(ids, html, strict=True) if (g or "") == (h or "") and j is not None]
        first = min(same) if len(same) + ((h or "") == "x") > 1 else i
        raw = (h or "").encode()
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), *(("response", None) if first == i else ("revisit", first))))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_inflating_in_small_chunks(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    raw = [warc.record(i, f"http://x/{i}", b"p" * i * 50, "D", None if i % 2 else 1) for i in range(12)]
    for packed in (gzip.compress(b"".join(raw)), b"".join(gzip.compress(r) for r in raw)):
        assert list(warc.inflated_records(io.BytesIO(packed))) == raw


def test_cut_streams_are_errors():
    raw = [warc.record(i, f"http://x/{i}", b"p" * i * 50, "D", None) for i in range(12)]
    packed = gzip.compress(b"".join(raw), mtime=0)
    whole = zlib.compressobj(wbits=31)
    half = whole.compress(b"".join(raw[:5])) + whole.flush(zlib.Z_FULL_FLUSH)  # ends with a record, without a trailer
    for cut in (packed[:-1], packed[:-8], packed[: len(packed) // 2], half, gzip.compress(b"".join(raw)[:-3])):
        with pytest.raises(ValueError, match="stops before|last whole record"):
            list(warc.inflated_records(io.BytesIO(cut)))
    assert list(warc.inflated_records(io.BytesIO(b""))) == [] and list(warc.inflated_records(io.BytesIO(packed + b"\0" * 40))) == raw


def test_the_sidecar_finds_every_record(spark):
    from pricelens.llm.common import new_path, stash
    from pricelens.llm.files import opened

    pages = spark.createDataFrame([(i, f"http://x/{i}", "text " * i) for i in range(40)], PAGES)
    folder = new_path(spark, "records")
    archives = stash(warc.normalise(stash(warc.write_monolithic(warc.with_revisits(pages.repartition(3)), new_path(spark, "warc")), "archives"), folder), "done")
    rows = warc.read_index(archives, folder).collect()
    assert len(rows) == 40 == sum(r["n_records"] for r in archives.collect())
    seen = set()
    for r in rows:
        with opened(r["archive"], random=True) as file:
            file.seek(r["offset"])
            member = file.read(r["length"])
        one = warc.parse(gzip.decompress(member))
        assert one["payload_bytes"] == 5 * one["id"]
        seen.add(one["id"])
        with opened(r["archive"] + ".idx", random=True) as file:
            assert f"{r['number']} {r['offset']} {r['length']}".encode() in file.read().split(b"\n")
    assert seen == set(range(40))


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        for key in (0, 7, -3):
            assert sorted(training_order.feistel(np.arange(n), n, key).tolist()) == list(range(n))
    a, b = training_order.feistel(np.arange(1000), 1000, 1), training_order.feistel(np.arange(1000), 1000, 2)
    assert (a != b).mean() > 0.9 and abs(np.corrcoef(np.arange(1000), a)[0, 1]) < 0.15


def test_shards_hold_all_tokens_in_training_order(spark):
    from pricelens.llm.common import new_path

    rng = random.Random(1)
    texts = ODD + [" ".join(rng.choice(["alpha", "beta", "γ", "42"]) for _ in range(rng.randint(0, 900))) for _ in range(40)] + ["long text " * 9000]
    ids = [*range(len(texts) - 3), None, 4, 4]
    rng.shuffle(ids)
    run, end = bpe.encoder(RANKS, PATTERN), training_order.end_token(RANKS, PATTERN)
    order = sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is not None, x[0] or 0, hashlib.sha256((x[1] or "").encode()).digest()))
    stream = [i for _, t in order for i in [*np.frombuffer(run(t), dtype=np.int32).tolist(), end]]
    total = -(-len(stream) // 64)
    want = {}
    for k in range(total):
        part = stream[k * 64 : (k + 1) * 64]
        raw = np.array(part + [end] * (64 - len(part)), dtype="<u2").tobytes()
        slot = int(training_order.feistel(np.array([k]), total, 11)[0])
        want[slot] = (k, len(part), slot // 10, slot % 10 * 128, hashlib.sha256(raw).hexdigest())
    df = docs(spark, texts, ids=ids).withColumnRenamed("lang", "slot").withColumnRenamed("source", "tokens")
    for parts in (1, 4, 23):
        folder = new_path(spark, "shards")
        manifest = training_order.materialise(df.repartition(parts), RANKS, PATTERN, 11, folder=folder, seq_len=64, shard_rows=10)
        rows = training_order.read_shards(manifest, 64).collect()
        assert {r["slot"]: (r["sequence"], r["n_tokens"], r["shard"], r["offset"], r["tokens_sha256"]) for r in rows} == want and len(rows) == total
        for slot in (0, 7, 10, total - 1, total):
            resumed = [hashlib.sha256(x.tobytes()).hexdigest() for x in training_order.sequences_from(folder, slot, total, 64, 10)]
            assert resumed == [want[s][4] for s in range(slot, total)]
    assert training_order.materialise(docs(spark, []), RANKS, PATTERN, 1).count() == 0


def test_ids_beyond_16_bits_are_refused(monkeypatch):
    class Large:
        max_token_value = 70_000

    monkeypatch.setattr(training_order, "encoding", lambda *_: Large)
    with pytest.raises(ValueError, match="16 bits"):
        training_order.end_token(RANKS, PATTERN)


def brute_url(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:cut]


def brute_rule(host, path):
    best = None
    for what, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, what)
    return best or (None, None)


def brute_scores(train, texts):
    k = url_filter.ORDER
    n, c = ({v: {} for v in ("allow", "block")} for _ in range(2))
    for v, t in train:
        p = "\x02" * k + t
        for i in range(k, len(p)):
            for m in range(1, k + 2):
                n[v][p[i - m + 1 : i + 1]] = n[v].get(p[i - m + 1 : i + 1], 0) + 1
                c[v][p[i - m + 1 : i]] = c[v].get(p[i - m + 1 : i], 0) + 1
    out = {}
    for t in texts:
        p, total = "\x02" * k + t, 0.0
        for i in range(k, len(p)):
            prob = {}
            for v in n:
                q = 1 / url_filter.ALPHABET
                for m in range(1, k + 2):
                    q = (n[v].get(p[i - m + 1 : i + 1], 0) + url_filter.BETA * q) / (c[v].get(p[i - m + 1 : i], 0) + url_filter.BETA)
                prob[v] = q
            total += math.log(prob["allow"] / prob["block"])
        out[t] = total / len(t)
    return out


def test_url_parts_and_rules(spark):
    urls = [None, "", "no scheme", "http://A.Net", "http://net/", "http://x.NET/a?b#c", "https://m.example.net/en/1", "ftp://example.net/en", "http://a.org/fr/x://y", "x://a.org?/fr/", "://é.ORG/fr/", "http://notnet/", "http://example.com/de/\nz", "http://a.example.com/de"]
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)] + [(None, "http://x.net/", None)] * 2, PAGES).withColumnRenamed("html", "text")
    out = url_filter.judge(df).collect()
    assert len(out) == len(urls) + 2
    for r in out:
        u = urls[r["page_id"]] if r["page_id"] is not None else "http://x.net/"
        assert (r["host"], r["path"]) == brute_url(u)
        name, what = brute_rule(r["host"], r["path"])
        assert r["rule"] == name and r["verdict"] in ("allow", "block") and (what is None or r["verdict"] == what)
    assert url_filter.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_url_models_equal_brute_force_and_tell_classes_apart(spark):
    rng = random.Random(2)
    good = ["news", "river", "garden", "school"]
    bad = ["casino", "pills", "bets", "cheap"]
    url = lambda words, end: f"{rng.choice(words)}-{rng.choice(words)}{rng.randint(1, 99)}.{end}"
    texts = [("allow", url(good, "org") + "/fr/") for _ in range(60)] + [("block", url(bad, "net") + "/") for _ in range(60)]
    labelled = spark.createDataFrame(texts, "verdict string, text string")
    new = [url(good, "com") + "/en/" for _ in range(20)] + [url(bad, "com") + "/en/" for _ in range(20)] + ["日本.com/"]
    got = {r["text"]: r["score"] for r in url_filter.score(spark.createDataFrame([(t,) for t in new], "text string"), url_filter.fit(labelled)).collect()}
    want = brute_scores(texts, new)
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in got)
    pages = [(i, "http://" + t, None) for i, t in enumerate([t for _, t in texts] + new)]
    out = {r["page_id"]: r["verdict"] for r in url_filter.judge(spark.createDataFrame(pages, PAGES)).collect()}
    right = [out[120 + i] == ("allow" if i < 20 else "block") for i in range(40)]
    assert sum(right) >= 36


def test_urls_that_many_pages_have_are_judged_alike_without_broadcast(spark, monkeypatch):
    """One URL and the null one are a third of the rows each; the rest occur once."""
    urls = [f"https://www.{('a.org/fr', 'b.net', 'example.com/de', 'c.io')[i % 4]}/p{i}" for i in range(150)]
    urls += ["https://hot.io/x"] * 75 + ["https://hot.org/fr/x"] * 75 + [None] * 150
    df = spark.createDataFrame([(i if i % 11 else None, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string")
    rows = lambda: sorted(str((*r[:5], round(r["score"], 9))) for r in url_filter.judge(df).collect())  # noqa: E731 (sums differ by their order)
    want = rows()
    assert len(want) == len(urls)
    monkeypatch.setattr(url_filter, "small", lambda x: x)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
