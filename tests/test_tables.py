"""Tables that are appended to or upserted: broken, repeated and concurrent runs."""

import hashlib
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pricelens.sources import raw
from pricelens.sources.buckets import BucketedTable
from pricelens.sources.commits import CommitLog
from pricelens.streaming import ingest

SCHEMA = "k int, t int, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def contents(folder):
    return {str(p): hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(folder).rglob("*.parquet")}


def test_an_entry_is_added_once(spark):
    log = CommitLog(spark, tempfile.mkdtemp())
    assert log.names() == [] and log.add("a/b c", {"x": 1}) and not log.add("a/b c", {"x": 2})
    assert log.read("a/b c") == {"x": 1} and log.names() == ["a/b c"] and log.has("a/b c") and not log.has("a")
    assert not any(p.name.endswith(".draft") for p in Path(log.folder).iterdir())


def ledger(spark):
    return raw.AppendOnlyTable(spark, tempfile.mkdtemp(), spark.createDataFrame([], SCHEMA).schema)


def test_a_repeated_append_adds_its_rows_once(spark):
    t, df = ledger(spark), spark.createDataFrame([(1, 1, "a"), (1, 1, "a")], SCHEMA)
    assert t.read().count() == 0
    assert t.append(df, "r1") and not t.append(df, "r1") and t.append(df, "r2") and t.append(df)
    assert t.read().count() == 6 and len(t.runs()) == 3


def test_a_broken_append_adds_nothing_and_can_be_tried_again(spark, monkeypatch):
    t, df = ledger(spark), spark.createDataFrame([(1, 1, "a")], SCHEMA)
    bad = df.withColumn("v", F.expr("raise_error('lost')").cast("string"))
    with pytest.raises(Exception, match="lost"):
        t.append(bad, "r1")
    assert t.read().count() == 0
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "add", lambda *a: (_ for _ in ()).throw(RuntimeError("died before the commit")))
        with pytest.raises(RuntimeError):
            t.append(df, "r1")
    assert contents(t.path) and t.read().count() == 0
    assert t.append(df, "r1") and rows(t.read()) == [(1, 1, "a")]


def test_of_two_attempts_at_once_one_counts(spark, monkeypatch):
    t, df = ledger(spark), spark.createDataFrame([(1, 1, "a")], SCHEMA)
    first = CommitLog.add

    def slow(log, name, entry):
        monkeypatch.setattr(CommitLog, "add", first)
        assert t.append(df, "r1")  # the other attempt, while this one has written its rows
        return first(log, name, entry)

    monkeypatch.setattr(CommitLog, "add", slow)
    assert not t.append(df, "r1") and t.read().count() == 1
    assert len({Path(p).parent for p in contents(t.path)}) == 1


def test_an_upsert_rewrites_touched_buckets_alone(spark):
    t = BucketedTable(spark, tempfile.mkdtemp(), "k", SCHEMA, 16)
    assert t.read().count() == 0
    start = spark.createDataFrame([(i, 1, "old") for i in range(200)] + [(None, 1, "none")], SCHEMA)
    assert len(t.upsert(start, ["t"], "load")) == 16
    before, kept = contents(t.path), t.version()[1]["buckets"]
    touched = t.upsert(spark.createDataFrame([(3, 2, "b"), (3, 2, "c"), (3, 1, "z"), (777, 0, "new"), (None, 0, "null")], SCHEMA), ["t"], "r1")
    assert 1 <= len(touched) <= 3
    assert rows(t.read().filter("v <> 'old' and k is not null")) == [(3, 2, "c"), (777, 0, "new")]
    assert [r["v"] for r in t.read().filter("k is null").collect()] == ["null"] and t.read().count() == 202
    now = t.version()[1]["buckets"]
    assert {b for b in now if now[b] != kept[b]} == {str(b) for b in touched}
    after = contents(t.path)
    assert {p: h for p, h in after.items() if p in before} == before


def test_repeated_broken_and_rival_upserts(spark, monkeypatch):
    t = BucketedTable(spark, tempfile.mkdtemp(), "k", SCHEMA, 4)
    df = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    t.upsert(df((1, 5, "a"), (2, 5, "b")), ["t"], "r1")
    assert t.upsert(df((1, 9, "again")), ["t"], "r1") == []
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "add", lambda *a: (_ for _ in ()).throw(RuntimeError("died before the commit")))
        with pytest.raises(RuntimeError):
            t.upsert(df((1, 9, "lost")), ["t"], "r2")
    assert rows(t.read()) == [(1, 5, "a"), (2, 5, "b")]
    t.upsert(df((1, 4, "late"), (2, 6, "newer")), ["t"], "r2", rivals=True)
    assert rows(t.read()) == [(1, 5, "a"), (2, 6, "newer")]
    t.upsert(df((1, 4, "late")), ["t"], "r3")
    assert rows(t.read()) == [(1, 4, "late"), (2, 6, "newer")]
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "add", lambda *a: False)
        with pytest.raises(RuntimeError, match="another run"):
            t.upsert(df((7, 7, "x")), ["t"], "r4")
    assert len(t.log.names()) == 2 and t.read().count() == 2
    with pytest.raises(ValueError, match="4 buckets"):
        BucketedTable(spark, t.path, "k", SCHEMA, 8).upsert(df((1, 1, "x")), ["t"])


def test_stream_upserts_count_each_batch_once(spark):
    folder = tempfile.mkdtemp()
    schema = "k int, t int, v int"
    read = lambda: spark.readStream.schema(schema).parquet(f"{folder}/in")
    t = BucketedTable(spark, f"{folder}/t", "k", schema, 8)
    batches = [[(1, 5, 1), (2, 5, 2), (1, 4, 0)], [(2, 6, 5), (3, 1, 3), (1, 2, 9)], [(3, 1, 4)]]
    want = [[(1, 5, 1), (2, 5, 2)], [(1, 5, 1), (2, 6, 5), (3, 1, 3)], [(1, 5, 1), (2, 6, 5), (3, 1, 4)]]
    for batch, after in zip(batches, want, strict=True):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(f"{folder}/in")
        before = contents(f"{folder}/t")
        ingest.upsert_stream(read(), t, "t", f"{folder}/c").awaitTermination()
        assert rows(t.read()) == after
        now = contents(f"{folder}/t")
        assert all(now[p] == h for p, h in before.items() if p in now)
    number, entry = t.version()
    assert entry["streams"] == {"stream": number - 1}
    assert t.upsert(spark.createDataFrame([(1, 99, 99)], schema), ["t"], stream=("stream", number - 1)) == []
