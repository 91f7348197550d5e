"""Rules from a table against trying each; drift by buckets against comparing all rows; spans and days in blocks."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from pricelens.operators import rules, triage
from pricelens.sources import sinks


@pytest.mark.parametrize(
    "pattern, want",
    [
        ("(^|[^a-z])(steel|copper)([^a-z]|$)", {"steel", "copper"}), ("brushed steel", {"brushed steel"}), ("ab+cde", {"cde"}), ("(abc)?", None), ("(abc)+x", {"abc"}), ("abc|de", None), ("a.b", None),
        ("", None), ("(?i)steel", None), (r"\bsteel\b", {"steel"}), ("(?=steel)x", None), ("[", None), ("abc{0,2}", None), ("abcd{2}", {"abc"}), (r"(abc)\1", {"abc"}), ("x|(abc|abd)", None), ("Brand#[12]", {"Brand#"}),
    ],
)
def test_literals_that_a_pattern_needs(pattern, want):
    assert rules.needed_literals(pattern) == want


def test_many_rules_equal_trying_each(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6))) for _ in range(600)})
    rows = [(i, f"s{rng.randrange(400)}", " ".join(rng.choice(words) for _ in range(rng.randint(0, 6))), rng.choice(["B1", "B2", None])) for i in range(400)] + [(900, "s1", None, None), (901, None, "", "B1")]
    shapes = [lambda: rng.choice(words), lambda: f"(^| )({rng.choice(words)}|{rng.choice(words)})( |$)", lambda: f"{rng.choice(words)}.*{rng.choice(words)}", lambda: f"^{rng.choice(words)}", lambda: f"({rng.choice(words)})? {rng.choice(words)}$"]
    table = []
    for i in range(10_000):
        field = rng.choice(["name"] * 8 + ["sku", "brand"])
        pattern = f"s{rng.randrange(5000)}" if field == "sku" else f"B[{rng.randrange(3, 9)}]" if field == "brand" else rng.choice(shapes)()
        table.append((f"R{i:05d}", rng.randrange(2000), field, pattern, f"c{i % 7}"))
    table += [("R2", 3000, "brand", "B2", "last"), ("R3", 1, "nofield", "x", "c"), ("R4", 1, "name", None, "c")]
    df = spark.createDataFrame(rows, "id int, sku string, name string, brand string")
    ruled = spark.createDataFrame(table, "rule_id string, priority int, match_field string, pattern string, category string")
    got = {r["id"]: (r["categorized_by_rule"], r["categorized_on"], r["rule_category"]) for r in rules.apply_rule_table(df, ruled, "id").collect()}
    order = sorted((r for r in table if r[3] is not None), key=lambda r: (r[1], r[0]))
    compiled = [(r, None if r[2] == "sku" else re.compile(r[3])) for r in order]
    for i, sku, name, brand in rows:
        cell = {"sku": sku, "name": name, "brand": brand}
        hit = next((r for r, p in compiled if cell.get(r[2]) is not None and (cell["sku"] == r[3] if p is None else p.search(cell[r[2]]))), None)
        assert got[i] == ((hit[0], hit[2], hit[4]) if hit else (None, None, None))
    assert len(got) == len(rows)
    assert rules.apply_rule_table(df, ruled.limit(0), "id").filter("categorized_by_rule is not null").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_drift_by_buckets_equals_comparing_all(spark, seed):
    rng = random.Random(seed)
    cell = lambda: (rng.randrange(40), rng.choice([None, "a", "b"]), rng.choice([None, 0.0, -0.0, 1.5, float("nan")]), rng.choice([None, "a"]))
    schema = "k int, a string, x double, b string"
    then = [cell() for _ in range(400)]
    now = then[:]
    for _ in range(6):
        now.pop(rng.randrange(len(now)))
        now.append(rng.choice([cell(), now[0]]))
    a, b = spark.createDataFrame(now, schema), spark.createDataFrame(then, schema)
    plain = a.exceptAll(b).withColumn("side", F.lit("now")).union(b.exceptAll(a).withColumn("side", F.lit("then")))
    got = sinks.diff_snapshot(a, b, 64)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and len(sinks.drifted_buckets(a, b, 64)) <= 12
    rng.shuffle(then)
    same = sinks.diff_snapshot(spark.createDataFrame(then, schema).repartition(3), b)
    assert same.columns == got.columns and "Exchange" not in same._jdf.queryExecution().executedPlan().toString() and same.count() == 0
    swapped = spark.createDataFrame([(1, None, 1.0, "a")], schema), spark.createDataFrame([(1, "a", 1.0, None)], schema)
    assert sinks.diff_snapshot(*swapped).count() == 2


def test_stale_evidence_by_blocks_of_days_equals_every_pair(spark):
    rng = random.Random(5)
    day = lambda n: dt.date(2025, 1, 1) + dt.timedelta(days=n)
    files = [(f"f{i}", rng.choice([None, day(rng.randrange(120))]), rng.choice([None, day(rng.randrange(120))]), rng.sample(["M", "N", "O"], rng.randrange(3)), rng.sample(["M", "N"], rng.randrange(2))) for i in range(80)]
    found = [(day(rng.randrange(120)), rng.choice("MNO")) for _ in range(40)]
    scoped = [(d, m, day(rng.randrange(90))) for d, m in found if rng.random() < 0.7]
    f = spark.createDataFrame(files, "delivered_file_name string, content_crawl_date date, file_crawl_date date, missing_markets array<string>, partial_markets array<string>")
    s = spark.createDataFrame(scoped, "as_of_date date, market string, served_crawl_date date")
    got = {(r["as_of_date"], r["market"], r["delivered_file_name"], r["problem"]) for r in triage.explain_stale(s, f, spark.createDataFrame(found, "as_of_date date, subject string")).collect()}
    want = set()
    for d, m in set(found):
        served = max((x[2] for x in scoped if x[:2] == (d, m)), default=None)
        since, own = served or d - dt.timedelta(days=30), set()
        for name, content, claimed, missing, partial in files:
            near = (content is not None and since < content <= d) or (claimed is not None and d - dt.timedelta(days=10) < claimed <= d)
            if near and m in missing + partial:
                own.add((d, m, name, triage.LOST if m in missing else triage.PARTIAL))
        want |= own or {(d, m, triage.NO_FILE, "-")}
    assert got == want
