"""Point in time, marts, gate, metrics, sinks and streams on hand-written rows."""

import dataclasses
import datetime as dt
import gzip
import random
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.operators import asof, assertions, classify, deliveries, gate, history, marts, metrics, published, triage
from pricelens.sources import raw, sinks
from pricelens.streaming import ingest

D = dt.date
TS = dt.datetime


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_as_of_is_strict_at_the_cutoff_and_ignores_load_order(spark):
    dates = spark.createDataFrame([(D(2025, 1, 10), TS(2025, 1, 11))], "as_of_date date, knowledge_cutoff timestamp")
    facts = spark.createDataFrame(
        [("a", D(2025, 1, 1), TS(2025, 1, 2), 1), ("a", D(2025, 1, 9), TS(2025, 1, 11), 2), ("a", D(2025, 1, 5), TS(2025, 1, 10, 23), 3), ("b", D(2025, 1, 11), TS(2025, 1, 10), 4), ("c", D(2025, 1, 3), TS(2025, 1, 3), 5), ("c", D(2025, 1, 2), TS(2025, 1, 9), 6)],
        "k string, crawl_date date, delivered_at timestamp, v int",
    )
    for fn in (asof.latest_as_of, asof.latest_by_running_max):
        assert rows(fn(dates, facts, ["k"], ["crawl_date", "delivered_at"], ["v"])) == [(D(2025, 1, 10), "a", 3), (D(2025, 1, 10), "c", 5)]


def test_periods_see_a_price_that_comes_back(spark):
    df = spark.createDataFrame([("o", D(2025, 1, d), p) for d, p in ((1, 10.0), (2, 10.0), (3, 12.0), (4, 10.0), (5, 10.0))], "o string, d date, p double")
    got = [(r["p"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day, r["previous_p"], r["n_observations"], r["is_current_period"]) for r in history.scd2_periods(df, "o", ["d"], "p").orderBy("valid_from").collect()]
    assert got == [(10.0, 1, 3, None, 2, False), (12.0, 3, 4, 10.0, 1, False), (10.0, 4, None, 12.0, 2, True)]
    assert history.change_events(history.scd2_periods(df, "o", ["d"], "p"), "p").count() == 2


def test_scale_outliers(spark):
    df = spark.createDataFrame([(100.0, 100.0), (1000.0, 100.0), (10.5, 100.0), (1300.0, 100.0), (0.0, 100.0), (100.0, 0.0), (None, 1.0)], "v double, r double")
    assert [r[0] for r in df.select(classify.is_scale_outlier(F.col("v"), F.col("r"))).collect()] == [False, True, True, False, False, False, False]


def test_ladder_judges_objects_without_history(spark):
    data = [(f"A_{s}", "A", str(s), D(2025, 1, 1), 100.0 + s) for s in range(9)] + [(f"B_{s}", "B", str(s), D(2025, 1, 1), (100.0 + s) * (150 if s != 4 else 15)) for s in range(9)]
    df = spark.createDataFrame(data, "object_id string, market string, sku string, crawl_date date, price_local double").withColumn("pre_fate", F.lit(None).cast("string"))
    bad = classify.classify(df, "A").filter("fate = 'price_scale_outlier'").collect()
    assert [(r["object_id"], r["reference_method"]) for r in bad] == [("B_4", "price_ladder")]


def test_like_for_like_is_the_mean_of_changes(spark):
    d1, d2 = D(2025, 1, 31), D(2025, 2, 28)
    data = [(d1, "M", "A", "Bags", 100.0), (d2, "M", "A", "Bags", 110.0), (d1, "M", "B", "Bags", 1000.0), (d2, "M", "B", "Bags", 1000.0), (d2, "M", "C", "Bags", 50.0)]
    priced = spark.createDataFrame(data, "as_of_date date, market string, sku string, macro_category string, price_local double").withColumn("price_local", F.col("price_local").cast("decimal(18,2)"))
    r = marts.macro_monthly(priced, spark.createDataFrame([("M", "EUR")], "market string, currency_code string")).filter(F.col("as_of_date") == F.lit(d2)).first()
    assert (r["lfl_n_products"], float(r["lfl_mean_change"]), float(r["lfl_ratio_of_means"]), float(r["lfl_share_increased"]), r["n_products"]) == (2, 0.05, 0.0091, 0.5, 3)


def test_weekly_grid_skips_gaps_and_tells_errors_from_absence(spark):
    days = [D(2025, 1, 6), D(2025, 1, 13), D(2025, 1, 20)]
    dates = spark.createDataFrame([(d,) for d in days], "as_of_date date")
    heroes = spark.createDataFrame([("H1", "S1", "Bag")], "pointer_id string, sku string, product_label string")
    market = spark.createDataFrame([("USA", "USD"), ("JPN", "JPY"), ("FRA", "EUR")], "market string, currency_code string")
    cells = [(days[0], "USA", "S1", "o", D(2025, 1, 5), True, 3090.0, "b0"), (days[1], "USA", "S1", "o", D(2025, 1, 12), False, None, "b1"), (days[2], "USA", "S1", "o", D(2025, 1, 5), True, 3310.0, "b2"), (days[0], "JPN", "S2", "p", D(2025, 1, 5), True, 1.0, "b3"), (days[1], "JPN", "S2", "p", D(2025, 1, 12), True, 1.0, "b4")]
    cat = spark.createDataFrame(cells, "as_of_date date, market string, sku string, object_id string, presence_crawl_date date, has_price boolean, price_local double, presence_batch_id string")
    cat = cat.withColumns({"price_crawl_date": F.col("presence_crawl_date"), "is_price_carried_forward": F.lit(False)})
    errors = spark.createDataFrame([("b4", "S1")], "market_batch_id string, sku string")
    got = {(r["delivery_date"].day, r["market"]): r for r in marts.micro_weekly(dates, heroes, market, cat, errors).collect()}
    assert len(got) == 9
    status = {k: r["price_status"] for k, r in got.items()}
    assert [status[(d, "USA")] for d in (6, 13, 20)] == ["first_delivery", "no_valid_price", "price_increase"]
    assert [status[(d, "JPN")] for d in (6, 13, 20)] == ["not_found", "page_error", "not_found"]
    assert float(got[(20, "USA")]["change_vs_previous_pct"]) == 0.0712 and got[(20, "USA")]["is_stale_crawl"] and status[(6, "FRA")] == "not_found"


def one_check(spark, rules, values, severity="block"):
    check = gate.Check("c", "d", severity, lambda ctx: None, rules, ("micro",))
    df = spark.createDataFrame([("c", "micro", D(2025, 1, i + 1), "all", v) for i, v in enumerate(values)], "check_id string, scope string, as_of_date date, subject string, observed double")
    return [r["status"] for r in gate.evaluate(gate.anomaly(df, [check]), gate.rule_table(spark, [check])).orderBy("as_of_date").collect()]


def test_thresholds_and_anomalies(spark):
    assert one_check(spark, gate.Rules(warn_above=7, fail_above=14), [7.0, 8.0, 14.0, 15.0, None, float("nan")]) == ["pass", "warn", "warn", "fail", "skip", "skip"]
    assert one_check(spark, gate.Rules(warn_below=-0.05, fail_below=-0.2), [0.0, -0.1, -0.3]) == ["pass", "warn", "fail"]
    odd = gate.Rules(anomaly=gate.Anomaly(6, 3, 4, 0.02))
    assert one_check(spark, odd, [0.01, 0.012, 0.9]) == ["pass"] * 3
    assert one_check(spark, odd, [0.01, 0.012, 0.011, 0.4]) == ["pass", "pass", "pass", "warn"]
    assert one_check(spark, odd, [0.0, 0.0, 0.0, 0.019, 0.5]) == ["pass", "pass", "pass", "pass", "warn"]


def test_decisions(spark):
    df = spark.createDataFrame([("a", "fail", "warn"), ("b", "fail", "block"), ("b", "pass", "block"), ("c", "skip", "block"), ("d", "warn", "block")], "scope string, status string, severity string")
    assert dict(rows(gate.decide(df, ["scope"]))) == {"a": "WARN", "b": "BLOCK", "c": "PASS", "d": "WARN"}


def world(spark):
    """Four deliveries, of which the second serves an old state: prices fall there and rise again in the third."""
    days = [D(2025, 1, 7 * i + 1) for i in range(4)]
    cal = gate.delivery_calendar(spark.createDataFrame([("micro", d) for d in days], "scope string, as_of_date date"))
    prices = {0: 100.0, 1: 50.0, 2: 100.0, 3: 100.0}
    cat = spark.createDataFrame([(d, "M", f"o{k}", d, prices[i] + k) for i, d in enumerate(days) for k in range(20)], "as_of_date date, market string, object_id string, served_crawl_date date, price_local double")
    market = spark.createDataFrame([("M", True)], "market string, is_in_micro_scope boolean")
    return days, cal, lambda calendar: gate.Context(calendar, gate.scoped(calendar, cat, market), market)


CHECKS = [c for c in gate.CHECKS if c.id in ("price_decrease_share", "product_count_change", "price_reversion_share")]


def test_audit_compares_with_the_last_accepted_delivery(spark):
    days, cal, context = world(spark)
    folder = tempfile.mkdtemp()
    results, releases = raw.AppendOnlyTable(spark, f"{folder}/results", gate.RESULTS), raw.AppendOnlyTable(spark, f"{folder}/releases", gate.RELEASES)
    run = gate.audit(cal, context, results, releases, CHECKS)
    assert [run.decisions[("micro", d)] for d in days] == ["PASS", "BLOCK", "PASS", "PASS"]
    notes = [r["message"] for r in results.read().filter(F.col("as_of_date") == F.lit(days[2])).collect() if r["status"] != "skip"]
    assert notes and all("(held against 2025-01-01, as these were not accepted: 2025-01-08)" in m for m in notes)
    assert {r["as_of_date"] for r in releases.read().collect()} == {days[0], days[2], days[3]}
    with pytest.raises(ValueError, match="reason"):
        gate.force_release("micro", days[1], " ", results, releases, "me")
    gate.force_release("micro", days[1], "checked by hand", results, releases, "me")
    status = {r["as_of_date"]: (r["decision"], r["is_forced"]) for r in gate.release_status(releases.read()).collect()}
    assert status[days[1]] == ("BLOCK", True) and assertions.blocked_but_published(releases.read()).isEmpty()
    assert gate.pick_targets(cal, releases.read()) == [] and len(gate.pick_targets(cal, releases.read(), every=True)) == 4
    tallies, bad = gate.audit_report(results.read())
    assert tallies.count() == 4 and bad.first()["status"] == "fail"
    health = {r["as_of_date"]: (r["decision"], r["publication_state"]) for r in marts.delivery_health(results.read(), releases.read()).collect()}
    assert health[days[1]] == ("BLOCK", "published_by_force") and health[days[3]][1] == "published"
    causes = triage.distinct_causes(triage.failing_results(results.read()))
    assert {r["cause"] for r in causes.collect()} == {"older_state"}


def judged_one_by_one(days, prices):
    """Each delivery against the last two that were accepted, in order: blocked if a rule of CHECKS fails."""
    accepted, out = [], {}
    for day in days:
        now, one, two = prices[day], prices[accepted[-1]] if accepted else {}, prices[accepted[-2]] if len(accepted) > 1 else {}
        both = [k for k in now if k in one]
        three = [k for k in both if k in two]
        bad = bool(one) and not -0.20 <= len(now) / len(one) - 1
        bad |= bool(both) and sum(now[k] < one[k] for k in both) / len(both) > 0.10
        bad |= bool(three) and sum(now[k] != one[k] and now[k] == two[k] for k in three) / len(three) > 0.05
        out[day] = "BLOCK" if bad else "ok"
        if not bad:
            accepted.append(day)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_audit_of_all_at_once_equals_one_by_one(spark, seed):
    rng = random.Random(seed)
    days = [D(2025, 1, 1) + dt.timedelta(days=7 * i) for i in range(14)]
    prices, level = {}, 100.0
    for d in days:
        kind = rng.choice(["same", "same", "up", "old", "short", "back"])
        level *= 1.05 if kind == "up" else 1
        old = {"old": 0.5, "back": 0.8}.get(kind, 1.0)
        prices[d] = {f"o{k}": round((level + k) * (old if k % 2 else 1.0), 2) for k in range(20 if kind != "short" else 12)}
    cal = gate.delivery_calendar(spark.createDataFrame([("micro", d) for d in days], "scope string, as_of_date date"))
    cat = spark.createDataFrame([(d, "M", k, d, p) for d in days for k, p in prices[d].items()], "as_of_date date, market string, object_id string, served_crawl_date date, price_local double")
    market = spark.createDataFrame([("M", True)], "market string, is_in_micro_scope boolean")
    run = gate.Audit(CHECKS, lambda calendar: gate.Context(calendar, gate.scoped(calendar, cat, market), market))
    run.run(cal, [("micro", d) for d in days], set())
    got = {d: "BLOCK" if v == "BLOCK" else "ok" for (_, d), v in run.decisions.items()}
    assert got == judged_one_by_one(days, prices) and "BLOCK" in got.values()


def test_each_outcome_of_the_policy():
    days, ask = [D(2025, m, 1) for m in (1, 2, 3, 4)], metrics.Request
    shown = lambda *a, **k: metrics.apply_policy(ask(*a, **k), days)
    span = {"start": days[0], "end": days[2]}
    period = lambda r: (r.by_time, r.start, r.end)
    assert period(shown("hero_price")) == period(shown("category_lfl_change")) == (False, days[3], days[3])
    assert period(shown("price_change_count")) == (False, None, None)
    assert period(shown("hero_price", **span)) == (False, days[2], days[2])
    assert period(shown("category_lfl_change", **span)) == (True, days[0], days[2])
    assert period(shown("hero_price_increases", **span)) == (False, days[0], days[2])
    assert period(shown("category_lfl_change", start=days[1])) == (False, days[1], days[1])
    assert period(shown("category_lfl_change", start=D(2025, 1, 20), end=D(2025, 2, 20))) == (False, days[1], days[1])
    assert period(shown("hero_price", by_time=True, **span)) == (True, days[0], days[2])
    assert period(shown("hero_price", by_time=True)) == (True, None, None)
    assert period(shown("hero_price", start=D(2030, 1, 1), end=D(2030, 2, 1))) == (False, D(2030, 1, 1), D(2030, 2, 1))
    assert shown("hero_price").group_by == ("market",)
    assert shown("hero_price", ("delivery_date", "product_label"), filters={"market": ["FRA"]}).group_by == ("product_label",)
    assert shown("hero_price", ("currency_code",), filters={"market": ["FRA"]}).group_by == ()
    assert shown("category_lfl_change", filters={"market": ["FRA", "JPN"], "macro_category": ["BAG"]}).group_by == ("market",)
    usual = {**metrics.METRICS, "m": metrics.Metric("m", "category_monthly", "market_lfl_change", default_group_by=("macro_category", "market"))}
    shown = lambda **k: metrics.apply_policy(ask("m", **k), days, usual).group_by
    assert shown() == ("macro_category", "market") and shown(filters={"market": ["FRA"]}) == ("macro_category",)
    assert shown(filters={"market": ["FRA", "JPN"]}) == ("market",) and shown(by_time=True) == ()


def test_metric_guards_and_policy(spark):
    known = spark.createDataFrame([("market", "FRA"), ("market", "JPN"), ("delivery_date", "2025-01-01"), ("delivery_date", "2025-01-08")], "dimension string, value string")
    ask = metrics.Request
    metrics.check_request(ask("hero_price", ("market",)), known)
    metrics.check_request(ask("hero_price", filters={"market": ["FRA"]}), known)
    for bad in (
        ask("hero_price"), ask("hero_price", filters={"market": ["FRA", "JPN"]}), ask("hero_price_change", filters={"market": ["ATL"]}), ask("hero_price_change", ("macro_category",)),
        ask("lfl_weighted_numerator"), ask("nothing"), ask("hero_price_change", filters={"market": []}), ask("hero_price_change", start=D(2030, 1, 1), end=D(2030, 2, 1)), ask("hero_price_change", start=D(2025, 2, 1), end=D(2025, 1, 1)),
    ):
        with pytest.raises(metrics.Refused):
            metrics.check_request(bad, known)
    days = [D(2025, 1, 1), D(2025, 1, 8)]
    latest = metrics.apply_policy(ask("hero_price"), days)
    assert latest.group_by == ("market",) and latest.start == latest.end == days[1]
    assert metrics.apply_policy(ask("hero_price", start=days[0], end=days[1]), days).start == days[1]
    assert metrics.apply_policy(ask("hero_price_change", start=days[0], end=days[1]), days).by_time
    assert metrics.apply_policy(ask("hero_price", ("currency_code",), filters={"pointer_id": ["a", "b"]}), days).group_by == ("market", "pointer_id")


def test_ratio_metric_without_denominator_is_null(spark):
    df = spark.createDataFrame([(D(2025, 1, 1), "M", "Bags", None, 0)], "report_month date, market string, macro_category string, lfl_mean_change double, lfl_n_products int")
    assert metrics.query_metric(df, metrics.Request("category_lfl_change_product_weighted")).first()[0] is None


def test_published_and_contracts(spark):
    rel = spark.createDataFrame([("micro", D(2025, 1, 8))], "scope string, as_of_date date")
    df = spark.createDataFrame([(D(2025, 1, 1), 1), (D(2025, 1, 8), 2), (D(2025, 1, 9), 3)], "d date, v int")
    assert [r["v"] for r in published.only_released(df, "d", rel, "micro").collect()] == [2]
    assert [r["v"] for r in published.until_released(df, "d", rel).collect()] == [1]
    assert published.until_released(df, "d", rel.limit(0)).isEmpty()
    published.enforce_contract(df, T.StructType.fromDDL("v int, d date"))
    with pytest.raises(ValueError, match="v: int, not bigint"):
        published.enforce_contract(df, T.StructType.fromDDL("v bigint, d date"))


def test_snapshot_cells_masks_and_refusals(spark):
    df = spark.createDataFrame([(1, D(2025, 1, 2), True, ["a", "b"], "seen https://x.y/z")], "i int, d date, b boolean, a array<string>, s string").withColumn("p", F.lit("1250.50").cast("decimal(18,2)")).withColumn("q", F.lit("100.00").cast("decimal(18,2)"))
    r = sinks.format_cells(df).first()
    assert (r["i"], r["d"], r["b"], r["a"], r["p"], r["q"]) == ("1", "2025-01-02", "true", "a; b", "1250.5", "100")
    assert sinks.mask_columns(df, {"s": ("https://\\S+", "#")}).first()["s"] == "seen #"
    with pytest.raises(ValueError, match="secret"):
        sinks.assert_public(["a", "secret"], ["a"])
    rel = spark.createDataFrame([(D(2025, 1, 2),)], "as_of_date date")
    sinks.assert_released(df, "d", rel)
    with pytest.raises(ValueError):
        sinks.assert_released(df, "d", rel.limit(0))
    one, two = sinks.snapshot_manifest({"t": df}).first(), sinks.snapshot_manifest({"t": df.union(df)}).first()
    assert one["n_rows"] == 1 and one["checksum"] != two["checksum"]
    assert [r["side"] for r in sinks.diff_snapshot(df.union(df).drop("a"), df.drop("a")).collect()] == ["now"]
    folder = tempfile.mkdtemp()
    sinks.export_snapshot({"t": df}, {"t": ["i"]}, folder, {"s": ("https://\\S+", "#")})
    assert spark.read.csv(f"{folder}/t", header=True).first()["s"] == "seen #"


def test_upserts_give_the_full_refresh(spark):
    src = spark.createDataFrame([(i, TS(2025, 1, 1) + dt.timedelta(days=i), i * 10) for i in range(100)], "k int, t timestamp, v int")
    target = src.filter("k < 60").withColumn("v", F.when(F.col("k") > 50, -1).otherwise(F.col("v")))
    assert rows(sinks.upsert_incremental(target, src, "k", "t", 35)) == rows(src)
    assert rows(sinks.upsert_incremental(target.limit(0), src, "k", "t", 35)) == rows(src)


def test_an_upsert_leaves_other_rows_alone_and_breaks_ties(spark):
    target = spark.createDataFrame([(i, 1, "old") for i in range(50)], "k int, t int, v string")
    changes = spark.createDataFrame([(3, 2, "b"), (3, 2, "c"), (3, 1, "z"), (77, 1, "new")], "k int, t int, v string")
    out = sinks.upsert(target, changes, "k", ["t"])
    assert rows(out.filter("v <> 'old'")) == [(3, 2, "c"), (77, 1, "new")] and out.count() == 51
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan


def test_check_definitions_are_validated():
    ok = gate.Check("c", "d", "block", lambda ctx: None, gate.Rules(warn_above=1.0), ("micro",))
    for bad in ({"severity": "loud"}, {"scopes": ("daily",)}, {"rules": gate.Rules()}, {"rules": {"macro": gate.Rules(warn_above=1.0)}}, {"severity": "warn", "rules": gate.Rules(fail_above=1.0)}, {"datasets": ("other",)}):
        with pytest.raises(ValueError):
            dataclasses.replace(ok, **bad)
    with pytest.raises(ValueError, match="same id"):
        gate.catalogue_of([ok, ok])
    assert [c.id for c in gate.catalogue_of(gate.CHECKS, "legacy_replay")] == [c.id for c in gate.CHECKS[:6]]


def test_findings(spark):
    df = spark.createDataFrame([("micro", D(2025, 1, 1), c, s, x, f"{x}: {c}") for c, s, x in (("served_crawl_age_days", "warn", "A"), ("product_count_change", "fail", "A"), ("product_count_change", "warn", "B"), ("hero_large_moves", "warn", "all"), ("market_coverage", "pass", "all"))], "scope string, as_of_date date, check_id string, status string, subject string, message string")
    got = {r["check_id"]: (r["title"], r["status"], r["n_subjects"], r["detail"]) for r in triage.explain_any(df).collect()}
    assert got["product_count_change"] == ("Product count change", "fail", 2, "A: product_count_change; B: product_count_change") and len(got) == 3
    causes = {r["cause"]: (r["check_id"], r["n_subjects"], r["is_failure"]) for r in triage.distinct_causes(triage.failing_results(df)).collect()}
    assert causes == {"missing_crawl": ("served_crawl_age_days", 2, True), "hero_large_moves": ("hero_large_moves", 1, False)}


def files(folder, names):
    for n in names:
        with gzip.open(f"{folder}/{n}", "wt") as f:
            f.write('{"a":1}\n{"a":2}\n')


def test_files_are_picked_up_once(spark):
    folder, out = tempfile.mkdtemp(), tempfile.mkdtemp()
    bronze = raw.AppendOnlyTable(spark, f"{out}/bronze", raw.BRONZE)
    files(folder, ["a.ndjson.gz"])
    for want in (2, 2):
        raw.ingest_new_files(spark, folder, bronze)
        assert bronze.read().count() == want
    files(folder, ["a (1).ndjson.gz"])
    raw.ingest_new_files(spark, folder, bronze)
    assert bronze.read().count() == 4 and not hasattr(bronze, "overwrite")
    with pytest.raises(ValueError):
        bronze.append(spark.range(1))
    for want in (4, 4):
        ingest.ingest_available(spark, folder, f"{out}/stream", f"{out}/check").awaitTermination()
        assert spark.read.parquet(f"{out}/stream").count() == want


def test_reference_files(spark):
    folder = Path(tempfile.mkdtemp())
    (folder / "k.csv").write_text('a,b\n1,"x ""y""\nz"\n2,\n')
    assert rows(raw.read_reference_csv(spark, str(folder / "k.csv")).na.fill("-")) == [("1", 'x "y"\nz'), ("2", "-")]
    (folder / "s.csv").write_text("a,b\n1,x\n2,\n")
    assert rows(raw.read_seed(spark, str(folder / "s.csv"), "a int, b string").na.fill("-")) == [(1, "x"), (2, "-")]


def test_data_tests_and_verdicts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    assert assertions.not_unique(df, "k").count() == 1 and assertions.nulls(df, "k").count() == 1 and assertions.not_accepted(df, "v", ["a", "b"]).count() == 1
    assert assertions.out_of_range(df, "k", 2).count() == 2 and assertions.unequal_rowcount(df, df).isEmpty() and not assertions.unequal_rowcount(df, df.limit(1)).isEmpty()
    assert assertions.verdict(df) == "error" and assertions.verdict(df, 0, None) == "warn" and assertions.verdict(df.limit(0)) == "pass"
    assert assertions.not_projected(df, df.filter("v <> 'b'").withColumn("k", F.lit(None).cast("int")), ["v"], "k").count() == 2
    counts = lambda n: spark.createDataFrame([("f",)] * n, "source_file_name string")
    assert assertions.lost_rows(counts(3), counts(2), counts(1)).isEmpty() and assertions.lost_rows(counts(3), counts(2), counts(0)).count() == 1


def test_stale_and_carried_explanations(spark):
    scoped = spark.createDataFrame([(D(2025, 1, 20), "M", D(2025, 1, 5))], "as_of_date date, market string, served_crawl_date date")
    found = spark.createDataFrame([(D(2025, 1, 20), "M"), (D(2025, 1, 20), "N")], "as_of_date date, subject string")
    f = spark.createDataFrame([("f1", D(2025, 1, 12), D(2025, 1, 12), ["M"], [], False, False), ("f2", D(2025, 1, 19), D(2025, 1, 19), [], ["M"], False, False)], "delivered_file_name string, content_crawl_date date, file_crawl_date date, missing_markets array<string>, partial_markets array<string>, is_stale_content boolean, is_duplicate_content boolean")
    got = {(r["market"], r["delivered_file_name"]): r["problem"] for r in triage.explain_stale(scoped, f, found).collect()}
    assert got == {("M", "f1"): triage.LOST, ("M", "f2"): triage.PARTIAL, ("N", triage.NO_FILE): "-"}
    old = triage.explain_stale(scoped, f.withColumn("is_stale_content", F.lit(True)).withColumn("missing_markets", F.array().cast("array<string>")), found, replay=True)
    assert {(r["market"], r["delivered_file_name"]): r["problem"] for r in old.collect()} == {("M", "f1"): triage.OLD, ("M", "f2"): triage.PARTIAL, ("N", "f1"): triage.OLD, ("N", "f2"): triage.OLD}
    micro = spark.createDataFrame([(D(2025, 1, 20), "H", "M", "S", 1.0, D(2025, 1, 5), D(2025, 1, 19), True)], "delivery_date date, pointer_id string, market string, sku string, price_local double, price_crawl_date date, crawl_date_used date, is_price_carried_forward boolean")
    q = spark.createDataFrame([("S", "M", D(2025, 1, 19), ["price_on_request"], "x")], "sku string, market string, file_crawl_date date, quarantine_reasons array<string>, original_price_raw string")
    assert triage.explain_carried(micro, q).first()["reasons"] == "price_on_request"


def test_file_status_ladder(spark):
    df = spark.createDataFrame([(True, False, [], []), (False, True, [], []), (False, False, ["x"], []), (False, False, [], ["y"]), (False, None, [], [])], "is_duplicate_content boolean, is_stale_content boolean, missing_markets array<string>, partial_markets array<string>")
    assert [(r["file_status"], r["is_trusted"]) for r in deliveries.file_status(df).collect()] == [("block", False), ("block", False), ("warn", True), ("warn", True), ("ok", True)]
