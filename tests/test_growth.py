"""Steps that must not grow faster than their input give what the plain ones give."""

import datetime as dt
import math
import random
from decimal import Decimal as D

from pyspark.sql import functions as F

from pricelens.config import CrawlConfig
from pricelens.functions.issues import collect_issues
from pricelens.operators import asof, classify, gate, history, marts, quality, staging


def test_identity_before_the_parse_equals_the_steps_after_it(spark):
    line = '{"objectID":"%s","source":"Brand_FRA","market":%s,"skus":%s,"name":"%s"}'
    texts = [line % x for x in (("Brand_FRA_A1", "null", '["a 1"]', "x"), ("other", '"FRA"', '["A1"]', "y"), ("Brand_FRA_B2", '"FRA"', "[]", "x"), ("Brand_FRA_B2", '"FRA"', "[]", "x"))]
    rows = [(t, f, dt.datetime(2024, 1, 1 + i)) for i, t in enumerate([*texts, "no json"]) for f in ("BrandIntl_2024-01-01_x.gz", "a%20b+c.gz")]
    bronze = spark.createDataFrame(rows, "raw_line string, source_file_name string, loaded_at timestamp")
    one = staging.with_identity(bronze, CrawlConfig())
    parsed = staging.resolve_sku(staging.resolve_market(staging.parse_lines(staging.with_line_id(bronze)))).withColumn("object_id", staging.object_key(CrawlConfig()))
    two = staging.flag_conflicting_duplicates(parsed)
    cols = ["source_file_name", "raw_line", "loaded_at", "identical_line_ordinal", "crawl_line_id", "has_conflicting_duplicate"]
    assert sorted(one.select(cols).collect()) == sorted(two.select(cols).collect())
    shuffles = staging.stage_observations(bronze)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles == 1


def test_only_periods_that_overlap_are_expanded(spark):
    calendar = asof.Calendar([[0, 1, 2, 3]], [[1, 2, 3, 4]])
    rows = [("a", 0, 0, 2), ("a", 0, 2, 4), ("b", 0, 0, 4), ("b", 0, 1, 2), ("b", 0, 2, 3), ("c", 0, 1, 2), ("c", 0, 1, 2)]
    periods = spark.createDataFrame(rows, "object_id string, chain int, start int, end int")
    assert sorted(tuple(r) for r in asof.overlapping(calendar, periods).collect()) == rows[2:]


def test_served_batches_need_no_objects(spark):
    day = dt.date(2024, 1, 1)
    at = dt.datetime(2024, 1, 2)
    batches = spark.createDataFrame([("m1", "A", day, at, "x", True), ("m2", "B", day, at, "x", True)], "market_batch_id string, market string, crawl_date date, delivered_at timestamp, crawl_scope string, is_eligible boolean")
    pages = spark.createDataFrame([("m1", "o", "s", "accepted", False), ("m2", "p", "s", "accepted", True)], "market_batch_id string, object_id string, sku string, fate string, is_not_a_product_page boolean")
    dates = spark.createDataFrame([(dt.date(2024, 1, 3), dt.datetime(2024, 1, 4))], "as_of_date date, knowledge_cutoff timestamp")
    calendar = asof.Calendar.of(dates)
    prices = pages.limit(0).select("object_id", "market_batch_id", F.lit(day).alias("crawl_date"), F.lit(at).alias("delivered_at"), F.lit(1).alias("price_local"), F.lit("E").alias("currency_code"))
    cols = ["market", "presence_batch_id", "presence_crawl_date", "start", "end"]
    served = asof.served_periods(calendar, batches, pages).select(cols).collect()
    assert served == asof.catalogue_periods(calendar, batches, pages, prices).select(cols).distinct().collect()
    assert [r["market"] for r in served] == ["A"]


def test_places_by_table_equal_those_by_search(spark, monkeypatch):
    cuts = [-3 * asof.DAY_MICROS + 5, -asof.DAY_MICROS, 7, 4 * asof.DAY_MICROS, 6 * asof.DAY_MICROS - 1]
    days = [-3, -1, 0, 4, 5]
    spots = sorted({c + d for c in cuts for d in (-1, 0, 1, asof.DAY_MICROS, -asof.DAY_MICROS)} | {-(10**15), 10**15})
    at = spark.createDataFrame([(x,) for x in spots], "x bigint")
    table = [r[0] for r in at.orderBy("x").select(asof._below(cuts, F.col("x"), "bigint")).collect()]
    assert table == [sum(c < x for c in cuts) for x in spots]
    plan = at.select(asof._below(cuts, F.col("x"), "bigint"))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    near = spark.createDataFrame([(x,) for x in range(-6, 9)], "x int")
    assert [r[0] for r in near.orderBy("x").select(asof._below(days, F.col("x"), "int")).collect()] == [sum(d < x for d in days) for x in range(-6, 9)]
    monkeypatch.setattr(asof, "TABLE_STEPS", 0)
    assert [r[0] for r in at.orderBy("x").select(asof._below(cuts, F.col("x"), "bigint")).collect()] == table


def test_the_monthly_table_from_running_sums_counts_every_product(spark):
    calendar = asof.Calendar([list(range(19753, 19753 + 31 * 4, 31))], [[1, 2, 3, 4]])
    rows = [(f"o{i}", 0, 0, 4, "A", D(10), "M") for i in range(50)] + [("p", 0, 0, 1, "A", D(10), "M"), ("p", 0, 1, 3, "A", D(12), "M"), ("q", 0, 2, 4, "A", None, "M")]
    periods = spark.createDataFrame(rows, "object_id string, chain int, start int, end int, market string, price_local decimal(18,2), macro_category string")
    markets = spark.createDataFrame([("A", "EUR")], "market string, currency_code string")
    out = marts.macro_monthly_of_periods(calendar, periods, markets).orderBy("as_of_date").collect()
    assert [(r["n_products"], r["lfl_n_products"], r["min_price"], r["max_price"], r["lfl_share_increased"]) for r in out] == [
        (51, 0, 10, 10, None), (51, 51, 10, 12, D("0.0196")), (52, 51, 10, 12, 0), (51, 50, 10, 10, 0)
    ]
    assert [r["lfl_mean_change"] for r in out] == [None, D("0.0039"), 0, 0]


def test_staging_by_columns_equals_the_whole(spark):
    line = '{"objectID":"%s","source":"Brand_FRA","market":%s,"skus":%s,"name":"%s","productDetails":[{"key":"color","value":"bÃ©"},{"key":"color","value":"red"}],"categories":["bÃ©"]}'
    texts = [line % x for x in (("Brand_FRA_A1", "null", '["a 1"]', "x"), ("other", '"FRA"', '["A1"]', "y"), ("Brand_FRA_B2", '"FRA"', "[]", "x"), ("Brand_FRA_B2", '"FRA"', "[]", "x"))]
    rows = [(t, f, dt.datetime(2024, 1, 1 + i)) for i, t in enumerate([*texts, "no json"]) for f in ("BrandIntl_2024-01-01_x.gz", "a%20b+c.gz")]
    bronze = spark.createDataFrame(rows, "raw_line string, source_file_name string, loaded_at timestamp")
    some = ["crawl_line_id", "object_id", "file_crawl_date", "price_local", "product_name_normalized", "dq_issues", "dq_status"]
    few = staging.stage_columns(bronze, some)
    assert sorted(map(str, few.collect())) == sorted(map(str, staging.stage_observations(bronze).select(some).collect()))
    assert staging.stage_columns(bronze, ["dq_status"])._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_bases_need_no_rows_by_object_and_case(spark):
    """Forty bases of one delivery cost no more shuffled rows than one, and count what the catalogue holds."""
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(42)]
    rows = [("macro", "M", f"o{k}", 0, 42, D(k), days[0]) for k in range(50)] + [("macro", "M", "p", i, i + 1, D(1 + i % 2), days[0]) for i in range(0, 42, 3)]
    stretches = spark.createDataFrame(rows, "scope string, market string, object_id string, first int, past int, price_local decimal(18,2), served_crawl_date date")
    ask = lambda n: spark.createDataFrame([(i, "macro", days[41], days[i], days[max(0, i - 1)]) for i in range(n)], "case int, scope string, as_of_date date, prev_date date, prev2_date date")
    shelves, sizes = gate.shelves_of(stretches).cache(), gate.by_market_of_stretches([[], days], stretches).select("scope", "as_of_date", "market", "n", "age_days").cache()
    got = {r["case"]: (r["n"], r["n_before"], r["n1"], r["changed"], r["n2"]) for r in gate.by_market_of_shelves([[], days], shelves, sizes, ask(41)).collect()}
    assert got == {i: (50, 50 + (i % 3 == 0), 50, 0, 50) for i in range(41)}
    plan = gate.by_market_of_shelves([[], days], shelves, sizes, ask(41))._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.split("\n") if "Aggregate [" in x and "object_id" in x.split("]")[0] and "InMemory" not in x]


def test_changed_readings_are_the_starts_of_periods(spark):
    day = lambda i: dt.date(2024, 1, i)
    rows = [("a", day(i), i, p) for i, p in enumerate([1, 1, 2, 2, None, 2, 3, 1, 1], 1)] + [("b", day(1), 1, 5), ("b", day(1), 2, 6), ("c", day(3), 1, None), ("c", day(4), 1, 4)]
    df = spark.createDataFrame(rows, "object_id string, crawl_date date, line_id int, price int")
    columns = ["price_period_id", "object_id", "price", "previous_price", "change_vs_previous", "valid_from", "direction"]
    events = lambda of: history.change_events(of, "price").select(columns)
    got = events(history.changed_readings(df, "object_id", ["crawl_date", "line_id"], "price"))
    want = events(history.scd2_periods(df, "object_id", ["crawl_date", "line_id"], "price"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 5
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_fired_rules_equal_the_whole_and_compare_no_lines(spark):
    """Each rule alone, from its own fields, fires on the lines on which it does among all; only rules that compare lines shuffle."""
    from tests.test_staging import CASES, line, staged

    texts = [x for x, _ in CASES] + [line(price={"original_price": x}) for x in ("Price upon request", "From 1,250", None)] + [line(market=None, source=None), "no json", "{}", None]
    bronze = staged(spark, texts)
    whole = [(r["source_file_name"], r["object_id_raw"], set(r["dq_issues"])) for r in staging.stage_observations(bronze).collect()]
    alone = [*staging.RULE_FIELDS, "price_on_request", "price_from_or_range"]
    assert set(alone) == {i for *_, issues in whole for i in issues} - {"category_mojibake", "price_unparseable", *staging.COMPARED}
    shown = lambda rows: sorted(repr((f, o, sorted(i))) for f, o, i in rows)
    for some in [*([r] for r in alone), alone, ["name_missing", "category_mojibake", "price_unparseable", *staging.COMPARED]]:
        got = staging.fired_rules(bronze, some, ["source_file_name", "object_id_raw"])
        assert shown(map(tuple, got.collect())) == shown((f, o, i & set(some)) for f, o, i in whole), some
        assert ("Exchange" in got._jdf.queryExecution().executedPlan().toString()) == (not set(some) <= set(alone))


def test_a_rule_is_evaluated_once_a_line(spark):
    plan = spark.createDataFrame([("a", "b")], "x string, y string").select(collect_issues({"one": F.col("x").rlike("p+"), "two": F.col("y").rlike("q+")}).alias("i"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 2
    assert plan.first()["i"] == []


def test_planted_defects_are_graded_by_one_sum(spark):
    """Codes that share a rule, unknown codes, lines without an object, repeated lines and whole files; equal lines are put together before
    the shuffle, and no lines are joined or sorted."""
    rows = [("f", "1", "o", "A", "fix"), ("f", "2", "o", "A", "fix"), ("f", "3", "p", "A", "fix"), ("f", "1", "o", "B", "warn"), ("f", "4", None, "A", "fix"), ("f", "5", "o", "?", "fix"), ("f", "6", "q", "D", "fix"), ("g", None, None, "F", "block")]
    manifest = spark.createDataFrame(rows, "file_name string, line_number string, object_id string, defect_code string, expected_handling string")
    manifest = manifest.withColumns({"field": F.lit("x"), "clean_value": F.lit("a"), "dirty_value": F.lit("b")})
    seen = [("f", "o", ["url_missing", "name_missing"]), ("f", "o", ["url_missing"]), ("f", None, ["url_missing"]), ("g", "p", ["url_missing"]), ("f", "q", ["url_missing"])]
    obs = spark.createDataFrame(seen, "file_name string, object_id_raw string, dq_issues array<string>")
    files = spark.createDataFrame([("g", True, False, [], [])], "file_name string, is_duplicate_content boolean, is_stale_content boolean, partial_markets array<string>, missing_markets array<string>")
    out = quality.grade(manifest, obs, files, {"A": "url_missing", "B": "url_missing", "D": "name_missing", "E": "name_missing", "F": "file:duplicate_content"})
    got = {tuple(r) for r in out.collect()}
    assert got == {
        ("A", "url_missing", "fix", "warn", 4, 2, 0.5, False), ("B", "url_missing", "warn", "warn", 1, 1, 1.0, True), ("?", None, "fix", None, 1, 0, 0.0, None),
        ("D", "name_missing", "fix", "quarantine", 1, 0, 0.0, False), ("F", "file:duplicate_content", "block", "block", 1, 1, 1.0, True),
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.split("\n") if "Join" in x and "object_id" in x]
    assert quality.grade(manifest, obs, files, {}).count() == 5


def test_readings_are_judged_without_joining_them_to_their_medians(spark):
    """A large object, ties, prices of nothing, and missing keys, skus, days and markets, against sorting by hand; no reading is joined by a shuffle."""
    rng = random.Random(7)
    pick = lambda *xs: rng.choice(xs)
    rows = [(i, pick("A", "A", "B", "C", None), pick("1", "2", "3", None), pick(1, 2, 3, None), pick(10.0, 10.0, 11.0, 100.0, 1.0, 0.0, None), pick(None, None, None, "blocked")) for i in range(400)]
    rows = [(i, f"{m}_{s}_{rng.randrange(6)}" if m and s else None, m, s, d and dt.date(2024, 1, d), p and p * {"B": 3, "C": 50}.get(m, 1), f) for i, m, s, d, p, f in rows]
    rows += [(400 + i, "big", "A", "4", dt.date(2024, 1, 1), float(1 + i * 37 % 5000), None) for i in range(5000)]
    df = spark.createDataFrame(rows, "line_id int, object_id string, market string, sku string, crawl_date date, price_local double, pre_fate string")
    out = classify.classify(df, "A")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan

    def medians(pairs):
        groups = {}
        for k, v in pairs:
            groups.setdefault(k, []).append(v)
        return {k: (sorted(v)[(len(v) - 1) // 2], len(v)) for k, v in groups.items()}

    def odd(v, r):
        ratio = math.log10(v / r) if v and r else 0
        return abs(round(ratio)) >= 1 and abs(ratio - round(ratio)) < 0.1

    usable = [r for r in rows if r[6] is None and r[5]]
    usual = medians((r[1], r[5]) for r in usable if r[1])
    own = lambda r: usual.get(r[1], (None, None))
    anchors = medians(((r[3], r[4]), r[5]) for r in usable if r[2] == "A" and r[3] and r[4] and not ((own(r)[1] or 0) >= 3 and odd(r[5], own(r)[0])))
    anchor = lambda r: anchors.get((r[3], r[4]), (None, 0))[0]
    factor = medians((r[2], r[5] / anchor(r)) for r in usable if r[2] and anchor(r))
    want = []
    for r in rows:
        u, n = own(r)
        ladder = anchor(r) * factor[r[2]][0] if anchor(r) and r[2] in factor else None
        ref, how = (u, "history") if (n or 0) >= 3 else (ladder, "price_ladder" if ladder is not None else None)
        bad = ref is not None and r[5] is not None and odd(r[5], ref)
        want.append((r[0], u, n, anchor(r), how, ref and round(ref, 2), r[6] or ("price_scale_outlier" if bad else "accepted")))
    got = out.select("line_id", "usual_value", "n_candidates", "anchor_price", "reference_method", "reference_price_local", "fate").orderBy("line_id").collect()
    assert [tuple(r) for r in got] == want
