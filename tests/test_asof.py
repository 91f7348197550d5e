"""As-of staircases, catalogue periods and the gate's counts from them, against the definitions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pricelens.operators import asof, gate
from pricelens.operators.medians import lower_median
from tests.test_operators import CHECKS, judged_one_by_one

D = dt.date
START = D(2025, 1, 1)
FACT = "k string, crawl_date date, delivered_at timestamp, v int"


def day(n):
    return START + dt.timedelta(days=n)


def moment(hours):
    return dt.datetime(2025, 1, 1) + dt.timedelta(hours=hours)


def world(rng, n_facts, n_dates, lag):
    facts = [(rng.choice("abc"), day(rng.randrange(40)), moment(rng.randrange(40 * 24)), i) for i in range(n_facts)]
    facts += [("a", None, moment(3), -1), ("b", day(3), None, -2), *facts[:2]]
    pairs = sorted({(day(d), moment(lag(rng, d))) for d in (rng.randrange(45) for _ in range(n_dates))})
    return facts, pairs


LAGS = {
    "midnight": lambda rng, d: (d + 1) * 24,
    "fixed hours": lambda rng, d: d * 24 + 31,
    "any": lambda rng, d: rng.randrange(45 * 24),
    "three lags": lambda rng, d: (d + rng.choice((1, 8, 31))) * 24,
}


@pytest.mark.parametrize("lag", LAGS)
def test_any_cutoff_gives_the_latest_visible_fact(spark, lag):
    rng = random.Random(lag)
    facts, pairs = world(rng, 120, 40, LAGS[lag])
    want = []
    for d, c in pairs:
        for k in "abc":
            seen = [f for f in facts if f[0] == k and f[1] is not None and f[2] is not None and f[1] <= d and f[2] < c]
            if seen:
                best = max(seen, key=lambda f: (f[1], f[2], f[3]))
                want.append((d, k, best[1], best[3]))
    df, dates = spark.createDataFrame(facts, FACT), spark.createDataFrame(pairs, "as_of_date date, knowledge_cutoff timestamp")
    got = asof.latest_as_of(dates, df, ["k"], ["crawl_date", "delivered_at", "v"], ["crawl_date", "v"])
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    if lag == "midnight":
        assert len(asof.Calendar.of(dates).days) == 1


def test_staircases_are_as_few_as_lags(spark):
    pairs = [(day(d), moment((d + n) * 24)) for d in range(0, 60, 7) for n in (1, 8, 31)]
    calendar = asof.Calendar.of(spark.createDataFrame(pairs, "as_of_date date, knowledge_cutoff timestamp"))
    assert len(calendar.days) <= 3 and sum(map(len, calendar.days)) == len(pairs)
    for days, cuts in zip(calendar.days, calendar.cuts, strict=True):
        assert days == sorted(days) and cuts == sorted(cuts)
    nobody = asof.Calendar.of(spark.createDataFrame([], "as_of_date date, knowledge_cutoff timestamp"))
    facts = spark.createDataFrame([("a", day(1), moment(5), 1)], FACT)
    assert asof.known_periods(nobody, facts, ["k"], ["crawl_date"], ["v"]).count() == 0


def test_facts_that_are_beaten_before_the_next_date_leave_no_period(spark):
    dates = spark.createDataFrame([(day(10), moment(11 * 24)), (day(20), moment(21 * 24))], "as_of_date date, knowledge_cutoff timestamp")
    calendar = asof.Calendar.of(dates)
    facts = spark.createDataFrame([("a", day(i), moment(i * 24 + 1), i) for i in range(20)], FACT)
    periods = asof.known_periods(calendar, facts, ["k"], ["crawl_date", "delivered_at"], ["v"])
    assert sorted((r["start"], r["end"], r["v"]) for r in periods.collect()) == [(0, 1, 10), (1, 2, 19)]


@pytest.mark.parametrize("seed", [1, 2])
def test_catalogue_periods_expand_to_the_catalogue(spark, seed):
    """Against the definition, date by date: the latest eligible batch of a market, its objects, and each one's latest known price."""
    rng = random.Random(seed)
    batches, lines = [], []
    for i in range(25):
        market, crawl, late = rng.choice("MN"), rng.randrange(30), rng.randrange(1, 200)
        batches.append((f"b{i}", market, day(crawl), moment(crawl * 24 + late), "extended", rng.random() < 0.8))
        for o in rng.sample(range(6), rng.randrange(1, 6)):
            fate = rng.choice(["accepted", "accepted", "quarantined_in_staging", "exact_duplicate"])
            lines.append((f"b{i}", f"{market}{o}", f"s{o}", day(crawl), moment(crawl * 24 + late), fate, rng.random() < 0.1, float(rng.randrange(3)), "EUR", i))
    days = sorted({rng.randrange(35) for _ in range(14)})
    dates = spark.createDataFrame([(day(d), d % 2 == 0, d % 2 == 1, moment(d * 24 + 24)) for d in days], "as_of_date date, is_micro_date boolean, is_macro_date boolean, knowledge_cutoff timestamp")
    b = spark.createDataFrame(batches, "market_batch_id string, market string, crawl_date date, delivered_at timestamp, crawl_scope string, is_eligible boolean")
    c = spark.createDataFrame(lines, "market_batch_id string, object_id string, sku string, crawl_date date, delivered_at timestamp, fate string, is_not_a_product_page boolean, price_local double, currency_code string, line_id int")
    want = []
    for d in days:
        for market in "MN":
            chosen = max(((x[2], x[3], x[0]) for x in batches if x[1] == market and x[5] and x[2] <= day(d) and x[3] < moment(d * 24 + 24)), default=None)
            if chosen is None:
                continue
            for o, sku in sorted({(x[1], x[2]) for x in lines if x[0] == chosen[2] and x[5] != "exact_duplicate" and not x[6]}):
                known = max(((x[3], x[4], x[7], x[0]) for x in lines if x[1] == o and x[5] == "accepted" and x[3] <= day(d) and x[4] < moment(d * 24 + 24)), default=None)
                want.append((day(d), o, sku, chosen[2], (day(d) - chosen[0]).days, known and known[2], known and known[0], bool(known and known[0] < chosen[0])))
    accepted = c.filter("fate = 'accepted'")
    got = asof.catalogue_as_of(dates, b, c, accepted)
    cells = got.select("as_of_date", "object_id", "sku", "presence_batch_id", "presence_age_days", "price_local", "price_crawl_date", "is_price_carried_forward")
    assert sorted(map(str, (tuple(r) for r in cells.collect()))) == sorted(map(str, want))

    # The gate's counts from periods are those from rows.
    market = spark.createDataFrame([("M", True), ("N", False)], "market string, is_in_micro_scope boolean")
    deliveries = gate.delivery_calendar(dates.select(F.explode(F.when(F.col("is_micro_date"), F.array(F.lit("micro"))).otherwise(F.array(F.lit("macro"), F.lit("micro")))).alias("scope"), "as_of_date"))
    rows = gate.scoped(deliveries, got.withColumnRenamed("presence_crawl_date", "served_crawl_date"), market)
    calendar = asof.Calendar.of(dates)
    listed = gate.dates_of(deliveries)
    stretches = gate.stretches_of_periods(calendar, listed, asof.catalogue_periods(calendar, b, c, accepted), market)
    columns = ["scope", "as_of_date", "prev_date", "market", "n", "age_days", "n1", "changed", "fallen", "n2", "reverted", "n_before"]
    plain = lambda df: sorted(str(tuple(r)) for r in df.select(*columns).collect())
    assert plain(gate.by_market_of_stretches(listed, stretches)) == plain(gate.by_market(rows))

    # Held against the calendar's own bases, one by one, they are the same again.
    bases = deliveries.filter("prev_date is not null").withColumn("case", F.row_number().over(gate.Window.orderBy("scope", "as_of_date")))
    bases = bases.select("case", "scope", "as_of_date", "prev_date", "prev2_date")
    one_by_one = gate.by_market_against(listed, stretches, bases)
    assert plain(one_by_one) == plain(gate.by_market(rows).filter("prev_date is not null"))
    assert plain(gate.by_market_against(listed, gate.stretches_of_rows(listed, rows), bases)) == plain(one_by_one)


@pytest.mark.parametrize("pattern", ["ab" * 12, "aabb" * 6, "a" + "b" * 20 + "aaa", "abbabbbabbbbab"])
def test_audits_take_few_jobs_whatever_the_verdicts(spark, pattern):
    """Deliveries of two price levels in any order: b is far below a, so it is blocked, and a after b is held against the last a."""
    days = [day(7 * i) for i in range(len(pattern))]
    prices = {d: {f"o{k}": (100.0 if x == "a" else 50.0) + k for k in range(10)} for d, x in zip(days, pattern, strict=True)}
    cal = gate.delivery_calendar(spark.createDataFrame([("micro", d) for d in days], "scope string, as_of_date date"))
    cat = spark.createDataFrame([(d, "M", k, d, p) for d in days for k, p in prices[d].items()], "as_of_date date, market string, object_id string, served_crawl_date date, price_local double")
    market = spark.createDataFrame([("M", True)], "market string, is_in_micro_scope boolean")
    run = gate.Audit(CHECKS, lambda calendar: gate.Context(calendar, gate.scoped(calendar, cat, market), market))
    run.run(cal, [("micro", d) for d in days], set())
    got = {d: "BLOCK" if v == "BLOCK" else "ok" for (_, d), v in run.decisions.items()}
    assert got == judged_one_by_one(days, prices)
    assert [got[d] == "ok" for d in days] == [x == "a" for x in pattern]
    assert run.jobs <= 6


def test_anomalies_learn_from_the_last_accepted_values_only(spark):
    rng = random.Random(9)
    n = 10_000
    values = [rng.choice([None, 0.01, 0.02, 0.011, 0.5 if rng.random() < 0.1 else 0.015]) for _ in range(n)]
    accepted = [i for i in range(n) if rng.random() < 0.6]
    df = spark.createDataFrame([("c", "micro", day(i), "all", v) for i, v in enumerate(values)], "check_id string, scope string, as_of_date date, subject string, observed double")
    check = gate.Check("c", "plausibility", "warn", lambda ctx: df, gate.Rules(anomaly=gate.Anomaly(6, 3, 4, 0.02)), ("micro",))
    known = spark.createDataFrame([("micro", day(i)) for i in accepted], "scope string, as_of_date date")
    got = {r["as_of_date"]: (r["is_anomaly"], r["usual"]) for r in gate.anomaly(df, [check], known).collect()}
    chosen, past = set(accepted), []
    for i, v in enumerate(values):
        w = past[-6:]
        mean = sum(w) / len(w) if w else None
        spread = (sum((x - mean) ** 2 for x in w) / len(w)) ** 0.5 if w else 0
        odd = len(w) >= 3 and v is not None and v > mean + 4 * max(spread, 0.005) + 1e-12 and v > 0.02
        assert got[day(i)][0] == odd and got[day(i)][1] == (None if mean is None else pytest.approx(mean))
        if i in chosen and v is not None:
            past.append(v)


@pytest.mark.parametrize("kind", ["decimal(18,2)", "double"])
def test_medians_are_exact_for_groups_of_any_size(spark, kind):
    """A group of a million different values, a skewed one, ties, negative values and nulls, against sorting."""
    n = 1_000_003
    rng = random.Random(4)
    small = [("s", rng.choice([None, -5.0, -0.01, 0.0, 0.01, 3.0, 1e9])) for _ in range(500)] + [(None, 1.0), (None, 7.0), ("none", None), ("one", 42.0), ("t", 2.0), ("t", 2.0), ("t", 9.0)]
    big = spark.range(n).select(F.lit("big").alias("g"), ((F.col("id") * 7919) % n / 100).cast(kind).alias("v"))
    df = big.unionByName(spark.createDataFrame(small, "g string, v double").withColumn("v", F.col("v").cast(kind)))
    got = {r["g"]: (float(r["m"]), r["n"]) for r in lower_median(df, ["g"], "v", "m", "n").collect()}
    want = {}
    for g in {g for g, _ in small}:
        held = sorted(v for x, v in small if x == g and v is not None)
        if held:
            want[g] = (held[(len(held) - 1) // 2], len(held))
    assert got.pop("big") == (((n - 1) // 2) / 100, n)
    assert got == want
