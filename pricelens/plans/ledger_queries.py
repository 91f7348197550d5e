"""Ledgers, audits, evidence and data tests, over the marts as built from the given tables; violations are planted where a test would find none."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from pricelens.operators import assertions, classify, gate, marts, published, reports, triage
from pricelens.plans import adapters as a
from pricelens.plans import catalog
from pricelens.plans.adapters import sql
from pricelens.plans.catalog import _JUDGED, _RELEASES
from pricelens.sources.raw import AppendOnlyTable
from pricelens.sources.tables import materialise, shared_folder

QUERIES, SQL = {}, {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            SQL[fn.__name__] = sql(oracle)
        return fn

    return add


def _folder(spark, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


# ---- facts and reference tables ---------------------------------------------------------------------------------------------


@query("SELECT line_id, market_batch_id, object_id, sku, market, crawl_date, delivered_at, price_local, currency_code FROM accepted")
def observation_facts(spark, sf):
    return marts.fct_observations(classify.accepted(a.classified(spark, sf)), ("line_id", "market_batch_id", "object_id", "sku", "market", "crawl_date", "delivered_at", "price_local", "currency_code"))


@query("SELECT line_id, sku, market, fate, is_not_a_product_page FROM classified")
def reading_fates(spark, sf):
    """The fate of every reading by its batch and its issues."""
    return a.classified(spark, sf).select("line_id", "sku", "market", "fate", "is_not_a_product_page")


@query("SELECT catalogue_row_id, as_of_date, market, object_id, sku, presence_crawl_date, presence_age_days, price_local, currency_code, price_crawl_date, has_price, is_price_carried_forward FROM catalogue")
def catalogue_facts(spark, sf):
    return marts.fct_catalogue(catalog._catalogue(spark, sf))


@query("SELECT market, currency_code, is_in_micro_scope FROM markets")
def published_markets(spark, sf):
    return published.reference(marts.dim_market(a.markets(spark, sf))).select("market", "currency_code", "is_in_micro_scope")


@query("SELECT sku, category AS category_code, category <> 'UNCATEGORIZED' AS is_in_macro_scope, sku IN (SELECT sku FROM pointers) AS is_hero FROM products")
def published_products(spark, sf):
    return published.reference(catalog.dim_product(spark, sf))


# ---- audits and releases --------------------------------------------------------------------------------------------------------


_BESIDE = """
  LEFT JOIN shelf x ON (x.scope, x.k) = (n.scope, n.k) LEFT JOIN shelf y ON (y.scope, y.k, y.object_id) = (n.scope, n.b1, x.object_id)
  LEFT JOIN shelf z ON (z.scope, z.k, z.object_id) = (n.scope, n.b2, x.object_id) AND y.p IS NOT NULL LEFT JOIN sizes s ON (s.scope, s.k, s.market) = (n.scope, n.b1, x.market)"""
_SHARES = """count(x.object_id)::DOUBLE / any_value(s.n) - 1 AS product_count_change, count(*) FILTER (x.p <> y.p AND x.p = z.p)::DOUBLE / nullif(count(x.p + z.p), 0) AS price_reversion_share,
  count(*) FILTER (x.p < y.p)::DOUBLE / nullif(count(x.p + y.p), 0) AS price_decrease_share"""
_COMPARED = "('product_count_change', 'price_reversion_share', 'price_decrease_share', 'price_change_share_anomaly')"
# One delivery after the other: what it is held against are the last two before it that weren't blocked (0: none).
_AUDITED = catalog._SCOPED.replace("WITH cal2", "WITH RECURSIVE cal2", 1) + f""",
sizes AS (SELECT scope, k, market, count(*) AS n FROM shelf GROUP BY ALL),
rl AS ({catalog._rules_sql()}),
fixed AS (SELECT c.scope, c.k, coalesce(bool_or(severity = 'block' AND (observed > fa OR observed < fb)), false) AS fixed
  FROM cal2 c LEFT JOIN m ON (m.scope, m.as_of_date) = (c.scope, c.as_of_date) AND check_id NOT IN {_COMPARED} LEFT JOIN rl ON (rl.check_id, rl.scope) = (m.check_id, m.scope) GROUP BY c.scope, c.k),
audit(scope, k, b1, b2, blocked) AS (
  SELECT scope, 0::BIGINT, 0::BIGINT, 0::BIGINT, true FROM (VALUES ('micro'), ('macro')) v(scope) UNION ALL
  SELECT scope, k, b1, b2, any_value(fixed) OR coalesce(bool_or(product_count_change < -0.20 OR price_reversion_share > 0.05 OR price_decrease_share > 0.10), false) FROM (
    SELECT n.scope, n.k, n.b1, n.b2, any_value(n.fixed) AS fixed, {_SHARES}
    FROM (SELECT a.scope, f.k, CASE WHEN blocked THEN b1 ELSE a.k END AS b1, CASE WHEN blocked THEN b2 ELSE b1 END AS b2, f.fixed FROM audit a JOIN fixed f ON f.scope = a.scope AND f.k = a.k + 1) n {_BESIDE}
    GROUP BY n.scope, n.k, n.b1, n.b2, x.market) GROUP BY scope, k, b1, b2),
held AS (SELECT check_id, scope, as_of_date, subject, observed FROM m WHERE check_id NOT IN {_COMPARED}
  UNION ALL SELECT check_id, scope, as_of_date, market, observed FROM (
    SELECT n.scope, any_value(x.as_of_date) AS as_of_date, x.market, {_SHARES} FROM audit n {_BESIDE} WHERE x.market IS NOT NULL GROUP BY n.scope, n.k, x.market)
  UNPIVOT (observed FOR check_id IN (product_count_change, price_reversion_share, price_decrease_share))
  UNION ALL SELECT 'price_change_share_anomaly', n.scope, x.as_of_date, 'all', count(*) FILTER (x.p <> y.p)::DOUBLE / nullif(count(x.p + y.p), 0) FROM audit n {_BESIDE} WHERE x.market IS NOT NULL GROUP BY n.scope, x.as_of_date),
passed AS (SELECT scope, as_of_date FROM audit JOIN cal2 USING (scope, k) WHERE NOT blocked),
learnt AS (SELECT h.check_id, h.scope, h.as_of_date, list(p.observed ORDER BY p.as_of_date DESC)[1:6] AS w
  FROM held h JOIN (SELECT * FROM m JOIN passed USING (scope, as_of_date) WHERE observed IS NOT NULL) p ON (p.check_id, p.scope, p.subject) = (h.check_id, h.scope, h.subject) AND p.as_of_date < h.as_of_date
  WHERE h.check_id = 'price_change_share_anomaly' GROUP BY ALL),
status AS (SELECT scope, as_of_date, severity, coalesce(observed > fa, false) OR coalesce(observed < fb, false) AS failed, coalesce(observed > wa, false) OR coalesce(observed < wb, false)
    OR coalesce(len(w) >= mh AND observed > list_avg(w) + z * greatest(list_stddev_pop(w), 0.005) AND observed > mv, false) AS warned
  FROM held JOIN rl USING (check_id, scope) LEFT JOIN learnt USING (check_id, scope, as_of_date))"""


@query(
    f"""SELECT * FROM ({_AUDITED} SELECT scope, as_of_date, decision, decision <> 'BLOCK' AS is_released FROM (SELECT c.scope, c.as_of_date, CASE WHEN bool_or(failed AND severity = 'block') THEN 'BLOCK' WHEN bool_or(failed OR warned) THEN 'WARN' ELSE 'PASS' END AS decision
FROM cal2 c LEFT JOIN status USING (scope, as_of_date) GROUP BY c.scope, c.as_of_date))"""
)
def audited_deliveries(spark, sf):
    """An audit of all deliveries that aren't released, each against the last ones that were accepted, and what it releases."""
    calendar, context = catalog._context(spark, sf, audit=True)
    folder = _folder(spark, "ledgers")
    results, releases = AppendOnlyTable(spark, f"{folder}/results", gate.RESULTS), AppendOnlyTable(spark, f"{folder}/releases", gate.RELEASES)
    gate.audit(calendar, context, results, releases)
    judged = gate.decide(results.read())
    out = judged.join(gate.release_status(releases.read()).select("scope", "as_of_date", F.col("decision").alias("released_as")), ["scope", "as_of_date"], "left")
    return out.select("scope", "as_of_date", "decision", F.col("released_as").isNotNull().alias("is_released"))


@query(
    f"""SELECT * FROM ({_RELEASES}, twice AS (SELECT scope, as_of_date, decision, is_forced, released_at FROM rel UNION ALL SELECT scope, as_of_date, 'WARN', false, released_at + INTERVAL 1 DAY FROM rel WHERE day(as_of_date) > 20)
SELECT scope, as_of_date, arg_max(decision, released_at) = 'WARN' AS is_warned, bool_or(is_forced) AS is_forced, max(released_at) AS released_at FROM twice GROUP BY scope, as_of_date)"""
)
def release_states(spark, sf):
    """The state of deliveries of which some were released twice, from an append-only ledger."""
    ledger = AppendOnlyTable(spark, _folder(spark, "releases"), gate.RELEASES)
    base = catalog._releases(spark, sf).withColumns({"run_id": F.lit("r"), "reason": F.lit(None).cast("string"), "released_by": F.lit("gate")})
    ledger.append(base)
    again = base.filter(F.dayofmonth("as_of_date") > 20)
    ledger.append(again.withColumns({"release_id": F.concat("release_id", F.lit("-2")), "decision": F.lit("WARN"), "is_forced": F.lit(False), "released_at": F.col("released_at") + F.expr("interval 1 day")}))
    out = gate.release_status(ledger.read())
    return out.select("scope", "as_of_date", (F.col("decision") == "WARN").alias("is_warned"), "is_forced", "released_at")


@query(f"SELECT * FROM ({_RELEASES} SELECT scope, as_of_date FROM (SELECT 'micro' AS scope, as_of_date FROM dates WHERE is_micro_date UNION ALL SELECT 'macro', as_of_date FROM dates WHERE is_macro_date) ANTI JOIN rel USING (scope, as_of_date))")
def audit_targets(spark, sf):
    """Deliveries that the next audit judges: those that aren't released."""
    days = catalog.as_of_dates(spark, sf)
    calendar = days.filter("is_micro_date").select(F.lit("micro").alias("scope"), "as_of_date").union(days.filter("is_macro_date").select(F.lit("macro").alias("scope"), "as_of_date"))
    return spark.createDataFrame(gate.pick_targets(calendar, catalog._releases(spark, sf)), "scope string, as_of_date date")


@query(f"SELECT * FROM ({_JUDGED} SELECT 'macro' AS scope, min(as_of_date) AS as_of_date, 'BLOCK' AS decision, true AS is_forced, 'the market confirms it' AS reason, 'editor' AS released_by FROM j WHERE scope = 'macro' AND status = 'fail' AND severity = 'block')")
def forced_releases(spark, sf):
    """The first blocked month is released by hand, with a reason, after its audit."""
    folder = _folder(spark, "ledgers")
    results, releases = AppendOnlyTable(spark, f"{folder}/results", gate.RESULTS), AppendOnlyTable(spark, f"{folder}/releases", gate.RELEASES)
    gate.append_results(results, catalog._judged(spark, sf), "r1", "marts", dt.datetime(2020, 1, 1))
    blocked = gate.decide(results.read()).filter("scope = 'macro' and decision = 'BLOCK'").agg(F.min("as_of_date")).first()[0]
    if blocked is not None:
        gate.force_release("macro", blocked, "the market confirms it", results, releases, "editor")
    return releases.read().select("scope", "as_of_date", "decision", "is_forced", "reason", "released_by")


@query(f"SELECT * FROM ({_JUDGED} SELECT run_id, count(*) AS n FROM j, (VALUES ('r1'), ('r2')) v(run_id) WHERE run_id = 'r2' OR status = 'fail' GROUP BY run_id)")
def ledger_runs(spark, sf):
    """Two runs appended to the ledger of results; nothing that was there is changed."""
    ledger = AppendOnlyTable(spark, _folder(spark, "results"), gate.RESULTS)
    judged = materialise(catalog._judged(spark, sf), "judged")
    gate.append_results(ledger, judged.filter("status = 'fail'"), "r1", "marts", dt.datetime(2020, 1, 1))
    gate.append_results(ledger, judged, "r2", "marts", dt.datetime(2020, 1, 2))
    return ledger.read().groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))


# ---- evidence -------------------------------------------------------------------------------------------------------------------

_HEALTH = f"""{_JUDGED}, h AS (SELECT scope, as_of_date, CASE WHEN bool_or(status = 'fail' AND severity = 'block') THEN 'BLOCK' WHEN bool_or(status IN ('warn', 'fail')) THEN 'WARN' ELSE 'PASS' END AS decision FROM j GROUP BY ALL)"""


@query(f"SELECT * FROM ({_HEALTH} SELECT scope, as_of_date, decision FROM h WHERE decision <> 'PASS')")
def deliveries_to_review(spark, sf):
    return triage.to_review(catalog._health(spark, sf)).select("scope", "as_of_date", "decision")


@query(f"SELECT * FROM ({_HEALTH} SELECT 'marts' AS dataset, scope, count(*) FILTER (decision = 'PASS') AS n_pass, count(*) FILTER (decision = 'WARN') AS n_warn, count(*) FILTER (decision = 'BLOCK') AS n_block FROM h GROUP BY scope)")
def decision_tallies(spark, sf):
    return reports.decision_tallies(catalog._health(spark, sf))


@query(
    f"""SELECT * FROM ({_JUDGED} SELECT scope, as_of_date, check_id, upper(check_id[1]) || replace(check_id[2:], '_', ' ') AS title, CASE WHEN bool_or(status = 'fail') THEN 'fail' ELSE 'warn' END AS status,
count(DISTINCT subject) AS n_subjects, array_to_string(list_sort(list(DISTINCT message)), '; ') AS detail FROM j WHERE status IN ('warn', 'fail') GROUP BY scope, as_of_date, check_id)"""
)
def findings(spark, sf):
    """A finding for every check that doesn't pass."""
    return triage.explain_any(catalog._judged(spark, sf))


@query(
    f"""SELECT * FROM ({_JUDGED}, f AS (SELECT *, CASE WHEN check_id IN ('served_crawl_age_days', 'hero_stale_share', 'product_count_change') THEN 'missing_crawl' WHEN check_id IN ('price_reversion_share', 'price_decrease_share') THEN 'older_state' ELSE check_id END AS cause,
list_position(['served_crawl_age_days', 'hero_stale_share', 'product_count_change', 'price_reversion_share', 'price_decrease_share'], check_id) AS r FROM j WHERE status IN ('warn', 'fail'))
SELECT scope, as_of_date, cause, arg_min(check_id, coalesce(r, 0)) AS check_id, count(DISTINCT subject) AS n_subjects, bool_or(status = 'fail') AS is_failure FROM f GROUP BY scope, as_of_date, cause)"""
)
def finding_causes(spark, sf):
    return triage.distinct_causes(triage.failing_results(catalog._judged(spark, sf)))


@query(
    f"""SELECT * FROM ({_JUDGED}, late AS (SELECT DISTINCT as_of_date, subject AS market FROM j WHERE check_id = 'served_crawl_age_days' AND status IN ('warn', 'fail')),
got AS (SELECT as_of_date, market, max(served) AS crawl_served FROM shelf GROUP BY ALL),
bad AS (SELECT DISTINCT market, strftime(first_day, 'crawl_%Y-%m') AS delivered_file_name, lo AS content_crawl_date, first_day AS file_crawl_date FROM (SELECT market, crawl_date, n, date_trunc('month', crawl_date)::DATE AS first_day, min(crawl_date) OVER (PARTITION BY date_trunc('month', crawl_date)) AS lo FROM batches) WHERE n % 7 = 0),
hit AS (SELECT late.as_of_date, late.market, crawl_served, delivered_file_name, content_crawl_date, 'has too few pages of this market' AS problem FROM late LEFT JOIN got USING (as_of_date, market) JOIN bad USING (market)
  WHERE (content_crawl_date > coalesce(crawl_served, late.as_of_date - 30) AND content_crawl_date <= late.as_of_date) OR (file_crawl_date > late.as_of_date - 10 AND file_crawl_date <= late.as_of_date))
FROM hit UNION ALL SELECT late.as_of_date, late.market, crawl_served, 'none that is newer', NULL, '-' FROM late LEFT JOIN got USING (as_of_date, market) WHERE (late.as_of_date, late.market) NOT IN (SELECT (as_of_date, market) FROM hit))"""
)
def stale_evidence(spark, sf):
    """Newer files behind markets that were found stale; a file is a month of all markets, some of which it has in part only."""
    made = catalog._readings(spark, sf)
    b = made[1]
    none = F.array().cast("array<string>")
    files = b.groupBy("source_file_name").agg(F.min("crawl_date").alias("content_crawl_date"), F.collect_set(F.when(F.col("is_partial"), F.col("market"))).alias("partial_markets"))
    files = files.withColumns({"delivered_file_name": F.col("source_file_name"), "file_crawl_date": F.trunc("content_crawl_date", "MM"), "missing_markets": none, "is_stale_content": F.lit(False), "is_duplicate_content": F.lit(False)})
    judged, served = catalog._judged_ages(spark, sf, made)
    return triage.explain_stale(served, files, judged.filter("check_id = 'served_crawl_age_days' and status in ('warn', 'fail')"))


@query(
    """SELECT delivery_date, pointer_id, market, sku, price_local, price_crawl_date, crawl_date_used, coalesce(reasons, 'no rejected reading') AS reasons, reasons IS NOT NULL AS is_explained
FROM (SELECT * FROM micro WHERE is_price_carried_forward) LEFT JOIN (
  SELECT c.sku, c.market, b.crawl_date AS crawl_date_used, min(CASE WHEN order_id % 41 = 0 AND order_id % 53 = 0 THEN 'price_on_request, http_error_or_invalid' WHEN order_id % 41 = 0 THEN 'price_on_request' ELSE 'http_error_or_invalid' END) AS reasons
  FROM classified c JOIN batches b USING (market_batch_id) WHERE is_quarantined GROUP BY ALL) USING (sku, market, crawl_date_used)"""
)
def carried_evidence(spark, sf):
    """Cells of the grid that show an older price, and why the newer reading was rejected."""
    obs = a.observations(spark, sf).filter("dq_status = 'quarantine'")
    crawl = a.batches(spark, sf).select("market_batch_id", F.col("crawl_date").alias("file_crawl_date"))
    reasons = F.array_intersect("dq_issues", F.array(*map(F.lit, ("price_on_request", "http_error_or_invalid"))))
    rejected = obs.join(crawl, "market_batch_id").withColumns({"quarantine_reasons": reasons, "original_price_raw": F.lit("?")})
    out = triage.explain_carried(catalog._micro(spark, sf), rejected)
    return out.select("delivery_date", "pointer_id", "market", "sku", "price_local", "price_crawl_date", "crawl_date_used", "reasons", F.col("original_price_raw").isNotNull().alias("is_explained"))


# ---- data tests with planted violations -----------------------------------------------------------------------------------------


@query("SELECT delivery_date, pointer_id, market, price_local + 1 AS _a, price_local AS _b FROM micro WHERE market = 'AFRICA' AND price_local IS NOT NULL AND day(delivery_date) = 5 UNION ALL SELECT delivery_date, pointer_id, market, NULL, price_local FROM micro WHERE pointer_id LIKE '%1' AND market = 'EUROPE'")
def cells_not_projected(spark, sf):
    """Prices of the grid against the catalogue's own; a fifth of a month is one too high in Africa, products whose id ends in 1 are lost in Europe."""
    made = catalog._readings(spark, sf)
    cat = catalog._watched(spark, sf, made)[2]
    grid = materialise(catalog._micro(spark, sf, None, made), "micro").select("delivery_date", "pointer_id", "market", "sku", "price_local")
    wrong = (F.col("market") == "AFRICA") & (F.dayofmonth("delivery_date") == 5)
    planted = grid.withColumn("price_local", F.when(wrong, F.col("price_local") + 1).otherwise(F.col("price_local"))).filter("not (pointer_id like '%1' and market = 'EUROPE')")
    cells = grid.drop("price_local").join(cat.select(F.col("as_of_date").alias("delivery_date"), "market", "sku", "price_local"), ["delivery_date", "market", "sku"], "left")
    return assertions.not_projected(planted, cells, ["delivery_date", "pointer_id", "market"], "price_local")


@query("SELECT as_of_date, market, presence_crawl_date AS expected_crawl_date FROM chosen WHERE market = 'ASIA' OR day(as_of_date) = 31")
def not_latest_eligible_planted(spark, sf):
    """A catalogue that lost a market and that serves month ends a crawl one day younger."""
    made = catalog._readings(spark, sf)
    served = catalog._catalogue(spark, sf, made).filter("market <> 'ASIA'").withColumn("presence_crawl_date", F.expr("date_add(presence_crawl_date, int(dayofmonth(as_of_date) = 31))"))
    dates = catalog.as_of_dates(spark, sf)
    full = materialise(served, "served")
    out = assertions.not_latest_eligible(full, dates, made[1])
    return out.select("as_of_date", "market", "expected_crawl_date")


@query("SELECT catalogue_row_id FROM catalogue JOIN batches ON presence_batch_id = market_batch_id WHERE (n + 1) % 7 = 0 OR day(as_of_date) = 28 AND crawl_date > as_of_date - 20")
def look_ahead_planted(spark, sf):
    """Batches of every seventh month are declared partial afterwards, and dates on a 28th are moved twenty days back."""
    made = catalog._readings(spark, sf)
    n = F.year("crawl_date") * 12 + F.month("crawl_date")
    batches = made[1].withColumn("is_eligible", F.col("is_eligible") & ((n + 1) % 7 != 0))
    dates = catalog.as_of_dates(spark, sf)
    cat = materialise(catalog._catalogue(spark, sf, made), "catalogue").drop("is_micro_date", "is_macro_date")
    late = F.dayofmonth("as_of_date") == 28
    moved = cat.withColumn("_day", F.col("as_of_date")).withColumn("as_of_date", F.when(late, F.date_sub("as_of_date", 20)).otherwise(F.col("as_of_date")))
    calendar = dates.select("as_of_date", "knowledge_cutoff").union(dates.filter(late).select(F.date_sub("as_of_date", 20), F.date_add("as_of_date", 1).cast("timestamp"))).groupBy("as_of_date").agg(F.max("knowledge_cutoff").alias("knowledge_cutoff"))
    return assertions.look_ahead(moved, batches, calendar).select("catalogue_row_id")


@query("SELECT object_id, count(*) FILTER (market = 'ASIA' AND valid_to IS NOT NULL AND period_number = 1) AS n_bad, count(*) FILTER (valid_to IS NULL AND market <> 'EUROPE') AS n_current FROM periods WHERE market <> 'EUROPE' OR valid_to IS NOT NULL GROUP BY object_id HAVING n_bad > 0 OR n_current <> 1")
def broken_periods_planted(spark, sf):
    """Periods of which the first is empty in Asia and the last is lost in Europe."""
    periods = catalog._periods(spark, sf).filter("market <> 'EUROPE' or valid_to is not null")
    empty = (F.col("market") == "ASIA") & F.col("valid_to").isNotNull() & (F.col("period_number") == 1)
    return assertions.broken_periods(periods.withColumn("valid_to", F.when(empty, F.col("valid_from")).otherwise(F.col("valid_to"))))


@query("SELECT object_id, as_of_date, 2::BIGINT AS n FROM catalogue WHERE market = 'ASIA' AND is_macro_date")
def catalogue_keys_repeated(spark, sf):
    """A catalogue in which a market's month ends were loaded twice."""
    cat = materialise(catalog._catalogue(spark, sf), "catalogue")
    return assertions.not_unique(cat.unionByName(cat.filter("market = 'ASIA' and is_macro_date")), "object_id", "as_of_date")


@query(f"SELECT * FROM ({_RELEASES} SELECT scope, as_of_date, 'BLOCK' AS decision FROM rel WHERE month(as_of_date) IN (4, 10) AND NOT (is_forced AND scope = 'macro'))")
def blocked_but_published_planted(spark, sf):
    """Blocked deliveries in the ledger without force: all of October, and the weekly ones of April, whose force is taken away."""
    rel = catalog._releases(spark, sf)
    rel = rel.withColumns({"decision": F.when(F.month("as_of_date") == 10, "BLOCK").otherwise(F.col("decision")), "is_forced": F.col("is_forced") & (F.col("scope") == "macro")})
    return assertions.blocked_but_published(rel).select("scope", "as_of_date", "decision")


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey % 9 = 0 GROUP BY l_orderkey")
def orphan_lines_planted(spark, sf):
    """Lines of orders of which every ninth is gone."""
    orders = a.table(spark, sf, "orders").filter("o_orderkey % 9 <> 0")
    return assertions.orphans(a.table(spark, sf, "lineitem"), "l_orderkey", orders, "o_orderkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT 'not_accepted' AS test, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') UNION ALL SELECT 'out_of_range', count(*) FROM lineitem WHERE l_quantity < 3 OR l_quantity > 48
UNION ALL SELECT 'nulls', count(*) FROM events WHERE event_id % 7 = 0 UNION ALL SELECT 'unequal_rowcount', CASE WHEN (SELECT count(*) FROM orders) <> (SELECT count(*) FROM customer) THEN 1 ELSE 0 END"""
)
def violations(spark, sf):
    """Rows that break simple tests."""
    orders, lines, events = (a.table(spark, sf, t) for t in ("orders", "lineitem", "events"))
    found = {
        "not_accepted": assertions.not_accepted(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"]), "out_of_range": assertions.out_of_range(lines, "l_quantity", 3, 48),
        "nulls": assertions.nulls(events.withColumn("event_id", F.when(F.col("event_id") % 7 != 0, F.col("event_id"))), "event_id"), "unequal_rowcount": assertions.unequal_rowcount(orders, a.table(spark, sf, "customer")),
    }
    parts = [df.agg(F.lit(name).alias("test"), F.count(F.lit(1)).alias("n")) for name, df in found.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


@query(
    """SELECT * FROM (WITH c AS (SELECT 'uncategorized' AS test, count(*) AS n FROM products WHERE category = 'UNCATEGORIZED' UNION ALL SELECT 'large_orders', count(*) FROM orders WHERE o_totalprice > 500000 UNION ALL SELECT 'unknown_parts', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part))
SELECT test, CASE WHEN test = 'uncategorized' THEN CASE WHEN n > 5 THEN 'warn' ELSE 'pass' END WHEN n > 0 THEN 'error' ELSE 'pass' END AS verdict FROM c)"""
)
def verdicts(spark, sf):
    """Tests with bounds: products without a category only warn, beyond five."""
    part = a.table(spark, sf, "part")
    found = {
        "uncategorized": (assertions.uncategorized(catalog.categorized_products(spark, sf)), 5, None), "large_orders": (assertions.out_of_range(a.table(spark, sf, "orders"), "o_totalprice", high=500000), None, 0),
        "unknown_parts": (assertions.orphans(a.table(spark, sf, "lineitem"), "l_partkey", part, "p_partkey"), None, 0),
    }
    return spark.createDataFrame([(name, assertions.verdict(df, warn, error)) for name, (df, warn, error) in found.items()], "test string, verdict string")
