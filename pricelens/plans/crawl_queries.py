"""Queries over raw lines, deliveries and staging: the given tables written as the lines of crawl files, with planted defects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.config import CrawlConfig
from pricelens.functions import text as t
from pricelens.operators import assertions, deliveries, quality, reports, staging
from pricelens.plans.adapters import table
from pricelens.sources import raw
from pricelens.sources.tables import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            SQL[fn.__name__] = oracle
        return fn

    return add


# ---- text repairs -------------------------------------------------------------------------------------------------------


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN k IN (0, 1, 2) THEN CAST(cents / 100.0 AS DECIMAL(18,2)) WHEN k IN (3, 6) THEN CAST(cents // 100 AS DECIMAL(18,2)) END AS price_local,
CASE k WHEN 0 THEN CASE WHEN cents >= 100000 THEN 'price_us_thousands_separator' ELSE 'price_trailing_decimals' END WHEN 1 THEN 'price_eu_decimal_format' WHEN 2 THEN 'price_currency_symbol'
WHEN 4 THEN 'price_on_request' WHEN 5 THEN 'price_from_or_range' WHEN 6 THEN 'price_non_ascii_digits' END AS price_parse_issue
FROM (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_orderkey % 7 AS k FROM lineitem)"""
)
def parsed_prices(spark, sf):
    """Prices written in seven ways are read back as the numbers that they were."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    k = F.col("l_orderkey") % 7
    us = F.format_number(cents.cast("decimal(20,2)") / 100, 2)
    whole = F.expr("cast(round(l_extendedprice * 100) as bigint) div 100").cast("string")
    wide = F.translate(whole, "0123456789", "".join(chr(0xFF10 + i) for i in range(10)))
    text = F.when(k == 0, us).when(k == 1, F.translate(us, ",.", ".,")).when(k == 2, F.concat(F.lit("$"), us)).when(k == 3, whole)
    text = text.when(k == 4, "Price upon request").when(k == 5, F.concat(F.lit("From "), us)).otherwise(wide)
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("x"))
    return t.read_prices(df, "x", F.lit(2)).drop("x")


@query("SELECT doc_id, md5(text) AS repaired FROM documents")
def repaired_mojibake(spark, sf):
    """Texts read in the wrong encoding are repaired to what they were."""
    wrong = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return table(spark, sf, "documents").select("doc_id", F.md5(t.repair_mojibake(wrong)).alias("repaired"))


@query("SELECT p_partkey, p_name FROM part")
def cleaned_names(spark, sf):
    noisy = F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("&nbsp;  ")), F.lit("\t"))
    return table(spark, sf, "part").select("p_partkey", t.clean_name(t.unescape_html(noisy)).alias("p_name"))


# ---- staging ------------------------------------------------------------------------------------------------------------------

CODES = {"AFRICA": "ARE", "AMERICA": "USA", "ASIA": "JPN", "EUROPE": "FRA", "MIDDLE EAST": "SAU"}


def crawl_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as raw crawl lines, one file a month, with defects planted by order number."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    part = table(spark, sf, "part").select("p_partkey", "p_name", F.floor("p_retailprice").cast("bigint").alias("price"))
    sup = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("bigint").alias("nation"))
    df = li.join(orders, li["l_orderkey"] == orders["o_orderkey"]).join(part, li["l_partkey"] == part["p_partkey"]).join(sup, li["l_suppkey"] == sup["s_suppkey"])
    names = list(CODES.values())
    market = F.element_at(F.array(*map(F.lit, names)), (F.col("nation") % 5 + 1).cast("int"))
    df = df.withColumns({"market": market, "o": F.col("l_orderkey"), "sku": F.concat(F.lit("P"), F.col("l_partkey").cast("string"))})
    hit = lambda n: F.col("o") % n == 0
    ms = F.unix_date("day") * F.lit(86_400_000).cast("bigint")
    money = t.lookup(F.col("market"), CrawlConfig().market_currency)
    fields = [
        ("objectID", F.concat(F.lit('"Brand_'), "market", F.lit("_"), "sku", F.lit('"'))),
        ("brandId", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")),
        ("name", F.concat(F.lit('"'), F.lower("p_name"), F.when(hit(11), " &amp; co").otherwise(""), F.lit('"'))),
        ("url", F.when(hit(23), F.lit("null")).otherwise(F.lit('"http://x"'))),
        ("previewUrl", F.lit('"http://y"')),
        (
            "price",
            F.concat(
                F.lit('{"original_price":"'), F.when(hit(13), F.lit("Price upon request")).otherwise(F.col("price").cast("string")),
                F.lit('","original_currency":"'), F.when(hit(37), F.lit("ZZZ")).otherwise(money), F.lit('","price":1}'),
            ),
        ),
        ("productDetails", F.lit('[{"key":"color","value":"black"},{"key":"color","value":"red"}]')),
        ("status", F.when(hit(19), F.lit("404")).otherwise(F.lit("200"))),
        ("source", F.concat(F.lit('"Brand_'), "market", F.lit('"'))),
        ("crawlerName", F.lit('"BrandIntl"')),
        ("createdAt", F.when(hit(29), F.unix_date("day") * F.lit(86_400).cast("bigint")).otherwise(ms).cast("string")),
        ("skus", F.concat(F.lit('["'), "sku", F.lit('"]'))),
        ("market", F.when(hit(17), F.lit("null")).otherwise(F.concat(F.lit('"'), "market", F.lit('"')))),
        ("isValid", F.when(hit(31), F.lit('"true"')).otherwise(F.lit("true"))),
    ]
    line = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in fields]), F.lit("}"))
    month = F.trunc("day", "MM")
    name = F.concat(F.lit("BrandIntl_"), month.cast("string"), F.lit("_"), (F.unix_seconds(month.cast("timestamp")) * 1000).cast("string"), F.lit("_x.ndjson.gz"))
    return df.select(line.alias("raw_line"), name.alias("source_file_name"), month.cast("timestamp").alias("loaded_at"))


_LINES = """WITH s AS (SELECT l_orderkey AS o, l_linenumber, l_partkey, s_nationkey % 5 AS m, date_trunc('month', o_orderdate)::DATE AS month, floor(p_retailprice) AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
n AS (SELECT month, m, l_partkey, count(DISTINCT o * 10 + l_linenumber) > 1 AS conflict FROM s GROUP BY ALL),
c AS (SELECT *, row_number() OVER (PARTITION BY month, m, l_partkey, o, l_linenumber) > 1 AS again FROM s JOIN n USING (month, m, l_partkey)),
q AS (SELECT *, o % 13 = 0 OR o % 19 = 0 OR o % 37 = 0 OR conflict AS quarantine, o % 23 = 0 AS warn, o % 11 = 0 OR o % 17 = 0 OR (o % 29 = 0) OR o % 31 = 0 OR again AS fix FROM c)"""


def _staged(spark, sf, *columns):
    """Those columns of the staged lines that a query counts, or all."""
    lines = crawl_lines(spark, sf)
    return staging.stage_columns(lines, columns) if columns else staging.stage_observations(lines)


def _statuses(spark, sf):
    """What of the staged lines is counted twice, written once."""
    return materialise(_staged(spark, sf, "source_file_name", "sku", "dq_status"), "statuses")


@query(_LINES + " SELECT month AS file_crawl_date, CASE WHEN quarantine THEN 'quarantine' WHEN warn THEN 'warn' WHEN fix THEN 'fixed' ELSE 'pass' END AS dq_status, count(*) AS n, sum(CASE WHEN o % 13 <> 0 THEN price END)::BIGINT AS total FROM q GROUP BY ALL")
def staged_status(spark, sf):
    return _staged(spark, sf, "file_crawl_date", "dq_status", "price_local").groupBy("file_crawl_date", "dq_status").agg(F.count(F.lit(1)).alias("n"), F.sum("price_local").cast("bigint").alias("total"))


@query(
    _LINES
    + """ SELECT r AS rule, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN o % 11 = 0 THEN 'name_html_entity' END, CASE WHEN o % 13 = 0 THEN 'price_on_request' END, CASE WHEN o % 17 = 0 THEN 'market_recovered_from_source' END,
CASE WHEN o % 19 = 0 THEN 'http_error_or_invalid' END, CASE WHEN o % 23 = 0 THEN 'url_missing' END, CASE WHEN o % 29 = 0 THEN 'timestamp_epoch_seconds' END, CASE WHEN o % 31 = 0 THEN 'is_valid_as_string' END,
CASE WHEN o % 37 = 0 THEN 'currency_market_mismatch' END, CASE WHEN conflict THEN 'conflicting_duplicate' END, CASE WHEN again THEN 'exact_duplicate_line' END], lambda x: x IS NOT NULL)) AS r FROM q) GROUP BY r"""
)
def staged_issues(spark, sf):
    return _staged(spark, sf, "dq_issues").select(F.explode("dq_issues").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query(
    _LINES
    + """ SELECT r AS repair_rule, f AS repaired_field, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN o % 11 = 0 THEN 'name_html_entity' END, CASE WHEN o % 17 = 0 THEN 'market_recovered_from_source' END,
CASE WHEN o % 29 = 0 THEN 'timestamp_epoch_seconds' END, CASE WHEN o % 31 = 0 THEN 'is_valid_as_string' END, CASE WHEN again THEN 'exact_duplicate_line' END], lambda x: x IS NOT NULL)) AS r FROM q),
(VALUES ('exact_duplicate_line', '<whole line>'), ('name_html_entity', 'product_name'), ('market_recovered_from_source', 'market'), ('timestamp_epoch_seconds', 'crawled_at'), ('is_valid_as_string', 'is_valid')) v(k, f) WHERE k = r GROUP BY ALL"""
)
def repairs_by_rule(spark, sf):
    # The columns whose values the repairs show come along; what isn't counted of them is pruned.
    return quality.repairs(_staged(spark, sf, *staging.STAGED)).groupBy("repair_rule", "repaired_field").agg(F.count(F.lit(1)).alias("n"))


@query(_LINES + " SELECT month AS file_crawl_date, count(*) AS n FROM q WHERE quarantine GROUP BY ALL")
def quarantined_lines(spark, sf):
    out = quality.quarantined(_staged(spark, sf, "file_crawl_date", "dq_issues", "dq_status", "raw_line")).filter(F.size("quarantine_reasons") > 0)
    return out.groupBy("file_crawl_date").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT month AS source_file_name, 0 AS delivered, 0 AS usable, 0 AS quarantined FROM (SELECT 'x' AS month) WHERE false")
def lost_rows(spark, sf):
    """Every delivered line is usable or quarantined."""
    obs = _statuses(spark, sf)
    out = assertions.lost_rows(crawl_lines(spark, sf), obs.filter("dq_status <> 'quarantine'"), obs.filter("dq_status = 'quarantine'"))
    return out.select("source_file_name", *[F.col(c).cast("int").alias(c) for c in ("delivered", "usable", "quarantined")])


@query(
    _LINES
    + """ SELECT 'BrandIntl_' || month || '_' || (epoch(month::TIMESTAMP)::BIGINT * 1000) || '_x.ndjson.gz' AS source_file_name, count(*)::INTEGER AS delivered,
(count(*) FILTER (NOT quarantine AND l_partkey % 50 <> 7))::INTEGER AS usable, (count(*) FILTER (quarantine))::INTEGER AS quarantined FROM q GROUP BY month HAVING delivered <> usable + quarantined"""
)
def lost_rows_planted(spark, sf):
    """Files from whose usable lines some products were dropped."""
    obs = _statuses(spark, sf)
    kept = obs.filter("dq_status <> 'quarantine' and not (cast(substring(sku, 2) as bigint) % 50 = 7)")
    out = assertions.lost_rows(crawl_lines(spark, sf), kept, obs.filter("dq_status = 'quarantine'"))
    return out.select("source_file_name", *[F.col(c).cast("int").alias(c) for c in ("delivered", "usable", "quarantined")])


@query("SELECT 'red' AS color, count(*) AS n FROM lineitem")
def parsed_details(spark, sf):
    """The last of repeated detail keys counts."""
    return staging.parse_lines(crawl_lines(spark, sf)).groupBy(F.try_element_at("product_details_raw", F.lit("color")).alias("color")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type AS source_file_name, props AS raw_line, row_number() OVER (PARTITION BY event_type, props ORDER BY ts) AS identical_line_ordinal, sha256(event_type || '|' || props || '|' || identical_line_ordinal) AS crawl_line_id FROM events")
def line_ids(spark, sf):
    lines = table(spark, sf, "events").select(F.col("event_type").alias("source_file_name"), F.col("props").alias("raw_line"), F.col("ts").alias("loaded_at"))
    return staging.with_line_id(lines).select("source_file_name", "raw_line", "identical_line_ordinal", "crawl_line_id")


# ---- loading ------------------------------------------------------------------------------------------------------------------


@query("SELECT CAST(ts AS DATE) AS source_file_name, count(*) AS n_lines, min(ts) AS first_loaded_at FROM events GROUP BY ALL")
def load_overview(spark, sf):
    return raw.load_overview(table(spark, sf, "events").withColumn("source_file_name", F.to_date("ts")), "source_file_name", "ts")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def events_by_type(spark, sf):
    return raw.count_by(table(spark, sf, "events"), "event_type")


@query(
    """SELECT source_file_name, expected_rows, loaded_rows FROM (SELECT CAST(ts AS DATE) AS source_file_name, count(*) AS expected_rows FROM events WHERE day(ts) <> 3 GROUP BY ALL)
FULL JOIN (SELECT CAST(ts AS DATE) AS source_file_name, count(*) AS loaded_rows FROM events WHERE day(ts) <> 4 AND (day(ts) <> 5 OR hour(ts) < 12) GROUP BY ALL) USING (source_file_name) WHERE expected_rows IS DISTINCT FROM loaded_rows"""
)
def reconcile_load(spark, sf):
    df = table(spark, sf, "events").withColumn("source_file_name", F.to_date("ts"))
    day = F.dayofmonth("ts")
    expected = df.filter(day != 3).groupBy("source_file_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return raw.reconcile_load(df.filter((day != 4) & ((day != 5) | (F.hour("ts") < 12))), expected)


@query("SELECT value, n FROM (SELECT json_extract_string(props, '$.k') AS value, count(*) AS n FROM events GROUP BY ALL) ORDER BY n DESC, value LIMIT 20")
def probe_json(spark, sf):
    return raw.probe_json(table(spark, sf, "events"), "$.k", F.col("value").isNotNull(), 20, "props")


@query("SELECT max(ts) AS newest, date_diff('day', max(ts)::DATE, DATE '2024-02-03')::INTEGER AS age_days, CASE WHEN age_days > 30 THEN 'error' WHEN age_days > 2 THEN 'warn' ELSE 'pass' END AS status FROM events")
def freshness(spark, sf):
    return raw.check_freshness(table(spark, sf, "events"), "ts", 2, 30, F.lit("2024-02-03").cast("date"))


@query("SELECT d::DATE AS date_day, count(event_id) AS n FROM (SELECT unnest(generate_series((SELECT min(ts)::DATE FROM events), (SELECT max(ts)::DATE FROM events), INTERVAL 1 DAY)) AS d) LEFT JOIN events ON ts::DATE = d::DATE GROUP BY ALL")
def events_by_day(spark, sf):
    df = table(spark, sf, "events")
    first, last = df.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    n = df.groupBy(F.to_date("ts").alias("date_day")).agg(F.count("event_id").alias("n"))
    return raw.time_spine(spark, str(first), str(last)).join(n, "date_day", "left").na.fill(0, ["n"])


# ---- deliveries -----------------------------------------------------------------------------------------------------------------


def delivered_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as daily files of five members; one file delivered twice, one stale, one member partial, one missing, one file of three."""
    e = table(spark, sf, "events").select(F.to_date("ts").alias("day"), F.col("ts").alias("crawled_at"), F.col("event_type").alias("market"), F.concat_ws("|", F.col("event_id").cast("string"), "props").alias("raw_line"))
    d, h, m = F.dayofmonth("day"), F.hour("crawled_at"), F.col("market")
    e = e.filter(~((d == 12) & (m == "click") & (h >= 8)) & ~((d == 14) & (m == "view")) & ~((d == 20) & m.isin("signup", "view")))

    def file(df, claimed, suffix, exported):
        name = F.concat(F.lit("events_"), claimed.cast("string"), F.lit(suffix), F.lit(".ndjson.gz"))
        return df.withColumns({"source_file_name": name, "delivered_file_name": name, "file_crawl_date": claimed, "file_exported_at": exported.cast("timestamp"), "loaded_at": exported.cast("timestamp"), "file_name_has_copy_suffix": F.lit(bool(suffix))})

    plain = file(e, F.col("day"), "", F.date_add("day", 1))
    copy = file(e.filter(d == 10), F.col("day"), " (1)", F.date_add("day", 2))
    stale = file(e.filter((d == 5) & (h < 12)), F.date_add("day", 20), "", F.date_add("day", 21)).withColumns({c: F.regexp_replace(c, "events_", "late_") for c in ("source_file_name", "delivered_file_name")})
    return plain.unionByName(copy).unionByName(stale).withColumn("dq_status", F.when(F.substring_index("raw_line", "|", 1).cast("bigint") % 20 == 0, "quarantine").otherwise("pass"))


_FILES = """WITH e AS (SELECT ts::DATE AS day, ts AS crawled_at, event_type AS market, event_id || '|' || props AS raw_line FROM events
WHERE NOT (day(ts) = 12 AND event_type = 'click' AND hour(ts) >= 8) AND NOT (day(ts) = 14 AND event_type = 'view') AND NOT (day(ts) = 20 AND event_type IN ('signup', 'view'))),
o AS (SELECT 'events_' || day || '.ndjson.gz' AS f, day AS claimed, day + 1 AS exported, false AS suffix, * FROM e
UNION ALL SELECT 'events_' || day || ' (1).ndjson.gz', day, day + 2, true, * FROM e WHERE day(day) = 10
UNION ALL SELECT 'late_' || (day + 20) || '.ndjson.gz', day + 20, day + 21, false, * FROM e WHERE day(day) = 5 AND hour(crawled_at) < 12),
pf AS (SELECT f, any_value(claimed) AS claimed, any_value(exported) AS exported, any_value(suffix) AS suffix, count(*) AS n_lines, list_sort(list(DISTINCT market)) AS markets, min(crawled_at) AS lo, max(crawled_at) AS hi,
md5(string_agg(raw_line, '~' ORDER BY raw_line)) AS print FROM o GROUP BY f),
rk AS (SELECT *, row_number() OVER w AS k, first_value(f) OVER w AS original FROM pf WINDOW w AS (PARTITION BY print, n_lines ORDER BY suffix, exported, f)),
fm AS (SELECT f, market, count(*) AS n, count(*) FILTER (split_part(raw_line, '|', 1)::BIGINT % 20 <> 0) AS n_usable FROM o GROUP BY ALL),
part AS (SELECT f, list_sort(list(market)) AS partial FROM fm JOIN (SELECT market, quantile_disc(n, 0.5) AS med FROM fm GROUP BY market) USING (market) WHERE n < med * 0.7 GROUP BY f),
files AS (SELECT rk.f AS source_file_name, n_lines, len(markets)::INTEGER AS n_markets, k > 1 AS is_duplicate_content, CASE WHEN k > 1 THEN original END AS duplicate_of_file,
claimed - hi::DATE > 3 AS is_stale_content, coalesce(array_to_string(partial, ','), '') AS partial_markets,
CASE WHEN len(markets) > 3 THEN 'extended' ELSE 'weekly' END AS crawl_scope,
array_to_string(list_filter(CASE crawl_scope WHEN 'weekly' THEN names[:3] ELSE names END, lambda x: NOT list_contains(markets, x)), ',') AS missing_markets,
CASE WHEN k > 1 OR claimed - hi::DATE > 3 THEN 'block' WHEN missing_markets <> '' OR partial IS NOT NULL THEN 'warn' ELSE 'ok' END AS file_status, lo::DATE AS content_crawl_date
FROM rk CROSS JOIN (SELECT list_sort(list(DISTINCT event_type)) AS names FROM events) LEFT JOIN part ON part.f = rk.f)"""


def _files(spark, sf):
    obs = delivered_events(spark, sf)
    names = [r[0] for r in obs.select("market").distinct().orderBy("market").collect()]  # five names
    return obs, deliveries.assess_files(obs, names[:3], names, 0.7, 3)


@query(_FILES + " SELECT * FROM files")
def file_profile(spark, sf):
    _, files = _files(spark, sf)
    return files.select(
        "source_file_name", "crawl_scope", "n_lines", F.col("n_markets").cast("int").alias("n_markets"), "is_duplicate_content", "duplicate_of_file", "is_stale_content",
        F.array_join("partial_markets", ",").alias("partial_markets"), F.array_join("missing_markets", ",").alias("missing_markets"), "file_status", "content_crawl_date",
    )


@query(
    _FILES
    + """ SELECT md5(f || '-' || market) AS market_batch_id, f AS source_file_name, market, n AS n_lines, n_usable AS n_usable_lines, file_status AS delivery_status, file_status <> 'block' AS is_trusted_delivery,
list_contains(string_split(partial_markets, ','), market) AS is_partial, file_status <> 'block' AND NOT list_contains(string_split(partial_markets, ','), market) AS is_eligible FROM fm JOIN files ON f = source_file_name"""
)
def market_batches(spark, sf):
    obs, files = _files(spark, sf)
    return deliveries.assess_batches(obs, files).select("market_batch_id", "source_file_name", "market", "n_lines", "n_usable_lines", "delivery_status", "is_trusted_delivery", "is_partial", "is_eligible")


@query(_FILES + " SELECT market, day AS crawl_date, n AS n_lines, round(n::DOUBLE / lag(n) OVER (PARTITION BY market ORDER BY day)::DOUBLE, 4) AS ratio_to_previous FROM (SELECT market, day, count(*) AS n FROM e GROUP BY ALL)")
def shrinkage(spark, sf):
    plain = delivered_events(spark, sf).filter(F.col("source_file_name").startswith("events_") & ~F.col("file_name_has_copy_suffix"))
    return reports.shrinkage(plain.groupBy("market", F.col("day").alias("crawl_date")).agg(F.count(F.lit(1)).alias("n_lines")))


@query("SELECT 'b' || event_type AS source_file_name, 'a' || event_type AS same_times_as FROM events GROUP BY ALL HAVING count(*) > 1")
def same_times_other_lines(spark, sf):
    """Two files for each type with the same times, of which one has other lines."""
    e = table(spark, sf, "events").select("event_type", F.col("ts").cast("string").alias("created_at_raw"), "props")
    a = e.select(F.concat(F.lit("a"), "event_type").alias("source_file_name"), "created_at_raw", F.col("props").alias("raw_line"))
    b = e.select(F.concat(F.lit("b"), "event_type").alias("source_file_name"), "created_at_raw", F.concat("props", F.lit("x")).alias("raw_line"))
    return reports.same_times_other_lines(a.union(b))


@query("SELECT event_id FROM events WHERE event_id % 10 = 0")
def schema_parity(spark, sf):
    """Lines whose keys aren't the expected ones."""
    odd = F.col("event_id") % 10 == 0
    lines = table(spark, sf, "events").withColumn("raw_line", F.when(odd, F.to_json(F.struct("event_type", F.col("user_id").alias("id")))).otherwise(F.to_json(F.struct(F.col("user_id").alias("id"), "event_type"))))
    return reports.schema_parity(lines, ["id", "event_type"], []).select("event_id")
