"""Governed metrics over the marts as built from the given tables: every metric, its refusals and its policy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pricelens.operators import metrics
from pricelens.plans import catalog
from pricelens.plans.adapters import sql
from pricelens.sources.tables import materialise

QUERIES, SQL = {}, {}
_TABLES = {"hero_prices": catalog._micro, "category_monthly": catalog._monthly, "price_changes": catalog._changes}
_YEAR = (dt.date(1997, 1, 1), dt.date(1997, 12, 31))

#: name: (request, SQL for its rows with the metric as ``value``).
REQUESTS = {
    "metric_hero_price": (
        metrics.Request("hero_price", ("market", "currency_code"), filters={"price_status": ["price_increase", "price_decrease"]}, start=_YEAR[0], end=_YEAR[1]),
        "SELECT market, currency_code, avg(price_local) AS value FROM micro WHERE price_status IN ('price_increase', 'price_decrease') AND year(delivery_date) = 1997 GROUP BY ALL",
    ),
    "metric_hero_price_change": (
        metrics.Request("hero_price_change", ("product_label",), by_time=True, filters={"market": ["EUROPE"]}, start=_YEAR[0], end=_YEAR[1]),
        "SELECT delivery_date, product_label, avg(change_vs_previous_pct) AS value FROM micro WHERE market = 'EUROPE' AND year(delivery_date) = 1997 GROUP BY ALL ORDER BY delivery_date, product_label LIMIT 500",
    ),
    "metric_hero_price_increases": (
        metrics.Request("hero_price_increases", ("market", "price_status")),
        "SELECT market, price_status, count(*) FILTER (price_status = 'price_increase') AS value FROM micro GROUP BY ALL",
    ),
    "metric_category_product_count": (
        metrics.Request("category_product_count", ("market",), start=dt.date(1998, 5, 1), end=dt.date(1998, 5, 1)),
        "SELECT market, sum(n_products) AS value FROM monthly WHERE report_month = DATE '1998-05-01' GROUP BY market",
    ),
    "metric_category_median_price": (
        metrics.Request("category_median_price", ("macro_category", "currency_code"), filters={"market": ["EUROPE"]}),
        "SELECT macro_category, currency_code, avg(median_price) AS value FROM monthly WHERE market = 'EUROPE' GROUP BY ALL",
    ),
    "metric_category_share_increased": (
        metrics.Request("category_share_increased", ("macro_category",), by_time=True),
        "SELECT report_month, macro_category, avg(lfl_share_increased) AS value FROM monthly GROUP BY ALL ORDER BY report_month, macro_category LIMIT 500",
    ),
    "metric_price_change_count": (
        metrics.Request("price_change_count", ("market", "change_direction")),
        "SELECT market, change_direction, count(*) AS value FROM changes GROUP BY ALL",
    ),
    "metric_average_price_change": (
        metrics.Request("average_price_change", ("macro_category",), start=_YEAR[0], descending=False),
        "SELECT macro_category, avg(change_pct) AS value FROM changes WHERE changed_on_crawl_date >= DATE '1997-01-01' GROUP BY macro_category",
    ),
    "metric_price_change_days": (
        metrics.Request("price_change_count", by_time=True, filters={"market": ["ASIA", "EUROPE"]}, end=dt.date(1996, 12, 31)),
        "SELECT changed_on_crawl_date, count(*) AS value FROM changes WHERE market IN ('ASIA', 'EUROPE') AND changed_on_crawl_date < DATE '1997-01-01' GROUP BY ALL ORDER BY changed_on_crawl_date LIMIT 500",
    ),
    "metric_lfl_change_ranked": (
        metrics.Request("category_lfl_change", ("market", "macro_category")),
        "SELECT market, macro_category, avg(lfl_mean_change) AS value FROM monthly GROUP BY ALL",
    ),
}


def _asked(name: str, request: metrics.Request):
    def run(spark, sf):
        table = _TABLES[metrics.METRICS[request.metric].model](spark, sf)
        out = metrics.query_metric(table, request)
        return out.withColumn("value", F.round(F.col(request.metric).cast("double"), 4)).drop(request.metric)

    run.__name__ = name
    return run


for _name, (_request, _text) in REQUESTS.items():
    QUERIES[_name] = _asked(_name, _request)
    SQL[_name] = sql(f"SELECT * REPLACE (round(value::DOUBLE, 4) AS value) FROM ({_text})")


def metric_refusals(spark, sf):
    """Requests for metrics of the weekly table, and whether they are refused: unknown values and periods come from the table."""
    known = materialise(metrics.vocabulary(catalog._micro(spark, sf), metrics.MODELS["hero_prices"]), "vocabulary")
    ask = metrics.Request
    asked = {
        "by market": ask("hero_price", ("market",)), "mixed currencies": ask("hero_price"), "one market": ask("hero_price", filters={"market": ["EUROPE"]}),
        "unwatched market": ask("hero_price_change", filters={"market": ["ASIA"]}), "unknown product": ask("hero_price_change", filters={"pointer_id": ["HERO-NONE"]}),
        "foreign dimension": ask("hero_price_change", ("macro_category",)), "hidden metric": ask("lfl_weighted_numerator"),
        "period before the data": ask("hero_price_change", start=dt.date(1990, 1, 1), end=dt.date(1990, 12, 31)), "period of the data": ask("hero_price_change", start=_YEAR[0], end=_YEAR[1]),
    }
    rows = []
    for name, request in asked.items():
        try:
            metrics.check_request(request, known)
            rows.append((name, False))
        except metrics.Refused:
            rows.append((name, True))
    return spark.createDataFrame(rows, "request string, is_refused boolean")


SQL["metric_refusals"] = sql(
    """SELECT * FROM (VALUES ('by market', false), ('mixed currencies', (SELECT count(DISTINCT currency_code) > 1 FROM micro)), ('one market', NOT EXISTS (FROM micro WHERE market = 'EUROPE')),
('unwatched market', NOT EXISTS (FROM micro WHERE market = 'ASIA')), ('unknown product', NOT EXISTS (FROM micro WHERE pointer_id = 'HERO-NONE')), ('foreign dimension', true), ('hidden metric', true),
('period before the data', (SELECT min(delivery_date) > DATE '1990-12-31' FROM micro)), ('period of the data', NOT EXISTS (FROM micro WHERE year(delivery_date) = 1997))) v(request, is_refused)"""
)


def metric_by_policy(spark, sf):
    """What a bare question for the price is shown as: the latest delivery, split by market, as prices are in local currency."""
    table = materialise(catalog._micro(spark, sf), "micro")
    days = [r[0] for r in table.select("delivery_date").distinct().collect()]
    request = metrics.apply_policy(metrics.Request("hero_price", ("currency_code",)), days)
    return metrics.query_metric(table, request).withColumn("value", F.round(F.col("hero_price").cast("double"), 4)).drop("hero_price")


SQL["metric_by_policy"] = sql("SELECT market, round(avg(price_local)::DOUBLE, 4) AS value FROM micro WHERE delivery_date = (SELECT max(delivery_date) FROM micro) GROUP BY market")


#: Requests as they come, and SQL for what the policy makes of them.
POLICIES = {
    "metric_policy_level": (
        metrics.Request("category_median_price", filters={"market": ["EUROPE", "ASIA"]}, start=_YEAR[0], end=_YEAR[1]),
        "SELECT market, avg(median_price) AS value FROM monthly WHERE market IN ('ASIA', 'EUROPE') AND report_month = (SELECT max(report_month) FROM monthly WHERE year(report_month) = 1997) GROUP BY market",
    ),
    "metric_policy_percent": (
        metrics.Request("category_lfl_change", ("macro_category", "market"), filters={"market": ["EUROPE"]}, start=_YEAR[0], end=_YEAR[1]),
        "SELECT report_month, macro_category, avg(lfl_mean_change) AS value FROM monthly WHERE market = 'EUROPE' AND year(report_month) = 1997 GROUP BY ALL",
    ),
    "metric_policy_count": (
        metrics.Request("hero_price_increases", ("currency_code",), start=_YEAR[0], end=_YEAR[1]),
        "SELECT market, count(*) FILTER (price_status = 'price_increase') AS value FROM micro WHERE year(delivery_date) = 1997 GROUP BY market",
    ),
    "metric_policy_history": (
        metrics.Request("average_price_change", filters={"change_direction": ["increase", "decrease"], "market": ["ASIA"]}),
        "SELECT change_direction, avg(change_pct) AS value FROM changes WHERE market = 'ASIA' GROUP BY change_direction",
    ),
    "metric_policy_one_date": (
        metrics.Request("category_share_increased", ("macro_category",), end=dt.date(1996, 6, 1)),
        "SELECT macro_category, avg(lfl_share_increased) AS value FROM monthly WHERE report_month = DATE '1996-06-01' GROUP BY macro_category",
    ),
}


def _by_policy(name: str, request: metrics.Request):
    def run(spark, sf):
        model = metrics.MODELS[metrics.METRICS[request.metric].model]
        table = materialise(_TABLES[model.name](spark, sf), model.name)
        periods = [r[0] for r in table.select(model.time).distinct().collect()]
        out = metrics.query_metric(table, metrics.apply_policy(request, periods))
        return out.withColumn("value", F.round(F.col(request.metric).cast("double"), 4)).drop(request.metric)

    run.__name__ = name
    return run


for _name, (_request, _text) in POLICIES.items():
    QUERIES[_name] = _by_policy(_name, _request)
    SQL[_name] = sql(f"SELECT * REPLACE (round(value::DOUBLE, 4) AS value) FROM ({_text})")


def metric_vocabularies(spark, sf):
    """Values of every dimension of the weekly table and of the price changes; all dimensions of the models are there."""
    out, made = None, catalog._readings(spark, sf)  # both tables are made of the same readings
    for model in ("hero_prices", "price_changes"):
        table = _TABLES[model](spark, sf, made=made)
        lacking = set(metrics.MODELS[model].dimensions) - set(table.columns)
        if lacking:
            raise ValueError(f"{model} lacks {sorted(lacking)}")
        part = metrics.vocabulary(table, metrics.MODELS[model]).withColumn("model", F.lit(model))
        out = part if out is None else out.union(part)
    return out


def _values(model: str, table: str, dimensions: tuple[str, ...]) -> str:
    return " UNION ".join(f"SELECT '{model}' AS model, '{d}' AS dimension, CAST({d} AS VARCHAR) AS value FROM {table} WHERE {d} IS NOT NULL" for d in dimensions)


SQL["metric_vocabularies"] = sql(
    _values("hero_prices", "micro", ("pointer_id", "product_label", "market", "currency_code", "price_status", "delivery_date"))
    + " UNION " + _values("price_changes", "changes", ("market", "macro_category", "change_direction", "changed_on_crawl_date"))
)
QUERIES |= {f.__name__: f for f in (metric_refusals, metric_by_policy, metric_vocabularies)}
