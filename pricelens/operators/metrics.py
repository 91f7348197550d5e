"""Governed metrics: one definition for each number, queried as groupBy and agg over a published table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 500

_AGGREGATES = {
    "sum": F.sum,
    "average": F.avg,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "count_distinct": F.count_distinct,
    "sum_boolean": lambda c: F.sum(c.cast("int")),
}


@dataclass(frozen=True)
class Measure:
    agg: str
    expr: str

    def column(self) -> Column:
        return _AGGREGATES[self.agg](F.expr(self.expr))


@dataclass(frozen=True)
class SemanticModel:
    name: str
    time: str
    dimensions: tuple[str, ...]
    measures: Mapping[str, Measure]


@dataclass(frozen=True)
class Metric:
    """A measure, or the ratio of two metrics."""

    name: str
    model: str
    measure: str | None = None
    ratio: tuple[str, str] | None = None
    unit: str = "count"
    requires: tuple[str, ...] = ()
    level: bool = False
    latest: bool = True
    hidden: bool = False
    default_group_by: tuple[str, ...] = ()


# Models, measures and metrics.
MODELS = {
    m.name: m
    for m in (
        SemanticModel(
            "hero_prices", "delivery_date", ("pointer_id", "product_label", "market", "currency_code", "price_status"),
            {
                "hero_price_local": Measure("average", "price_local"),
                "hero_change_vs_previous": Measure("average", "change_vs_previous_pct"),
                "hero_price_increase_cells": Measure("sum_boolean", "price_status = 'price_increase'"),
            },
        ),
        SemanticModel(
            "category_monthly", "report_month", ("market", "macro_category", "currency_code"),
            {
                "market_lfl_change": Measure("average", "lfl_mean_change"),
                "lfl_change_x_products": Measure("sum", "lfl_mean_change * lfl_n_products"),
                "lfl_products": Measure("sum", "if(lfl_mean_change is not null, lfl_n_products, 0)"),
                "products_listed": Measure("sum", "n_products"),
                "category_median_price_local": Measure("average", "median_price"),
                "share_of_products_increased": Measure("average", "lfl_share_increased"),
            },
        ),
        SemanticModel(
            "price_changes", "changed_on_crawl_date", ("market", "macro_category", "change_direction"),
            {"price_change_events": Measure("count", "price_change_id"), "price_change_pct": Measure("average", "change_pct")},
        ),
    )
}
METRICS = {
    m.name: m
    for m in (
        Metric("hero_price", "hero_prices", "hero_price_local", unit="currency", requires=("market",), level=True),
        Metric("hero_price_change", "hero_prices", "hero_change_vs_previous", unit="percent"),
        Metric("hero_price_increases", "hero_prices", "hero_price_increase_cells"),
        Metric("category_lfl_change", "category_monthly", "market_lfl_change", unit="percent"),
        Metric("category_lfl_change_product_weighted", "category_monthly", ratio=("lfl_weighted_numerator", "lfl_weighted_denominator"), unit="percent"),
        Metric("lfl_weighted_numerator", "category_monthly", "lfl_change_x_products", hidden=True),
        Metric("lfl_weighted_denominator", "category_monthly", "lfl_products", hidden=True),
        Metric("category_product_count", "category_monthly", "products_listed", level=True),
        Metric("category_median_price", "category_monthly", "category_median_price_local", unit="currency", requires=("market",), level=True),
        Metric("category_share_increased", "category_monthly", "share_of_products_increased", unit="percent"),
        Metric("price_change_count", "price_changes", "price_change_events", latest=False),
        Metric("average_price_change", "price_changes", "price_change_pct", unit="percent", latest=False),
    )
}


@dataclass(frozen=True)
class Request:
    metric: str
    group_by: tuple[str, ...] = ()
    by_time: bool = False
    filters: Mapping[str, Sequence[str]] = field(default_factory=dict)
    start: dt.date | None = None
    end: dt.date | None = None
    descending: bool = True


class Refused(ValueError):
    """A request that has no governed answer."""


def metric_col(name: str, metrics: Mapping[str, Metric] = METRICS, models: Mapping[str, SemanticModel] = MODELS) -> Column:
    m = metrics[name]
    if m.ratio:
        top, bottom = (metric_col(x, metrics, models) for x in m.ratio)
        return F.try_divide(top, F.nullif(bottom, F.lit(0)))
    return models[m.model].measures[m.measure].column()


def query_metric(df: DataFrame, request: Request, metrics: Mapping[str, Metric] = METRICS, models: Mapping[str, SemanticModel] = MODELS, limit: int = LIMIT) -> DataFrame:
    """The metric by the requested groups: filters and the inclusive period before, at most ``limit`` rows after."""
    m = metrics[request.metric]
    time = models[m.model].time
    for c, values in request.filters.items():
        df = df.filter(F.col(c).isin(*values))
    if request.start is not None:
        df = df.filter(F.col(time) >= F.lit(request.start))
    if request.end is not None:
        df = df.filter(F.col(time) <= F.lit(request.end))
    groups = [*([time] if request.by_time else []), *request.group_by]
    out = df.groupBy(*groups).agg(metric_col(request.metric, metrics, models).alias(request.metric))
    value = F.desc_nulls_last(request.metric) if request.descending else F.asc_nulls_last(request.metric)
    order = [*groups] if request.by_time else [value, *groups]
    return out.orderBy(*order).limit(limit) if groups else out


def vocabulary(df: DataFrame, model: SemanticModel) -> DataFrame:
    """dimension and value: the distinct values of every dimension, and the periods as ISO dates."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in (*model.dimensions, model.time) if d in df.columns])
    return df.select(F.explode(pairs).alias("x")).select("x.*").filter("value is not null").distinct()


def check_request(request: Request, known: DataFrame, metrics: Mapping[str, Metric] = METRICS, models: Mapping[str, SemanticModel] = MODELS) -> None:
    """Refuse what isn't governed: unknown or hidden metrics, foreign dimensions, values that don't exist, mixed currencies, periods without data."""
    m = metrics.get(request.metric)
    if m is None or m.hidden:
        raise Refused(f"{request.metric} is not a governed metric")
    model = models[m.model]
    foreign = sorted({*request.group_by, *request.filters} - {*model.dimensions})
    if foreign:
        raise Refused(f"{request.metric} has no {', '.join(foreign)}")
    asked = [(d, v) for d, values in request.filters.items() for v in values]
    if any(not values for values in request.filters.values()):
        raise Refused("empty filter")
    if asked:
        wanted = known.sparkSession.createDataFrame(asked, "dimension string, value string")
        unknown = wanted.join(known, ["dimension", "value"], "left_anti").limit(5).collect()
        if unknown:
            raise Refused("unknown: " + ", ".join(f"{r['dimension']} {r['value']}" for r in unknown))
    for d in m.requires:
        if d not in request.group_by and len(request.filters.get(d, ())) != 1:
            raise Refused(f"{request.metric} is in local currency: one {d} at a time")
    if request.start and request.end:
        if request.start > request.end:
            raise Refused("the period ends before it starts")
        first, last = known.filter(F.col("dimension") == model.time).agg(F.min("value"), F.max("value")).first()
        if first is None or str(request.end) < first or str(request.start) > last:
            raise Refused("no published data in this period")


#: Dimensions that are properties of another one, which is shown in their place.
STANDS_FOR = {"currency_code": "market"}


def period_view(metric: Metric, is_asked: bool, n_periods: int) -> str:
    """How a metric over so many periods is shown: the "last" of them, "each" of them, or "all" of them as one.

    ========================  ===========  =================
    periods                   one          several
    ========================  ===========  =================
    none asked for            last (all if the metric is over its whole history)
    asked, a level            last         last
    asked, in percent         last         each
    asked, anything else      last         all
    ========================  ===========  =================
    """
    if not n_periods or not (is_asked or metric.latest):
        return "all"
    if not is_asked or n_periods == 1 or metric.level:
        return "last"
    return "each" if metric.unit == "percent" else "all"


def shown_dimensions(metric: Metric, model: SemanticModel, request: Request) -> tuple[str, ...]:
    """What a request is split by: the dimensions named, those with several values asked for, and those without which the metric has no
    meaning; the metric's own defaults where the request names none. A dimension held at one value splits nothing, and time is no
    dimension here.
    """
    chosen = {d: len(values) for d, values in request.filters.items()}
    splits = lambda d: d in model.dimensions and chosen.get(d) != 1
    named = [STANDS_FOR.get(d, d) for d in request.group_by if chosen.get(d) != 1] + [d for d, n in chosen.items() if n > 1]
    named = [d for d in named if splits(d)]
    own = () if named or request.by_time else metric.default_group_by
    return tuple(dict.fromkeys(d for d in (*named, *own, *metric.requires) if splits(d)))


def apply_policy(request: Request, periods: Sequence[dt.date], metrics: Mapping[str, Metric] = METRICS, models: Mapping[str, SemanticModel] = MODELS) -> Request:
    """A request as it is shown, whoever made it: its dimensions (shown_dimensions()) and its periods (period_view()).

    A request for one date means that date; one that asks for a row a period keeps its range as it is.
    """
    metric = metrics[request.metric]
    bounds = [d for d in (request.start, request.end) if d is not None]
    covered = sorted(p for p in periods if not bounds or bounds[0] <= p <= bounds[-1])
    view = "each" if request.by_time else period_view(metric, bool(bounds), len(covered))
    start, end = (covered[-1],) * 2 if view == "last" else (bounds[0], bounds[-1]) if bounds else (None, None)
    return replace(request, group_by=shown_dimensions(metric, models[metric.model], request), by_time=view == "each", start=start, end=end)
