"""Dimensions, facts and the two deliverables: the complete weekly grid and the monthly like-for-like change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pricelens.functions.text import surrogate_key
from pricelens.operators import history
from pricelens.operators.asof import Calendar
from pricelens.operators.medians import joined, lower_median
from pricelens.sources.tables import materialise

_PCT = "decimal(10,4)"


def _contract(**columns: str) -> T.StructType:
    kinds = {"string": T.StringType(), "date": T.DateType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "price": T.DecimalType(18, 2), "change": T.DecimalType(10, 4)}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in columns.items()])


# Names and types of the tables that clients read.
MICRO_WEEKLY = _contract(
    micro_row_id="string", delivery_date="date", pointer_id="string", sku="string", product_label="string", market="string", currency_code="string", price_local="price",
    previous_price_local="price", change_vs_previous_pct="change", price_status="string", crawl_date_used="date", price_crawl_date="date", is_stale_crawl="boolean", is_price_carried_forward="boolean",
)
MACRO_MONTHLY = _contract(
    macro_row_id="string", report_month="date", as_of_date="date", market="string", macro_category="string", currency_code="string", n_products="int", min_price="price",
    median_price="price", mean_price="price", max_price="price", lfl_n_products="int", lfl_mean_change="change", lfl_ratio_of_means="change", lfl_share_increased="change",
)
PRICE_CHANGES = _contract(
    price_change_id="string", object_id="string", sku="string", market="string", macro_category="string", currency_code="string", changed_on_crawl_date="date",
    price_before="price", price_after="price", change_pct="change", change_direction="string",
)


def dim_market(markets: DataFrame) -> DataFrame:
    return markets.withColumn("is_in_micro_scope", F.col("crawl_cadence") == "weekly")


def dim_product(products: DataFrame, pointers: DataFrame, macro: str = "macro_category") -> DataFrame:
    """Products with whether they count for the monthly view and which watch-list entry they are."""
    watched = products.join(pointers.select("sku", "pointer_id"), "sku", "left")
    return watched.withColumns({"is_in_macro_scope": F.col(macro).isNotNull(), "is_hero": F.col("pointer_id").isNotNull()})


def fct_observations(accepted: DataFrame, columns: Sequence[str] = ("crawl_line_id", "market_batch_id", "object_id", "sku", "market", "crawl_date", "delivered_at", "price_local", "currency_code")) -> DataFrame:
    return accepted.select(*columns)


def fct_catalogue(catalogue: DataFrame) -> DataFrame:
    return catalogue.select("catalogue_row_id", "as_of_date", "market", "object_id", "sku", "presence_crawl_date", "presence_age_days", "price_local", "currency_code", "price_crawl_date", "has_price", "is_price_carried_forward")


def full_grid(listed: DataFrame, *bounded: DataFrame) -> DataFrame:
    """Every combination of the rows of a list of any length, which stays where it is, and of calendars and seeds.

    Only the latter are broadcast: a calendar has a row a day at most, and markets are bounded by the business.
    """
    for side in bounded:
        listed = listed.join(F.broadcast(side))
    return listed


def served_batches(catalogue: DataFrame) -> DataFrame:
    """The crawl that each market was served from at each date."""
    return catalogue.select("as_of_date", "market", "presence_batch_id", "presence_crawl_date").distinct()


def unreadable_pages(classified: DataFrame) -> DataFrame:
    return classified.filter("is_not_a_product_page").select("market_batch_id", "sku").distinct()


def previous_valid(value: str, partition: Sequence[str], order: str):
    """The last value before this row that isn't null."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(value, ignorenulls=True).over(w)


def micro_weekly(dates: DataFrame, pointers: DataFrame, markets: DataFrame, catalogue: DataFrame, unreadable: DataFrame, stale_days: int = 7, served: DataFrame | None = None) -> DataFrame:
    """A row for each date, watched product and market, with price, change and a status for every case (MICRO_WEEKLY).

    Dates without any served crawl in a market stay in the grid as not_found. With ``served`` (see served_batches()) the catalogue need
    hold watched products only.
    """
    grid = full_grid(pointers.select("pointer_id", "sku", "product_label"), dates.select("as_of_date"), markets.select("market", "currency_code"))
    cells = catalogue.select("as_of_date", "market", "sku", "object_id", "presence_crawl_date", "has_price", "price_local", "price_crawl_date", "is_price_carried_forward")
    served = (served_batches(catalogue) if served is None else served).withColumnRenamed("presence_crawl_date", "_served")
    errors = unreadable.select(F.col("market_batch_id").alias("presence_batch_id"), "sku").withColumn("_error", F.lit(True))
    df = grid.join(cells, ["as_of_date", "market", "sku"], "left").join(served, ["as_of_date", "market"], "left").join(errors, ["presence_batch_id", "sku"], "left")
    df = df.withColumns(
        {
            "is_page_error": F.coalesce(F.col("_error"), F.lit(False)) & F.col("object_id").isNull(),
            "crawl_date_used": F.coalesce("presence_crawl_date", "_served"),
            "previous_price_local": previous_valid("price_local", ["pointer_id", "market"], "as_of_date"),
        }
    )
    now, before = F.col("price_local"), F.col("previous_price_local")
    status = (
        F.when(F.col("object_id").isNull(), F.when(F.col("is_page_error"), "page_error").otherwise("not_found"))
        .when(~F.col("has_price"), "no_valid_price")
        .when(before.isNull(), "first_delivery")
        .when(now > before, "price_increase")
        .when(now < before, "price_decrease")
        .otherwise("unchanged")
    )
    return df.select(
        surrogate_key(F.col("as_of_date"), F.col("pointer_id"), F.col("market")).alias("micro_row_id"),
        F.col("as_of_date").alias("delivery_date"), "pointer_id", "sku", "product_label", "market", "currency_code",
        *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("price_local", "previous_price_local")],
        F.round(F.try_divide(now, before) - 1, 4).cast(_PCT).alias("change_vs_previous_pct"),
        status.alias("price_status"), "crawl_date_used", "price_crawl_date",
        F.coalesce(F.date_diff("as_of_date", "crawl_date_used") > stale_days, F.lit(False)).alias("is_stale_crawl"),
        F.coalesce("is_price_carried_forward", F.lit(False)).alias("is_price_carried_forward"),
    )


def month_ends(priced: DataFrame) -> DataFrame:
    """The dates of a monthly table, each with the one before: a calendar of a few hundred rows at most."""
    w = Window.partitionBy(F.lit(1)).orderBy("as_of_date")
    return priced.select("as_of_date").distinct().withColumn("previous_as_of_date", F.lag("as_of_date").over(w))


def with_month_before(priced: DataFrame, calendar: DataFrame, keys: Sequence[str] = ("market", "sku"), price: str = "price_local") -> DataFrame:
    """Priced rows with the key's price at the month end before (null if it had none) and the relative change, by one sort."""
    w = Window.partitionBy(*keys).orderBy("as_of_date")
    rows = priced.withColumns({"_date": F.lag("as_of_date").over(w), "_price": F.lag(price).over(w)})
    out = rows.join(F.broadcast(calendar), "as_of_date").withColumn("price_before", F.when(F.col("_date") == F.col("previous_as_of_date"), F.col("_price")))
    return out.withColumn("product_change", F.try_divide(F.col(price), F.col("price_before")) - 1).drop("_date", "_price")


def lfl_pairs(priced: DataFrame, calendar: DataFrame, keys: Sequence[str] = ("market", "sku"), carry: Sequence[str] = ("macro_category",), price: str = "price_local") -> DataFrame:
    """The same product and market priced at a month end and the one before: price_now, price_before, product_change."""
    rows = with_month_before(priced, calendar, keys, price).filter("price_before is not null")
    return rows.select("as_of_date", "previous_as_of_date", *keys, *[c for c in carry if c not in keys], F.col(price).alias("price_now"), "price_before", "product_change")


def _lfl(now: str) -> list:
    """Pairs, mean of changes, ratio of means and share increased, over the rows that have a price before."""
    change, paired = F.col("product_change"), F.col("price_before").isNotNull()
    return [
        F.count("price_before").alias("lfl_n_products"),
        F.avg(change).alias("lfl_mean_change"),
        (F.try_divide(F.sum(F.when(paired, F.col(now))), F.sum("price_before")) - 1).alias("lfl_ratio_of_means"),
        F.avg(F.when(paired, F.when(change > 0, 1.0).otherwise(0.0))).alias("lfl_share_increased"),
    ]


def lfl_metrics(pairs: DataFrame, by: Sequence[str] = ("as_of_date", "market", "macro_category")) -> DataFrame:
    return pairs.groupBy(*by).agg(*_lfl("price_now"))


def _levels(price: str, times: str) -> list:
    return [
        F.sum(times).alias("n_products"), F.min(price).alias("min_price"),
        F.round(F.sum(F.col(price) * F.col(times)) / F.sum(times), 2).alias("mean_price"), F.max(price).alias("max_price"),
    ]


def price_levels(priced: DataFrame, by: Sequence[str] = ("as_of_date", "market", "macro_category"), price: str = "price_local") -> DataFrame:
    """Number, least, mean, greatest and (lower, exact) median price of each group."""
    held = priced.filter(F.col(price).isNotNull()).groupBy(*by, price).agg(F.count(F.lit(1)).alias("_n"))
    return joined(held.groupBy(*by).agg(*_levels(price, "_n")), lower_median(held, by, price, "median_price", "_of", "_n").drop("_of"), by)


def macro_monthly(priced: DataFrame, markets: DataFrame, calendar: DataFrame | None = None, by: Sequence[str] = ("as_of_date", "market", "macro_category"), keys: Sequence[str] = ("market", "sku")) -> DataFrame:
    """Price levels and like-for-like change of each month end, market and category (MACRO_MONTHLY), in one pass over the prices.

    Without a calendar (month_ends()) the dates of the table are looked up first. If ``priced`` is laid out by ``keys``, as by the as-of
    look-up, only the aggregates are shuffled.
    """
    rows = with_month_before(priced, month_ends(priced) if calendar is None else calendar, keys)
    return _monthly(rows, markets, by)


def macro_monthly_of_periods(calendar: Calendar, periods: DataFrame, markets: DataFrame, by: Sequence[str] = ("as_of_date", "market", "macro_category"), key: str = "object_id") -> DataFrame:
    """macro_monthly() from the stretches of a calendar's month ends in which a price is known (asof.known_periods()).

    Within a stretch the price of the month before is the same, at its start that of the stretch before, so only stretches are sorted.
    A stretch adds to the counts and sums of its price where it begins and ends, and these are running sums: rows by product and month
    are not made.
    """
    w = Window.partitionBy(key, "chain").orderBy("start")
    rows = periods.withColumn("_before", F.when(F.lag("end").over(w) == F.col("start"), F.lag("price_local").over(w)))
    change = F.try_divide("price_local", "_before") - 1
    kinds = {"_n": "bigint", "_rest": "bigint", "_first": "bigint", "_changes": rows.select(change).schema[0].dataType, "_up": "bigint", "_was": rows.schema["price_local"].dataType}

    def event(at: Column, **x: Column) -> Column:
        return F.struct(at.cast("int").alias("at"), *[x.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()])

    one, less, lasts = F.lit(1), F.lit(-1), (F.col("end") > F.col("start") + 1) & F.col("price_local").isNotNull()
    begins = event(F.col("start"), _n=one, _first=F.when(F.col("_before").isNotNull(), 1), _changes=change, _up=F.when(change > 0, 1), _was=F.col("_before"))
    events = F.array_compact(F.array(begins, F.when(lasts, event(F.col("start") + 1, _rest=one)), event(F.col("end"), _n=less, _rest=F.when(lasts, less))))
    group = [*by[1:], "price_local", "chain"]
    sums = rows.select(*group, F.explode(events).alias("_e")).groupBy(*group, F.col("_e.at").alias("_at")).agg(*[F.sum(f"_e.{c}").alias(c) for c in kinds])
    # From here on there is a row for each price and month end at most, however many products have it.
    w = Window.partitionBy(*group).orderBy("_at")
    held = {c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0)) for c in ("_n", "_rest")}
    until = F.coalesce(F.lead("_at").over(w), calendar.size(F.col("chain")))
    out = sums.withColumns(held | {"_until": until}).filter("_n > 0 and _until > _at").withColumn("_on", F.explode(F.sequence("_at", F.col("_until") - 1)))
    new = {c: F.when(F.col("_on") == F.col("_at"), F.col(c)) for c in ("_first", "_changes", "_up", "_was")}
    out = out.withColumns(new | {"as_of_date": calendar.day(F.col("chain"), F.col("_on"))})
    zero, price = F.lit(0), F.col("price_local")
    pairs = F.coalesce("_first", zero) + F.col("_rest")
    held_price = F.when(F.col("_rest") > 0, price * F.col("_rest"))
    was = F.when(pairs > 0, F.coalesce("_was", zero) + F.coalesce(held_price, zero))
    parts = out.select(
        *by, "price_local", "_n", pairs.alias("_pairs"), F.when(pairs > 0, F.coalesce("_changes", zero)).alias("_changes"), F.coalesce("_up", zero).alias("_up"),
        F.when(pairs > 0, price * pairs).alias("_now"), was.alias("_before"),
    )
    if len(calendar.days) > 1:  # a date can be on several staircases
        parts = parts.groupBy(*by, "price_local").agg(*[F.sum(c).alias(c) for c in parts.columns if c not in (*by, "price_local")])
    return _of_prices(parts, markets, by)


def _monthly(rows: DataFrame, markets: DataFrame, by: Sequence[str]) -> DataFrame:
    """The monthly table from priced rows with price_before and product_change."""
    # Sums by price first: they are what totals and medians are made from, and large groups are dealt out by them.
    change, paired = F.col("product_change"), F.col("price_before").isNotNull()
    parts = rows.groupBy(*by, "price_local").agg(
        F.count(F.lit(1)).alias("_n"), F.count("price_before").alias("_pairs"), F.sum(change).alias("_changes"), F.count_if(change > 0).alias("_up"),
        F.sum(F.when(paired, F.col("price_local"))).alias("_now"), F.sum("price_before").alias("_before"),
    )
    return _of_prices(parts, markets, by)


def _of_prices(parts: DataFrame, markets: DataFrame, by: Sequence[str]) -> DataFrame:
    """The monthly table from the counts and sums of each price in a group."""
    parts = materialise(parts, "by-price")
    totals = parts.groupBy(*by).agg(
        *_levels("price_local", "_n"), F.sum("_pairs").alias("lfl_n_products"), F.try_divide(F.sum("_changes"), F.sum("_pairs")).alias("lfl_mean_change"),
        (F.try_divide(*[F.sum(c).cast("decimal(28,2)") for c in ("_now", "_before")]) - 1).alias("lfl_ratio_of_means"), F.try_divide(F.sum("_up").cast("double"), F.sum("_pairs")).alias("lfl_share_increased"),
    )
    out = joined(totals, lower_median(parts, by, "price_local", "median_price", "_of", "_n").drop("_of"), by).withColumn("report_month", F.trunc("as_of_date", "MM"))
    out = out.join(F.broadcast(markets.select("market", "currency_code")), "market", "left")
    return out.select(
        surrogate_key(F.col("report_month"), *[F.col(c) for c in by[1:]]).alias("macro_row_id"), "report_month", *by, "currency_code",
        F.col("n_products").cast("int").alias("n_products"),
        *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("min_price", "median_price", "mean_price", "max_price")],
        F.col("lfl_n_products").cast("int").alias("lfl_n_products"),
        *[F.round(c, 4).cast(_PCT).alias(c) for c in ("lfl_mean_change", "lfl_ratio_of_means", "lfl_share_increased")],
    )


def price_changes(periods: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Change events of price periods or changed readings (PRICE_CHANGES), with the product's category; without ``products`` they have it."""
    events = history.change_events(periods, "price_local", products if products is None else products.select("sku", "macro_category"))
    renamed = {"price_period_id": "price_change_id", "valid_from": "changed_on_crawl_date", "previous_price_local": "price_before", "price_local": "price_after", "change_vs_previous": "change_pct", "direction": "change_direction"}
    out = events.withColumnsRenamed(renamed)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PRICE_CHANGES])


def macro_global(monthly: DataFrame) -> DataFrame:
    """Each month and category over all markets: market-weighted and product-weighted change, extremes, the highest market."""
    change, n = F.col("lfl_mean_change"), F.col("lfl_n_products")
    return monthly.filter(n > 0).groupBy("report_month", "macro_category").agg(
        F.count(F.lit(1)).cast("int").alias("n_markets"),
        F.sum(n).cast("int").alias("lfl_n_product_markets"),
        F.round(F.avg(change), 4).cast(_PCT).alias("market_weighted_lfl_change"),
        F.round(F.try_divide(F.sum(change * n), F.sum(n)), 4).cast(_PCT).alias("product_weighted_lfl_change"),
        F.min(change).alias("min_market_lfl_change"),
        F.max(change).alias("max_market_lfl_change"),
        F.max_by("market", F.struct(change, "market")).alias("market_with_highest_change"),
    ).withColumn("macro_global_row_id", surrogate_key(F.col("report_month"), F.col("macro_category")))


def latest_results(results: DataFrame, keys: Sequence[str] = ("dataset", "scope", "as_of_date")) -> DataFrame:
    """The check rows of each delivery's latest run."""
    latest = results.groupBy(*keys).agg(F.max_by("run_id", F.struct("checked_at", "run_id")).alias("run_id"))
    return results.join(latest, [*keys, "run_id"], "left_semi")


def delivery_health(results: DataFrame, releases: DataFrame, keys: Sequence[str] = ("dataset", "scope", "as_of_date")) -> DataFrame:
    """By delivery: checks by status, which don't pass, the decision, and whether it is published."""
    bad = F.col("status").isin("warn", "fail")
    health = latest_results(results, keys).groupBy(*keys).agg(
        *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("pass", "warn", "fail", "skip")],
        F.sort_array(F.collect_set(F.when(bad, F.col("check_id")))).alias("checks_not_passing"),
        F.bool_or((F.col("status") == "fail") & (F.col("severity") == "block")).alias("_blocked"),
        F.bool_or(bad).alias("_warned"),
    )
    decision = F.when(F.col("_blocked"), "BLOCK").when(F.col("_warned"), "WARN").otherwise("PASS")
    released = releases.groupBy("scope", "as_of_date").agg(F.max_by("decision", F.struct("released_at", "release_id")).alias("released_as"), F.bool_or("is_forced").alias("is_forced"))
    out = health.withColumn("decision", decision).drop("_blocked", "_warned").join(released, ["scope", "as_of_date"], "left")
    state = F.when(F.col("released_as").isNull(), "not_published").when(F.col("is_forced"), "published_by_force").otherwise("published")
    return out.withColumn("publication_state", state)
