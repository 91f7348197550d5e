"""The delivery gate: checks as measures over the whole calendar, thresholds, anomalies, decisions, releases."""

from __future__ import annotations

import datetime as dt
import uuid
from bisect import bisect_left
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pricelens.operators.asof import Calendar, constants
from pricelens.sources.tables import materialise

SCOPES = ("micro", "macro")
DATASETS = ("marts", "legacy_replay")
SEVERITIES = ("block", "warn")


def _schema(text: str) -> T.StructType:
    """'name type, ...' as a schema, without a session."""
    kinds = {"string": T.StringType(), "timestamp": T.TimestampType(), "date": T.DateType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split() for x in text.split(","))])


RESULTS = _schema(
    "run_id string, checked_at timestamp, dataset string, scope string, as_of_date date, check_id string, dimension string, severity string, subject string, "
    "observed double, warn_rule string, fail_rule string, status string, message string"
)
RELEASES = _schema("release_id string, scope string, as_of_date date, run_id string, decision string, is_forced boolean, reason string, released_at timestamp, released_by string")
#: Spread that a flat history is taken to have at least.
MIN_SPREAD = 0.005


@dataclass(frozen=True)
class Context:
    """What checks measure: deliveries (scope, as_of_date, prev_date, prev2_date), scoped catalogue, markets and marts.

    The catalogue comes as rows by date, or as ``stretches`` (see stretches_of_periods()), which the counts are then made from.
    """

    deliveries: DataFrame
    scoped: DataFrame | None
    markets: DataFrame
    micro: DataFrame | None = None
    macro: DataFrame | None = None
    macro_global: DataFrame | None = None
    #: by_market() of the catalogue, if it has been written.
    counted: DataFrame | None = None
    stretches: DataFrame | None = None

    @cached_property
    def markets_of(self) -> DataFrame:
        return by_market(self.scoped) if self.counted is None else self.counted

    @cached_property
    def dates(self) -> list[list[dt.date]]:
        return dates_of(self.deliveries)

    @cached_property
    def sizes(self) -> DataFrame:
        """Rows and age of each delivery and market, whatever they are held against."""
        return materialise(self.markets_of.select("scope", "as_of_date", "market", "n", "age_days"), "sizes")

    @cached_property
    def shelves(self) -> DataFrame:
        """Priced stretches by object, written once for all bases that are asked about."""
        rows = stretches_of_rows(self.dates, self.scoped) if self.stretches is None else self.stretches
        return materialise(shelves_of(rows), "shelves")

    def against(self, bases: DataFrame) -> Context:
        """This context with its counts held against ``bases`` (see by_market_of_shelves())."""
        return replace(self, counted=by_market_of_shelves(self.dates, self.shelves, self.sizes, bases))


@dataclass(frozen=True)
class Anomaly:
    window: int = 6
    min_history: int = 3
    z: float = 3.0
    min_value: float = 0.0


@dataclass(frozen=True)
class Rules:
    warn_above: float | None = None
    warn_below: float | None = None
    fail_above: float | None = None
    fail_below: float | None = None
    anomaly: Anomaly | None = None

    def describe(self) -> tuple[str, str]:
        """The rules in words, stored with each result."""

        def side(name: str) -> str:
            bounds = ((sign, getattr(self, f"{name}_{where}")) for sign, where in (("<", "below"), (">", "above")))
            return " or ".join(f"{sign} {x:g}" for sign, x in bounds if x is not None)

        warn = side("warn")
        if self.anomaly:
            usual = f"> {self.anomaly.z:g} spreads above the mean of {self.anomaly.window} earlier deliveries"
            warn = f"{warn} or {usual}" if warn else usual
        return warn, side("fail")


@dataclass(frozen=True)
class Check:
    id: str
    dimension: str
    severity: str
    measure: Callable[[Context], DataFrame]
    rules: Rules | Mapping[str, Rules]
    scopes: tuple[str, ...] = SCOPES
    datasets: tuple[str, ...] = DATASETS
    #: Whether it holds a delivery against those before it.
    compares: bool = False

    def __post_init__(self) -> None:
        if self.severity not in SEVERITIES or not self.scopes or not set(self.scopes) <= set(SCOPES) or not set(self.datasets) <= set(DATASETS):
            raise ValueError(f"{self.id}: severity, scopes or datasets are none that the gate knows")
        for scope in self.scopes:
            if not isinstance(self.rules, Rules) and scope not in self.rules:
                raise ValueError(f"{self.id} lacks rules for {scope}")
            rules = self.rules_for(scope)
            if rules == Rules():
                raise ValueError(f"{self.id} has no rule for {scope}")
            if self.severity == "warn" and (rules.fail_above, rules.fail_below) != (None, None):
                raise ValueError(f"{self.id} only warns, so it can't fail")

    def rules_for(self, scope: str) -> Rules:
        return self.rules if isinstance(self.rules, Rules) else self.rules[scope]


def delivery_calendar(dates: DataFrame) -> DataFrame:
    """scope, as_of_date and the two deliveries before; a calendar is a few rows a week."""
    w = Window.partitionBy("scope").orderBy("as_of_date")
    return dates.select("scope", "as_of_date").distinct().withColumns({"prev_date": F.lag("as_of_date", 1).over(w), "prev2_date": F.lag("as_of_date", 2).over(w)})


def scoped(calendar: DataFrame, catalogue: DataFrame, markets: DataFrame) -> DataFrame:
    """Catalogue rows of each delivery, of the markets in its scope."""
    rows = catalogue.join(F.broadcast(calendar), "as_of_date").join(F.broadcast(markets.select("market", "is_in_micro_scope")), "market")
    return rows.filter((F.col("scope") != "micro") | F.col("is_in_micro_scope")).drop("is_in_micro_scope")


def _out(df: DataFrame, subject: str | Column, observed: Column, scope: str | None = None, date: str = "as_of_date", by: Sequence[str] = ()) -> DataFrame:
    """Measure rows: scope, as_of_date, subject, observed; and case, if counts are held against several bases."""
    if scope is not None:
        df = df.withColumn("scope", F.lit(scope))
    case = [c for c in ("case",) if c in df.columns]
    grouped = df.groupBy("scope", F.col(date).alias("as_of_date"), *case, *by).agg(observed.cast("double").alias("observed"))
    name = F.lit("all") if subject == "all" else F.col(subject)
    return grouped.select("scope", "as_of_date", *case, name.cast("string").alias("subject"), "observed")


def _share(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def by_market(rows: DataFrame) -> DataFrame:
    """What the catalogue checks count, by delivery and market, in one pass over the scoped catalogue: n, n_before (at the delivery
    before), age_days, and of the rows priced now and at the delivery before (n1) those changed and fallen, and of those priced at
    the one before that too (n2) those reverted. A row for each delivery and market, however large the catalogue is.
    """
    w = Window.partitionBy("scope", "object_id").orderBy("as_of_date")
    df = rows.withColumns({f"_{c}{i}": F.lag(c, i).over(w) for c in ("as_of_date", "price_local") for i in (1, 2)})
    p1 = F.when(F.col("_as_of_date1") == F.col("prev_date"), F.col("_price_local1"))
    p2 = F.when((F.col("_as_of_date1") == F.col("prev_date")) & (F.col("_as_of_date2") == F.col("prev2_date")), F.col("_price_local2"))
    df = df.withColumns({"p1": p1, "p2": F.when(p1.isNotNull(), p2)})
    now, a, b = F.col("price_local"), F.col("p1"), F.col("p2")
    out = df.groupBy("scope", "as_of_date", "prev_date", "market").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.date_diff("as_of_date", "served_crawl_date")).alias("age_days"),
        F.count_if(now.isNotNull() & a.isNotNull()).alias("n1"), F.count_if(now != a).alias("changed"), F.count_if(now < a).alias("fallen"),
        F.count_if(now.isNotNull() & b.isNotNull()).alias("n2"), F.count_if((now != a) & (now == b)).alias("reverted"),
    )
    # From a few rows for each delivery: the market's row before, if it is of the delivery before.
    past = Window.partitionBy("scope", "market").orderBy("as_of_date")
    return out.withColumn("n_before", F.when(F.lag("as_of_date").over(past) == F.col("prev_date"), F.lag("n").over(past)))


def dates_of(deliveries: DataFrame) -> list[list[dt.date]]:
    """Each scope's deliveries in order: a few rows a week, which come to the driver."""
    days = sorted((r["scope"], r["as_of_date"]) for r in deliveries.select("scope", "as_of_date").distinct().collect())
    return [[d for s, d in days if s == scope] for scope in SCOPES]


def stretches_of_periods(calendar: Calendar, dates: list[list[dt.date]], periods: DataFrame, markets: DataFrame) -> DataFrame:
    """The catalogue's periods in each scope that their market belongs to, with the numbers of its deliveries that they cover: from
    first up to past. A delivery is a date with one cutoff, so the calendar must be one staircase.
    """
    if len(calendar.days) > 1:
        raise ValueError("a delivery is a date with one cutoff")
    days = [dt.date(1970, 1, 1) + dt.timedelta(x) for chain in calendar.days for x in chain]
    before = constants([[bisect_left(of, d) for d in days] + [len(of)] for of in dates], "array<array<int>>")
    place = lambda at: F.get(F.get(before, F.col("_s")), F.col(at))
    both = F.explode(F.when(F.col("is_in_micro_scope"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))))
    rows = periods.join(F.broadcast(markets.select("market", "is_in_micro_scope")), "market").withColumn("_s", both)
    rows = rows.withColumns({"scope": F.get(F.array(*map(F.lit, SCOPES)), F.col("_s")), "first": place("start"), "past": place("end")})
    return rows.filter("first < past").select("scope", "market", "object_id", "first", "past", "price_local", F.col("presence_crawl_date").alias("served_crawl_date"))


def stretches_of_rows(dates: list[list[dt.date]], scoped: DataFrame) -> DataFrame:
    """Catalogue rows as stretches of one delivery each."""
    numbered = [(s, d, i, i + 1) for s, of in zip(SCOPES, dates, strict=True) for i, d in enumerate(of)]
    table = scoped.sparkSession.createDataFrame(numbered, "scope string, as_of_date date, first int, past int")
    return scoped.join(F.broadcast(table), ["scope", "as_of_date"]).select("scope", "market", "object_id", "first", "past", "price_local", "served_crawl_date")


def _by_scope(values: list, kind: str) -> Column:
    return F.get(constants(values, f"array<{kind}>"), F.when(F.col("scope") == SCOPES[0], 0).otherwise(1))


def by_market_of_stretches(dates: list[list[dt.date]], rows: DataFrame) -> DataFrame:
    """by_market() from stretches: each adds to a few deliveries where a count begins or ends to hold, and the counts are the running
    sums. Work grows with stretches, not with the deliveries that they last.

    Rows priced at two or three deliveries in a row are chains of priced stretches without a gap; prices change, fall or come back
    only where one stretch follows another at once.
    """
    w = Window.partitionBy("scope", "object_id").orderBy("first")
    ago = lambda c, i: F.lag(c, i).over(w)
    rows = rows.withColumns(
        {"_f1": ago("first", 1), "_e1": ago("past", 1), "_p1": ago("price_local", 1), "_e2": ago("past", 2), "_p2": ago("price_local", 2)}
    )
    p, one, two = F.col("price_local"), F.col("_p1"), F.col("_p2")
    follows = F.coalesce(F.col("_e1") == F.col("first"), F.lit(False)) & one.isNotNull() & p.isNotNull()
    brief = follows & (F.col("_e1") - F.col("_f1") == 1)
    again = brief & F.coalesce(F.col("_e2") == F.col("_f1"), F.lit(False)) & two.isNotNull()
    run = F.when(~follows, 0).when(brief & ~again, 1).otherwise(2)  # deliveries priced just before, as far as they matter
    # Stretches that count alike are put together first: what follows has a row for each pair of deliveries and kind at most.
    flag = lambda what: F.when(follows & what, 1).otherwise(0).cast("int")
    alike = {"_run": run.cast("int"), "_priced": p.isNotNull(), "_changed": flag(p != one), "_fallen": flag(p < one), "_reverted": F.when(again & (p != one) & (p == two), 1).otherwise(0).cast("int")}
    kinds = rows.withColumns(alike).groupBy("scope", "market", "first", "past", *alike).agg(F.count(F.lit(1)).alias("_k"), F.min("served_crawl_date").alias("_served"))
    rows = materialise(kinds, "stretches")
    counts = ("n", "n1", "n2", "changed", "fallen", "reverted")
    event = lambda at, **x: F.struct(at.cast("int").alias("at"), *[(x.get(c, F.lit(0)) * F.col("_k")).cast("bigint").alias(c) for c in counts])
    first, past, run, yes, no = F.col("first"), F.col("past"), F.col("_run"), F.lit(1), F.lit(-1)
    begins1, begins2 = first + F.greatest(F.lit(0), 1 - run), first + F.greatest(F.lit(0), 2 - run)
    held = lambda since: F.col("_priced") & (since < past)
    events = F.array_compact(
        F.array(
            event(first, n=yes, changed=F.col("_changed"), fallen=F.col("_fallen"), reverted=F.col("_reverted")),
            F.when(held(begins1), event(begins1, n1=yes)),
            F.when(held(begins2), event(begins2, n2=yes)),
            event(past, n=no, n1=F.when(held(begins1), -1).otherwise(0), n2=F.when(held(begins2), -1).otherwise(0)),
        )
    )
    sums = rows.select("scope", "market", F.explode(events).alias("_e")).groupBy("scope", "market", F.col("_e.at").alias("at"))
    sums = sums.agg(*[F.sum(f"_e.{c}").alias(c) for c in counts])
    # From here on there is a row for each market and delivery at most.
    w = Window.partitionBy("scope", "market").orderBy("at")
    held_so_far = {c: F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for c in counts[:3]}
    until = F.coalesce(F.lead("at").over(w), _by_scope([len(x) for x in dates], "int"))
    out = sums.withColumns(held_so_far | {"_until": until}).filter("_until > at").withColumn("_at", F.explode(F.sequence("at", F.col("_until") - 1)))
    out = out.withColumns({c: F.when(F.col("_at") == F.col("at"), F.col(c)).otherwise(0) for c in counts[3:]}).filter("n > 0")
    day = lambda at: F.to_date(F.get(_by_scope([[str(d) for d in x] for x in dates], "array<string>"), at))
    served = rows.groupBy("scope", "market", "first", "past").agg(F.min("_served").alias("_served"))
    served = served.withColumn("_at", F.explode(F.sequence("first", F.col("past") - 1))).groupBy("scope", "market", "_at").agg(F.min("_served").alias("_served"))
    out = out.join(served, ["scope", "market", "_at"])
    past_w = Window.partitionBy("scope", "market").orderBy("_at")
    n_before = F.when(F.lag("_at").over(past_w) == F.col("_at") - 1, F.lag("n").over(past_w))
    dated = {"as_of_date": day(F.col("_at")), "prev_date": F.when(F.col("_at") > 0, day(F.col("_at") - 1)), "n_before": n_before}
    out = out.withColumns(dated).withColumn("age_days", F.date_diff("as_of_date", "_served"))
    return out.select("scope", "as_of_date", "prev_date", "market", "n", "age_days", "n1", "changed", "fallen", "n2", "reverted", "n_before")


def shelves_of(rows: DataFrame) -> DataFrame:
    """The priced stretches of each object in a scope, in one row: held, with first, past, market and price_local."""
    held = F.struct("first", "past", "market", "price_local")
    return rows.filter("price_local is not null").groupBy("scope", "object_id").agg(F.collect_list(held).alias("held"))


def by_market_against(dates: list[list[dt.date]], rows: DataFrame, bases: DataFrame) -> DataFrame:
    """by_market_of_shelves() from stretches, for bases that are asked about once."""
    return by_market_of_shelves(dates, shelves_of(rows), by_market_of_stretches(dates, rows).select("scope", "as_of_date", "market", "n", "age_days"), bases)


def by_market_of_shelves(dates: list[list[dt.date]], shelves: DataFrame, sizes: DataFrame, bases: DataFrame) -> DataFrame:
    """by_market() of deliveries held against others than the two before them, with the column case.

    ``bases`` has case, scope, as_of_date, prev_date and prev2_date (nulls: none), any number of rows for a delivery; like the calendar
    it is small. How many rows a delivery and market have (``sizes``) depends on no base. Prices are compared within an object's own
    row (see shelves_of()) and counted at once, so that no object's rows by case are shuffled.
    """
    number = {(scope, d): i for scope, of in zip(SCOPES, dates, strict=True) for i, d in enumerate(of)}
    asked = [(r["scope"], number[r["scope"], r["as_of_date"]], r["case"], *[number.get((r["scope"], d)) for d in (r["prev_date"], r["prev2_date"])]) for r in bases.collect()]
    asked = [x for x in asked if x[3] is not None]  # without the first base no price is compared
    table = shelves.sparkSession.createDataFrame(asked, "scope string, at int, case int, one int, two int")
    covers = lambda x, at: (x["first"] <= F.col(at)) & (F.col(at) < x["past"])
    at = lambda c, spot: F.array_max(F.transform(F.filter("held", lambda x: covers(x, spot)), lambda x: x[c]))
    spots = F.array_distinct(F.flatten(F.transform("held", lambda x: F.sequence(x["first"], x["past"] - 1))))
    # An object that is priced at one delivery alone has nothing to be compared with.
    rows = shelves.select("scope", "held", spots.alias("_spots")).filter(F.size("_spots") > 1).select("scope", "held", F.explode("_spots").alias("at"))
    rows = rows.withColumns({"market": at("market", "at"), "p": at("price_local", "at")}).join(F.broadcast(table), ["scope", "at"])
    rows = rows.withColumn("p1", at("price_local", "one")).filter("p1 is not null").withColumn("p2", at("price_local", "two"))
    p, a, b = F.col("p"), F.col("p1"), F.col("p2")
    pairs = rows.groupBy("case", "market").agg(
        F.count(F.lit(1)).alias("n1"), F.count_if(p != a).alias("changed"), F.count_if(p < a).alias("fallen"),
        F.count(b).alias("n2"), F.count_if((p != a) & (p == b)).alias("reverted"),
    )
    # From here on there is a row for each case and market at most.
    before = sizes.select("scope", F.col("as_of_date").alias("prev_date"), "market", F.col("n").alias("n_before"))
    out = sizes.join(F.broadcast(bases), ["scope", "as_of_date"]).join(F.broadcast(before), ["scope", "prev_date", "market"], "left").join(pairs, ["case", "market"], "left")
    out = out.na.fill(0, ["n1", "changed", "fallen", "n2", "reverted"])
    return out.select("scope", "case", "as_of_date", "prev_date", "market", "n", "age_days", "n1", "changed", "fallen", "n2", "reverted", "n_before")


def _of_pairs(ctx: Context, subject: str | Column, top: str, bottom: str, by: Sequence[str] = ()) -> DataFrame:
    """A share of the rows that can be compared; nothing where none can."""
    rows = ctx.markets_of.filter(F.col(bottom) > 0)
    return _out(rows, subject, F.sum(top).cast("double") / F.sum(bottom), by=by)


def served_crawl_age_days(ctx: Context) -> DataFrame:
    return _out(ctx.markets_of, "market", F.max("age_days"), by=["market"])


def market_coverage(ctx: Context) -> DataFrame:
    """Markets delivered of those expected; a delivery without rows has none."""
    expected = ctx.markets.agg(F.count_if("is_in_micro_scope").alias("micro"), F.count(F.lit(1)).alias("macro")).first()
    n = F.when(F.col("scope") == "micro", expected["micro"]).otherwise(expected["macro"])
    rows = ctx.deliveries.select("scope", "as_of_date").join(ctx.markets_of.select("scope", "as_of_date", "market"), ["scope", "as_of_date"], "left")
    return _out(rows.withColumn("_n", n), "all", F.try_divide(F.count("market").cast("double"), F.max("_n")))


def product_count_change(ctx: Context) -> DataFrame:
    change = F.try_divide(F.col("n").cast("double"), F.col("n_before")) - 1
    case = [c for c in ("case",) if c in ctx.markets_of.columns]
    return ctx.markets_of.select("scope", "as_of_date", *case, F.col("market").alias("subject"), change.alias("observed"))


def price_reversion_share(ctx: Context) -> DataFrame:
    return _of_pairs(ctx, "market", "reverted", "n2", ["market"])


def price_decrease_share(ctx: Context) -> DataFrame:
    return _of_pairs(ctx, "market", "fallen", "n1", ["market"])


def price_change_share_anomaly(ctx: Context) -> DataFrame:
    return _of_pairs(ctx, "all", "changed", "n1")


def hero_grid_complete(ctx: Context) -> DataFrame:
    cells = ctx.micro.agg(F.count_distinct("pointer_id")).first()[0] * ctx.markets.filter("is_in_micro_scope").count()
    return _out(ctx.micro, "all", F.try_divide(F.count(F.lit(1)).cast("double"), F.lit(cells)), "micro", "delivery_date")


def hero_price_coverage(ctx: Context) -> DataFrame:
    return _out(ctx.micro, "all", _share(F.col("price_local").isNotNull()), "micro", "delivery_date")


def hero_stale_share(ctx: Context) -> DataFrame:
    return _out(ctx.micro, "all", _share(F.col("is_stale_crawl")), "micro", "delivery_date")


def hero_carried_forward(ctx: Context) -> DataFrame:
    return _out(ctx.micro, "all", F.count_if("is_price_carried_forward"), "micro", "delivery_date")


def hero_large_moves(ctx: Context) -> DataFrame:
    return _out(ctx.micro, "all", F.count_if(F.abs("change_vs_previous_pct") > 0.10), "micro", "delivery_date")


def macro_grid_complete(ctx: Context) -> DataFrame:
    cells = ctx.macro.agg(F.count_distinct("macro_category")).first()[0] * ctx.markets.count()
    return _out(ctx.macro, "all", F.try_divide(F.count(F.lit(1)).cast("double"), F.lit(cells)), "macro")


def lfl_match_rate(ctx: Context) -> DataFrame:
    rate = F.when(F.col("lfl_mean_change").isNotNull(), F.col("lfl_n_products").cast("double") / F.col("n_products"))
    return _out(ctx.macro, "all", F.min(rate), "macro")


def lfl_change_bounds(ctx: Context) -> DataFrame:
    return _out(ctx.macro, "macro_category", F.max(F.abs("lfl_mean_change")), "macro", by=["macro_category"])


def median_price_drift(ctx: Context) -> DataFrame:
    then = ctx.macro.select(F.add_months("report_month", 1).alias("report_month"), "market", "macro_category", F.col("median_price").alias("_before"))
    both = ctx.macro.join(then, ["report_month", "market", "macro_category"], "left")
    drift = F.abs(F.try_divide(F.col("median_price").cast("double"), F.col("_before").cast("double")) - 1)
    return _out(both, "macro_category", F.max(drift), "macro", by=["macro_category"])


def cross_market_dispersion(ctx: Context) -> DataFrame:
    return _out(ctx.macro, "macro_category", F.max("lfl_mean_change") - F.min("lfl_mean_change"), "macro", by=["macro_category"])


def global_reconciles_with_markets(ctx: Context) -> DataFrame:
    g = ctx.macro_global.select("report_month", "macro_category", F.col("market_weighted_lfl_change").alias("_g"))
    both = ctx.macro.filter(F.col("lfl_mean_change").isNotNull()).join(g, ["report_month", "macro_category"])
    return _out(both, "macro_category", F.abs(F.max("_g") - F.round(F.avg("lfl_mean_change"), 4)), "macro", by=["macro_category"])


_MARTS = ("marts",)

# Thresholds, severities and scopes of the checks.
CHECKS: tuple[Check, ...] = (
    Check("served_crawl_age_days", "timeliness", "block", served_crawl_age_days, {"micro": Rules(warn_above=7, fail_above=14), "macro": Rules(warn_above=10, fail_above=35)}),
    Check("market_coverage", "completeness", "block", market_coverage, Rules(fail_below=1.0)),
    Check("product_count_change", "completeness", "block", product_count_change, Rules(warn_below=-0.05, fail_below=-0.20, warn_above=0.20), compares=True),
    Check("price_reversion_share", "plausibility", "block", price_reversion_share, Rules(warn_above=0.01, fail_above=0.05), compares=True),
    Check("price_decrease_share", "plausibility", "block", price_decrease_share, Rules(warn_above=0.02, fail_above=0.10), compares=True),
    Check("price_change_share_anomaly", "plausibility", "warn", price_change_share_anomaly, Rules(anomaly=Anomaly(6, 3, 4, 0.02)), compares=True),
    Check("hero_grid_complete", "completeness", "block", hero_grid_complete, Rules(fail_below=1.0), ("micro",), _MARTS),
    Check("hero_price_coverage", "completeness", "block", hero_price_coverage, Rules(warn_below=0.98, fail_below=0.90), ("micro",), _MARTS),
    Check("hero_stale_share", "timeliness", "block", hero_stale_share, Rules(warn_above=0.0, fail_above=0.5), ("micro",), _MARTS),
    Check("hero_carried_forward", "validity", "warn", hero_carried_forward, Rules(warn_above=0), ("micro",), _MARTS),
    Check("hero_large_moves", "plausibility", "warn", hero_large_moves, Rules(warn_above=0), ("micro",), _MARTS),
    Check("macro_grid_complete", "completeness", "block", macro_grid_complete, Rules(fail_below=1.0), ("macro",), _MARTS),
    Check("lfl_match_rate", "completeness", "block", lfl_match_rate, Rules(warn_below=0.8, fail_below=0.5), ("macro",), _MARTS),
    Check("lfl_change_bounds", "validity", "block", lfl_change_bounds, Rules(warn_above=0.10, fail_above=0.30), ("macro",), _MARTS),
    Check("median_price_drift", "plausibility", "warn", median_price_drift, Rules(warn_above=0.15), ("macro",), _MARTS),
    Check("cross_market_dispersion", "consistency", "warn", cross_market_dispersion, Rules(warn_above=0.10), ("macro",), _MARTS),
    Check("global_reconciles_with_markets", "consistency", "block", global_reconciles_with_markets, Rules(fail_above=0.0001), ("macro",), _MARTS),
)


def measure(checks: Sequence[Check], ctx: Context) -> DataFrame:
    """Every check over the whole calendar, once: check_id, scope, as_of_date, subject, observed."""
    out = None
    for c in checks:
        m = c.measure(ctx).filter(F.col("scope").isin(*c.scopes)).withColumn("check_id", F.lit(c.id))
        out = m if out is None else out.unionByName(m)
    return out


def catalogue_of(checks: Sequence[Check], dataset: str = "marts") -> list[Check]:
    """The checks that a dataset goes through; an id stands for one check."""
    ids = [c.id for c in checks]
    if len(set(ids)) < len(ids):
        raise ValueError("checks with the same id: " + ", ".join(sorted({i for i in ids if ids.count(i) > 1})))
    return [c for c in checks if dataset in c.datasets]


def rule_table(spark, checks: Sequence[Check]) -> DataFrame:
    """A row for each check and scope, with its thresholds and their description."""
    rows = []
    for c in checks:
        for s in c.scopes:
            r = c.rules_for(s)
            a = r.anomaly
            rows.append((c.id, s, c.dimension, c.severity, r.warn_above, r.warn_below, r.fail_above, r.fail_below, a and a.window, a and a.min_history, a and a.z, a and a.min_value, *r.describe()))
    return spark.createDataFrame(
        [tuple(float(x) if isinstance(x, int) and i in (4, 5, 6, 7, 10, 11) else x for i, x in enumerate(row)) for row in rows],
        "check_id string, scope string, dimension string, severity string, warn_above double, warn_below double, fail_above double, fail_below double, "
        "a_window int, a_min_history int, a_z double, a_min_value double, warn_rule string, fail_rule string",
    )


def with_missing(measures: DataFrame, deliveries: DataFrame, rules: DataFrame) -> DataFrame:
    """Measures, and a row without a value for each check that has none for a delivery."""
    wanted = deliveries.select("scope", "as_of_date").join(F.broadcast(rules.select("check_id", "scope")), "scope")
    lacking = wanted.join(measures.select("check_id", "scope", "as_of_date").distinct(), ["check_id", "scope", "as_of_date"], "left_anti")
    return measures.unionByName(lacking.select("check_id", "scope", "as_of_date", F.lit("all").alias("subject"), F.lit(None).cast("double").alias("observed")))


def anomaly(measures: DataFrame, checks: Sequence[Check], accepted: DataFrame | None = None, lesson: str = "observed") -> DataFrame:
    """Measures with usual (mean of the last accepted values) and is_anomaly, by each check's own window.

    ``accepted`` lists deliveries (scope, as_of_date) to learn from; without it all are. What is learnt is the column ``lesson``. Values
    to learn from have windows of their own, bounded by their number, and a delivery takes what the last of them before it found, so
    that the work grows with the deliveries alone.
    """
    known = F.lit(True) if accepted is None else F.coalesce(F.col("_accepted"), F.lit(False))
    if accepted is not None:
        measures = measures.join(F.broadcast(accepted.select("scope", "as_of_date").distinct().withColumn("_accepted", F.lit(True))), ["scope", "as_of_date"], "left")
    series = ["check_id", "scope", "subject"]
    df = measures.withColumn("_learn", known & F.col(lesson).isNotNull() & ~F.isnan(lesson))
    among = Window.partitionBy(*series, "_learn").orderBy("as_of_date")
    past = Window.partitionBy(*series).orderBy("as_of_date").rowsBetween(Window.unboundedPreceding, -1)
    rules = {(c.id, s): c.rules_for(s).anomaly for c in checks for s in c.scopes if c.rules_for(s).anomaly}
    for n in sorted({a.window for a in rules.values()}):
        last = among.rowsBetween(1 - n, Window.currentRow)
        stats = F.struct(F.avg(lesson).over(last).alias("mean"), F.stddev_pop(lesson).over(last).alias("spread"), F.count(lesson).over(last).alias("n"))
        df = df.withColumn(f"_s{n}", F.when(F.col("_learn"), stats))
    df = df.withColumns({f"_s{n}": F.last(f"_s{n}", ignorenulls=True).over(past) for n in sorted({a.window for a in rules.values()})})
    usual, flag = F.lit(None).cast("double"), F.lit(False)
    for (check, scope), a in rules.items():
        mine = (F.col("check_id") == check) & (F.col("scope") == scope)
        seen = F.col(f"_s{a.window}")
        limit = seen["mean"] + a.z * F.greatest(seen["spread"], F.lit(MIN_SPREAD))
        hit = (seen["n"] >= a.min_history) & (F.col("observed") > limit) & (F.col("observed") > a.min_value)
        usual, flag = F.when(mine, seen["mean"]).otherwise(usual), F.when(mine, F.coalesce(hit, F.lit(False))).otherwise(flag)
    return df.withColumns({"usual": usual, "is_anomaly": flag}).drop("_learn", "_accepted", *[f"_s{a.window}" for a in rules.values()])


def _shown(c: Column) -> Column:
    """A value as people read it: shares below one as percentages."""
    return F.when((F.abs(c) < 1) & (c != 0), F.format_string("%.2f%%", c * 100)).otherwise(F.format_string("%.2f", c))


def evaluate(measures: DataFrame, rules: DataFrame) -> DataFrame:
    """Status and message of each measure: fail before warn before anomaly; no value is a skip."""
    df = measures.join(F.broadcast(rules), ["check_id", "scope"])
    x = F.col("observed")
    none = x.isNull() | F.isnan(x)
    beyond = lambda side: F.coalesce(x > F.col(f"{side}_above"), F.lit(False)) | F.coalesce(x < F.col(f"{side}_below"), F.lit(False))
    odd = F.coalesce(F.col("is_anomaly"), F.lit(False)) if "is_anomaly" in df.columns else F.lit(False)
    status = F.when(none, "skip").when(beyond("fail"), "fail").when(beyond("warn") | odd, "warn").otherwise("pass")
    label = F.concat(F.col("subject"), F.lit(": "), _shown(x))
    message = (
        F.when(none, "not measured: this delivery has nothing that it can be held against")
        .when(beyond("fail"), F.concat(label, F.lit(", which fails the rule "), F.col("fail_rule")))
        .when(beyond("warn"), F.concat(label, F.lit(", outside the range that passes: "), F.col("warn_rule")))
        .when(odd, F.concat(label, F.lit(", where earlier deliveries had about "), _shown(F.col("usual")) if "usual" in df.columns else F.lit("less")))
        .otherwise(label)
    )
    return df.withColumns({"status": status, "message": message}).select("check_id", "dimension", "severity", "scope", "as_of_date", "subject", "observed", "warn_rule", "fail_rule", "status", "message", *[c for c in ("case",) if c in df.columns])


def decide(results: DataFrame, keys: Sequence[str] = ("scope", "as_of_date")) -> DataFrame:
    """BLOCK for a failed blocking check, WARN for anything else not clean, PASS."""
    block = F.bool_or((F.col("status") == "fail") & (F.col("severity") == "block"))
    warn = F.bool_or(F.col("status").isin("warn", "fail"))
    return results.groupBy(*keys).agg(F.when(block, "BLOCK").when(warn, "WARN").otherwise("PASS").alias("decision"))


@dataclass
class Audit:
    """Judging deliveries in order, each against the last ones before it that were accepted.

    Whether a delivery is blocked depends on earlier verdicts only through the two deliveries that it is held against, so the audit is
    one pass over verdicts by base. Those for the calendar's own bases are measured first, all at once. A base that isn't known yet is
    measured together with what is likely to be asked next: the same distances back for every delivery, and the same base for every later
    one. A run of blocked deliveries keeps its base, and verdicts that take turns keep their distances, so new measures are few.
    """

    checks: Sequence[Check]
    context: Callable[[DataFrame], Context]
    results: DataFrame | None = None
    decisions: dict[tuple[str, dt.date], str] = field(default_factory=dict)
    #: Bases measured besides the calendar's, and the jobs that it took.
    bases: dict[tuple, int] = field(default_factory=dict)
    jobs: int = 0

    def run(self, calendar: DataFrame, targets: Sequence[tuple[str, dt.date]], released: set[tuple[str, dt.date]]) -> None:
        """Verdicts come to the driver by delivery and base; measures and results stay in tables."""
        spark = calendar.sparkSession
        wanted, rules = set(targets), rule_table(spark, self.checks)
        if not wanted:
            return
        ctx = self.context(calendar)
        days = sorted((r["scope"], r["as_of_date"], r["prev_date"], r["prev2_date"]) for r in calendar.collect())
        order = {scope: [d for s, d, *_ in days if s == scope] for scope in SCOPES}
        usual = {(s, d): (a, b) for s, d, a, b in days}
        everything = materialise(measure(self.checks, ctx), "measures")
        failed = evaluate(everything, rules).filter("status = 'fail' and severity = 'block'").select("scope", "as_of_date", F.col("check_id").isin([c.id for c in self.checks if c.compares]).alias("compares"))
        fails = {tuple(r) for r in failed.distinct().collect()}
        blocked = {(s, d, *base): (s, d, True) in fails for (s, d), base in usual.items()}
        tables: list[DataFrame] = []

        accepted, bases = set(released), {}
        for scope, of in order.items():
            good = []
            for i, day in enumerate(of):
                base = (good[-1] if good else None, good[-2] if len(good) > 1 else None)
                if (scope, day) in wanted:
                    bases[scope, day] = base
                    if (scope, day, False) not in fails and base != (None, None) and (scope, day, *base) not in blocked:
                        tables.append(self._measured(ctx, self._likely(scope, of, i, base, blocked), rules, blocked))
                    if (scope, day, False) not in fails and not blocked.get((scope, day, *base), False):
                        accepted.add((scope, day))
                if (scope, day) in accepted:
                    good.append(day)
        moved = {k: base for k, base in bases.items() if base != usual[k]}
        lacking = [(s, d, *base) for (s, d), base in moved.items() if (s, d, *base) not in self.bases]
        if lacking:
            tables.append(self._measured(ctx, lacking, rules, blocked))
        self._record(spark, calendar, everything, tables, rules, wanted, usual, moved, accepted)

    @staticmethod
    def _likely(scope: str, of: list[dt.date], i: int, base: tuple, blocked: Mapping) -> list[tuple]:
        back = [None if b is None else i - of.index(b) for b in base]
        out = [(scope, d, *base) for d in of[i:]]
        out += [(scope, d, *[None if n is None else of[k - n] for n in back]) for k, d in enumerate(of) if k > i and all(n is None or n <= k for n in back)]
        return [x for x in dict.fromkeys(out) if x not in blocked]

    def _measured(self, ctx: Context, asked: list[tuple], rules: DataFrame, blocked: dict) -> DataFrame:
        """Measures of these deliveries against these bases, written, with the column case; ``blocked`` gets their verdicts."""
        spark, first = rules.sparkSession, len(self.bases)
        self.bases |= {x: first + n for n, x in enumerate(asked)}
        rows = [(self.bases[x], *x) for x in asked]
        cases = spark.createDataFrame(rows, "case int, scope string, as_of_date date, prev_date date, prev2_date date")
        out = materialise(measure([c for c in self.checks if c.compares], ctx.against(cases)), "against")
        bad = {r["case"] for r in evaluate(out, rules).filter("status = 'fail' and severity = 'block'").select("case").distinct().collect()}
        blocked |= {x: self.bases[x] in bad for x in asked}
        self.jobs += 1
        return out

    def _record(self, spark, calendar: DataFrame, everything: DataFrame, tables: Sequence[DataFrame], rules: DataFrame, wanted: set, usual: Mapping, moved: Mapping, accepted: set) -> None:
        """Results of the targets under their final bases, with what anomalies learn from accepted deliveries."""
        keys = ["check_id", "scope", "as_of_date", "subject"]
        chosen = F.broadcast(spark.createDataFrame(sorted(wanted), "scope string, as_of_date date"))
        now = everything.join(chosen, ["scope", "as_of_date"], "left_semi").select(*keys, "observed")
        if moved:
            where = F.broadcast(spark.createDataFrame([(s, d, self.bases[s, d, *base]) for (s, d), base in moved.items()], "scope string, as_of_date date, case int"))
            compared = [c.id for c in self.checks if c.compares]
            now = now.join(where, ["scope", "as_of_date"], "left_anti").unionByName(now.filter(~F.col("check_id").isin(compared)).join(where, ["scope", "as_of_date"], "left_semi"))
            for t in tables:
                now = now.unionByName(t.join(where, ["scope", "as_of_date", "case"], "left_semi").select(*keys, "observed"))
        now = with_missing(materialise(now, "held"), chosen, rules).withColumn("_judged", F.lit(True))
        rows = now.join(everything.select(*keys, F.col("observed").alias("_lesson")), keys, "full")
        known = spark.createDataFrame(sorted(accepted), "scope string, as_of_date date")
        out = evaluate(anomaly(rows, self.checks, known, "_lesson").filter("_judged"), rules)
        if moved:
            out = out.join(F.broadcast(self._notes(spark, usual, moved)), ["scope", "as_of_date"], "left")
            out = out.withColumn("message", F.when((F.col("status") == "skip") | F.col("note").isNull(), F.col("message")).otherwise(F.concat("message", "note"))).drop("note")
        self.results = materialise(out, "judged")
        self.decisions = {(r["scope"], r["as_of_date"]): r["decision"] for r in decide(self.results).collect()}

    @staticmethod
    def _notes(spark, usual: Mapping, moved: Mapping) -> DataFrame:
        rows = []
        for (scope, day), base in moved.items():
            passed = ", ".join(str(d) for d in sorted(set(usual[scope, day]) - set(base) - {None}))
            rows.append((scope, day, f" (held against {base[0]}, as these were not accepted: {passed})"))
        return spark.createDataFrame(rows, "scope string, as_of_date date, note string")


def pick_targets(calendar: DataFrame, releases: DataFrame, date: dt.date | None = None, every: bool = False) -> list[tuple[str, dt.date]]:
    """One date, all deliveries, or those not released yet."""
    rows = calendar.select("scope", "as_of_date")
    if date is not None:
        rows = rows.filter(F.col("as_of_date") == F.lit(date))
    elif not every:
        rows = rows.join(releases.select("scope", "as_of_date").distinct(), ["scope", "as_of_date"], "left_anti")
    return sorted((r["scope"], r["as_of_date"]) for r in rows.collect())


def append_results(ledger, results: DataFrame, run_id: str, dataset: str, checked_at: dt.datetime) -> None:
    """Add a run's results, once however often it is tried."""
    ledger.append(results.withColumns({"run_id": F.lit(run_id), "checked_at": F.lit(checked_at), "dataset": F.lit(dataset)}), run_id)


def append_releases(ledger, spark, decisions: Mapping[tuple[str, dt.date], str], run_id: str, by: str, at: dt.datetime, forced: bool = False, reason: str | None = None) -> None:
    rows = [(uuid.uuid4().hex, s, d, run_id, what, forced, reason, at, by) for (s, d), what in decisions.items()]
    ledger.append(spark.createDataFrame(rows, RELEASES))


def audit(calendar: DataFrame, context: Callable[[DataFrame], Context], results_ledger, releases_ledger, checks: Sequence[Check] = CHECKS, dataset: str = "marts", by: str = "gate", date: dt.date | None = None, every: bool = False, dry_run: bool = False, publish: bool = True) -> Audit:
    """Judge the targeted deliveries, record every result, release what isn't blocked; the replay is never published."""
    spark = calendar.sparkSession
    releases = releases_ledger.read()
    released = {(r["scope"], r["as_of_date"]) for r in releases.select("scope", "as_of_date").distinct().collect()}
    run = Audit(catalogue_of(checks, dataset), context)
    run.run(calendar, pick_targets(calendar, releases, date, every), released)
    if not dry_run and run.results is not None:
        run_id, now = uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        append_results(results_ledger, run.results, run_id, dataset, now)
        free = {k: v for k, v in run.decisions.items() if v != "BLOCK" and k not in released}
        if publish and dataset == "marts" and free:
            append_releases(releases_ledger, spark, free, run_id, by, now)
    return run


def force_release(scope: str, date: dt.date, reason: str, results_ledger, releases_ledger, by: str) -> None:
    """Release a delivery against the gate's verdict: it needs a reason and an earlier audit."""
    if not reason.strip():
        raise ValueError("a forced release needs a reason")
    seen = results_ledger.read().filter((F.col("scope") == scope) & (F.col("as_of_date") == F.lit(date)) & (F.col("dataset") == "marts"))
    last = seen.agg(F.max_by("run_id", "checked_at")).first()[0]
    if last is None:
        raise ValueError("it has not been audited")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    append_releases(releases_ledger, releases_ledger.spark, {(scope, date): "BLOCK"}, last, by, now, True, reason)


def release_status(releases: DataFrame) -> DataFrame:
    return releases.groupBy("scope", "as_of_date").agg(
        F.max_by("decision", F.struct("released_at", "release_id")).alias("decision"), F.bool_or("is_forced").alias("is_forced"), F.max("released_at").alias("released_at")
    )


def audit_report(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tallies of each delivery, and the results that don't pass: fails first, blocking ones before others."""
    tallies = results.groupBy("scope", "as_of_date").agg(*[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("pass", "warn", "fail", "skip")])
    rank = F.when(F.col("status") == "fail", 0).otherwise(1)
    rest = results.filter(F.col("status").isin("warn", "fail"))
    return tallies, rest.orderBy(rank, F.when(F.col("severity") == "block", 0).otherwise(1), "scope", "as_of_date", "check_id", "subject")
