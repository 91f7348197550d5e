"""What was known at a date: of several facts, the latest that had happened and had been delivered by then."""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelens.functions.text import surrogate_key
from pricelens.sources.tables import materialise, small


def as_of_dates(files: DataFrame, crawl_date: str = "content_crawl_date") -> DataFrame:
    """Reporting dates: the day after each crawl (micro) and the end of its month (macro), known until the next midnight."""
    crawls = files.select(F.col(crawl_date).alias("d")).distinct()
    both = F.array(F.struct(F.date_add("d", 1).alias("as_of_date"), F.lit(True).alias("micro")), F.struct(F.last_day("d").alias("as_of_date"), F.lit(False).alias("micro")))
    days = crawls.select(F.explode(both).alias("x")).select("x.*")
    out = days.groupBy("as_of_date").agg(F.bool_or("micro").alias("is_micro_date"), F.bool_or(~F.col("micro")).alias("is_macro_date"))
    return out.withColumn("knowledge_cutoff", F.date_add("as_of_date", 1).cast("timestamp"))


@dataclass(frozen=True)
class Calendar:
    """The distinct (date, cutoff) pairs that are asked about, as staircases: sequences in which neither axis ever falls.

    A fact becomes visible once on a staircase and stays so, which makes its place there one number. Dates whose cutoffs follow a
    fixed lag are one staircase, several lags are one each, and pairs in any order are as many as the longest run of dates whose
    cutoffs fall. ``days`` and ``cuts`` have a list for each staircase: days since 1970, and microseconds.
    """

    days: list[list[int]]
    cuts: list[list[int]]

    @classmethod
    def of(cls, dates: DataFrame) -> Calendar:
        """From as_of_date and knowledge_cutoff; a calendar has a row a day at most for each lag, and comes to the driver."""
        pairs = dates.select(F.unix_date("as_of_date").alias("d"), F.unix_micros("knowledge_cutoff").alias("c")).distinct()
        days: list[list[int]] = []
        cuts: list[list[int]] = []
        tops: list[int] = []  # minus the last cutoff of each staircase, ascending
        for d, c in sorted(tuple(r) for r in pairs.collect()):
            i = bisect_left(tops, -c)  # the staircase with the greatest last cutoff that this one doesn't fall below
            if i == len(tops):
                days.append([])
                cuts.append([])
                tops.append(0)
            days[i].append(d)
            cuts[i].append(c)
            tops[i] = -c
        return cls(days, cuts)

    def places(self, crawl_date: Column, delivered_at: Column) -> Column:
        """For each staircase (chain) on which a fact is ever visible, the first place (at) where it is, as an array of structs."""
        found = []
        for i, days in enumerate(self.days):
            at = self.place(i, crawl_date, delivered_at)
            found.append(F.when(at < len(days), F.struct(F.lit(i).alias("chain"), at.alias("at"))))
        return F.array_compact(F.array(*found)) if found else F.array().cast("array<struct<chain:int,at:int>>")

    def place(self, chain: int, crawl_date: Column, delivered_at: Column) -> Column:
        """The first place on a staircase where a fact is visible, its length if it never is, null if it lacks a time."""
        day, came = F.unix_date(crawl_date), F.unix_micros(delivered_at)
        at = F.greatest(_below(self.days[chain], day, "int"), _below(self.cuts[chain], came + 1, "bigint"))
        return F.when(day.isNotNull() & came.isNotNull(), at)

    def day(self, chain: Column, at: Column) -> Column:
        return F.date_from_unix_date(F.get(F.get(constants(self.days, "array<array<int>>"), chain), at))

    def cutoff(self, chain: Column, at: Column) -> Column:
        return F.timestamp_micros(F.get(F.get(constants(self.cuts, "array<array<bigint>>"), chain), at))

    def size(self, chain: Column) -> Column:
        return F.get(constants([len(x) for x in self.days], "array<int>"), chain)


def constants(values: list, kind: str) -> Column:
    """A nested list of numbers as one constant."""
    return F.from_json(F.lit(json.dumps(values)), kind)


#: Steps of a table of places at most; values that lie farther apart are searched.
TABLE_STEPS = 100_000
DAY_MICROS = 86_400_000_000


def _below(values: list[int], x: Column, kind: str) -> Column:
    """How many of the ascending values are less than x: by a table of the days that they span, if these have one value each at most,
    else by binary search.
    """
    step = DAY_MICROS if kind == "bigint" else 1
    bins = [v // step for v in values]
    if values and len(set(bins)) == len(bins) and bins[-1] - bins[0] < TABLE_STEPS:
        low, n = bins[0], bins[-1] - bins[0] + 1
        own = dict(zip(bins, values, strict=True))
        since = F.greatest(x - F.lit(low * step), F.lit(0))
        at = F.least(since if step == 1 else F.call_function("div", since, F.lit(step)), F.lit(n - 1)).cast("int")
        fewer = F.get(constants([bisect_left(bins, low + i) for i in range(n)], "array<int>"), at)
        here = F.get(constants([own.get(low + i) for i in range(n)], f"array<{kind}>"), at)
        return fewer + F.when(here < x, 1).otherwise(0)
    steps = [1 << k for k in reversed(range(len(values).bit_length()))]
    held = constants(values, f"array<{kind}>")
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: at + F.when(F.get(held, at + s - 1) < x, s).otherwise(0))


def known_periods(calendar: Calendar, facts: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str], crawl_date: str = "crawl_date", delivered_at: str = "delivered_at") -> DataFrame:
    """The staircase of each key: the stretches of places (start, up to end) on a chain in which one fact is the latest that is known.

    Facts that a greater one beats before the next place drop out by a running maximum over one sort of the facts; dates take no part.
    Ties in ``order`` are broken by the kept columns.
    """
    fact = F.struct(*order, *[c for c in keep if c not in order]).alias("_f")
    if len(calendar.days) == 1:  # one place at most, without an array
        # What is never visible starts where the staircase ends, and drops out with the other empty stretches.
        timed = facts.filter(F.col(crawl_date).isNotNull() & F.col(delivered_at).isNotNull())
        rows = timed.select(*keys, F.lit(0).alias("chain"), calendar.place(0, F.col(crawl_date), F.col(delivered_at)).alias("start"), fact)
    else:
        placed = facts.select(*keys, fact, F.explode(calendar.places(F.col(crawl_date), F.col(delivered_at))).alias("_p"))
        rows = placed.select(*keys, F.col("_p.chain").alias("chain"), F.col("_p.at").alias("start"), "_f")
    w = Window.partitionBy(*keys, "chain").orderBy("start", "_f")
    end = F.coalesce(F.lead("start").over(w), calendar.size(F.col("chain")))
    best = rows.withColumns({"end": end, "_f": F.max("_f").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))}).filter("end > start")
    return best.select(*keys, "chain", "start", "end", *[F.col(f"_f.{c}").alias(c) for c in keep])


def expanded(calendar: Calendar, periods: DataFrame) -> DataFrame:
    """A row with as_of_date and knowledge_cutoff for each place of each period."""
    rows = periods.withColumn("_at", F.explode(F.sequence("start", F.col("end") - 1)))
    chain, at = F.col("chain"), F.col("_at")
    return rows.withColumns({"as_of_date": calendar.day(chain, at), "knowledge_cutoff": calendar.cutoff(chain, at)}).drop("chain", "start", "end", "_at")


def latest_as_of(dates: DataFrame, facts: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str], crawl_date: str = "crawl_date", delivered_at: str = "delivered_at") -> DataFrame:
    """For each date and key, the latest fact by ``order`` with crawl date <= date and delivered before the cutoff, whatever the cutoffs.

    Work grows with facts (once for each staircase of the calendar) plus answers, never with facts times dates. With several cutoffs for
    a date there are several rows for it.
    """
    calendar = Calendar.of(dates)
    found = expanded(calendar, known_periods(calendar, facts, keys, order, keep, crawl_date, delivered_at))
    return found.select("as_of_date", *keys, *keep)


def latest_by_running_max(dates: DataFrame, facts: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str], crawl_date: str = "crawl_date", delivered_at: str = "delivered_at", asked: bool = False) -> DataFrame:
    """latest_as_of() for many dates whose cutoff is the next midnight: a fact becomes visible once, and the answer at a date is the
    running maximum by then.

    Facts and questions are merged by key and time in one sort, so that the work grows with facts plus answers and not with their
    product. ``dates`` is a calendar that every key is asked about, or with ``asked`` the table of dates and keys in question.
    """
    seen = F.greatest(F.col(crawl_date), F.to_date(delivered_at))
    fact = F.struct(*order, *[c for c in keep if c not in order])
    rows = facts.select(*keys, seen.alias("_at"), F.lit(0).alias("_q"), fact.alias("_f"))
    questions = dates.select("as_of_date", *keys) if asked else facts.select(*keys).distinct().join(F.broadcast(dates.select("as_of_date")))
    questions = questions.select(*keys, F.col("as_of_date").alias("_at"), F.lit(1).alias("_q"), F.lit(None).cast(rows.schema["_f"].dataType).alias("_f"))
    w = Window.partitionBy(*keys).orderBy("_at", "_q").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.union(questions).withColumn("_best", F.max("_f").over(w)).filter("_q = 1 and _best is not null")
    return both.select(F.col("_at").alias("as_of_date"), *keys, *[F.col(f"_best.{c}").alias(c) for c in keep])


def catalogue_periods(calendar: Calendar, batches: DataFrame, classified: DataFrame, accepted: DataFrame) -> DataFrame:
    """The catalogue as stretches of the calendar in which an object's row doesn't change: the batch that it is seen in and its price.

    Two kinds of stretches meet in one sweep by object: those in which a batch is the latest eligible one of its market and lists the
    object (real product pages, whatever the quality of their price), and those in which a price is the latest known. Their starts are
    sorted; after each start the last of either kind holds until the next one, or until the batch ends.
    """
    chosen = small(materialise(chosen_periods(calendar, batches), "chosen"))
    listed = pages_of(classified).groupBy("market_batch_id", "object_id").agg(F.sort_array(F.collect_set("sku")).alias("skus"))
    seen = F.struct("end", "market", "market_batch_id", "crawl_date", "crawl_scope", "skus").alias("_seen")
    present = chosen.join(listed, "market_batch_id").select("object_id", "chain", "start", F.lit(1).alias("_kind"), seen)
    prices = accepted.select("object_id", "crawl_date", "delivered_at", "price_local", "currency_code", "market_batch_id")
    known = known_periods(calendar, prices, ["object_id"], ["crawl_date", "delivered_at"], ["crawl_date", "price_local", "currency_code", "market_batch_id"])
    price = F.struct("crawl_date", "price_local", "currency_code", "market_batch_id").alias("_price")
    known = known.select("object_id", "chain", "start", F.lit(0).alias("_kind"), price)
    w = Window.partitionBy("object_id", "chain").orderBy("start", "_kind")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    events = present.unionByName(known, allowMissingColumns=True)
    until = F.coalesce(F.lead("start").over(w), calendar.size(F.col("chain")))
    rows = events.withColumns({"_until": until, "_seen": F.last("_seen", True).over(so_far), "_price": F.last("_price", True).over(so_far)})
    rows = rows.withColumn("end", F.least("_until", "_seen.end")).filter("end > start")
    return rows.select(
        "object_id", "chain", "start", "end", F.col("_seen.market").alias("market"), F.explode("_seen.skus").alias("sku"), F.col("_seen.market_batch_id").alias("presence_batch_id"),
        F.col("_seen.crawl_date").alias("presence_crawl_date"), F.col("_seen.crawl_scope").alias("presence_crawl_scope"), F.col("_price.crawl_date").alias("price_crawl_date"),
        F.col("_price.price_local").alias("price_local"), F.col("_price.currency_code").alias("currency_code"), F.col("_price.market_batch_id").alias("price_batch_id"),
    )


def overlapping(calendar: Calendar, periods: DataFrame, key: str = "object_id") -> DataFrame:
    """The periods of keys that have two at one place, found by a sort of the periods. Only they can be twice at a date; on several
    staircases any key may be, so that all stay.
    """
    if len(calendar.days) > 1:
        return periods
    w = Window.partitionBy(key).orderBy("start", "end")
    upto = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    clash = F.bool_or("_twice").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = periods.withColumn("_twice", F.coalesce(upto > F.col("start"), F.lit(False))).withColumn("_clash", clash)
    return rows.filter("_clash").drop("_twice", "_clash")


def served_periods(calendar: Calendar, batches: DataFrame, classified: DataFrame) -> DataFrame:
    """By market the stretches in which each batch is the latest eligible one and lists an object: its catalogue's batches, without
    the objects."""
    pages = pages_of(classified).select("market_batch_id").distinct()
    return chosen_periods(calendar, batches).join(pages, "market_batch_id", "left_semi").withColumnsRenamed({"market_batch_id": "presence_batch_id", "crawl_date": "presence_crawl_date"})


def chosen_periods(calendar: Calendar, batches: DataFrame) -> DataFrame:
    return known_periods(calendar, batches.filter("is_eligible"), ["market"], ["crawl_date", "delivered_at"], ["market_batch_id", "crawl_date", "crawl_scope"])


def pages_of(classified: DataFrame) -> DataFrame:
    """Real product pages, whatever the quality of their price."""
    return classified.filter(F.col("fate").isin("accepted", "price_scale_outlier", "quarantined_in_staging") & ~F.col("is_not_a_product_page"))


def catalogue_rows(calendar: Calendar, periods: DataFrame, dates: DataFrame) -> DataFrame:
    """A row for each date and object present: how old its crawl is, the latest known price, whether that is carried forward."""
    out = expanded(calendar, periods).join(F.broadcast(dates), ["as_of_date", "knowledge_cutoff"]).drop("knowledge_cutoff")
    return out.withColumns(
        {
            "catalogue_row_id": surrogate_key(F.col("as_of_date"), F.col("object_id")),
            "presence_age_days": F.date_diff("as_of_date", "presence_crawl_date"),
            "has_price": F.col("price_local").isNotNull(),
            "is_price_carried_forward": F.coalesce(F.col("price_crawl_date") < F.col("presence_crawl_date"), F.lit(False)),
        }
    )


def catalogue_as_of(dates: DataFrame, batches: DataFrame, classified: DataFrame, accepted: DataFrame) -> DataFrame:
    """The catalogue by dates: its periods, a row for each date in them."""
    calendar = Calendar.of(dates)
    return catalogue_rows(calendar, catalogue_periods(calendar, batches, classified, accepted), dates)


def replay_last_import(dates: DataFrame, batches: DataFrame, classified: DataFrame) -> DataFrame:
    """The same rows under the rule "the last import wins": no trust, no completeness, no crawl dates."""
    imported = batches.withColumn("_any", F.to_date(F.lit("0001-01-01")))
    last = latest_as_of(dates, imported, ["market"], ["loaded_at", "delivered_at", "market_batch_id"], ["market_batch_id", "crawl_date"], "_any", "loaded_at")
    last = last.withColumnRenamed("crawl_date", "legacy_crawl_date")
    lines = classified.filter(~F.col("is_not_a_product_page")).select("market_batch_id", "object_id", "price_local", "dq_status", "is_price_scale_outlier")
    usable = (F.col("dq_status") != "quarantine") & ~F.col("is_price_scale_outlier")
    return last.join(lines, "market_batch_id").groupBy("as_of_date", "market", "object_id", "legacy_crawl_date").agg(F.max(F.when(usable, F.col("price_local"))).alias("price_local"))


def replay_periods(calendar: Calendar, batches: DataFrame, classified: DataFrame) -> DataFrame:
    """replay_last_import() as stretches of the calendar in which an object's row doesn't change, in the form of catalogue_periods()."""
    imported = batches.withColumn("_any", F.to_date(F.lit("0001-01-01")))
    last = known_periods(calendar, imported, ["market"], ["loaded_at", "delivered_at", "market_batch_id"], ["market_batch_id", "crawl_date"], "_any", "loaded_at")
    last = small(materialise(last, "imported"))
    lines = classified.filter(~F.col("is_not_a_product_page"))
    usable = (F.col("dq_status") != "quarantine") & ~F.col("is_price_scale_outlier")
    rows = lines.groupBy("market_batch_id", "object_id").agg(F.max(F.when(usable, F.col("price_local"))).alias("price_local"))
    return rows.join(last, "market_batch_id").select("object_id", "chain", "start", "end", "market", F.col("crawl_date").alias("presence_crawl_date"), "price_local")


def diff_catalogues(right: DataFrame, other: DataFrame, threshold: float = 0.0) -> DataFrame:
    """By date and market: objects that the other catalogue lacks or has beyond the right one, different prices and their share."""
    keys = ["as_of_date", "market", "object_id"]
    a = right.select(*keys, F.col("price_local").alias("_p"), F.lit(True).alias("_a"))
    b = other.select(*keys, F.col("price_local").alias("_o"), F.lit(True).alias("_b"))
    both = a.join(b, keys, "full")
    out = both.groupBy("as_of_date", "market").agg(
        F.count_if(F.col("_a")).alias("n_right"),
        F.count_if(F.col("_b")).alias("n_other"),
        F.count_if(F.col("_a") & F.col("_b").isNull()).alias("n_missing"),
        F.count_if(F.col("_b") & F.col("_a").isNull()).alias("n_extra"),
        F.count_if(F.col("_a") & F.col("_b") & ~F.col("_p").eqNullSafe(F.col("_o"))).alias("n_price_differences"),
    )
    wrong = F.col("n_missing") + F.col("n_extra") + F.col("n_price_differences")
    share = F.round(F.try_divide(wrong.cast("double"), F.col("n_right")), 4)
    return out.withColumns({"share_different": share, "is_wrong": wrong > F.col("n_right") * threshold})
