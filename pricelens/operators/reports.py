"""Aggregates of the report pages, and audits of delivered data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelens.operators.deliveries import content_fingerprint

# By how much a price may lie below the anchor's least, and above its greatest, times the market's ratio.
SLACK_BELOW, SLACK_ABOVE = 0.97, 1.10 * 1.03
STATUSES = ("first_delivery", "unchanged", "price_increase", "price_decrease", "no_valid_price", "not_found", "page_error")


def status_tallies(micro: DataFrame) -> DataFrame:
    """Cells of each status by delivery."""
    return micro.groupBy("delivery_date").agg(*[F.count_if(F.col("price_status") == s).alias(f"n_{s}") for s in STATUSES])


def price_index(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Each series as an index: 100 at its first value."""
    w = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn("price_index", F.round(F.try_divide(F.col(value).cast("double"), F.first(value, ignorenulls=True).over(w).cast("double")) * 100, 2))


def explore_changes(changes: DataFrame, by: Sequence[str], size: str = "change_vs_previous", key: str = "object_id") -> DataFrame:
    """Events, ups, downs, median size and distinct objects; groups that are null are out of scope."""
    groups = [F.coalesce(F.col(c).cast("string"), F.lit("out of scope")).alias(c) for c in by]
    return changes.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_changes"), F.count_if(F.col(size) > 0).alias("n_up"), F.count_if(F.col(size) < 0).alias("n_down"),
        F.percentile(F.abs(F.col(size).cast("double")), 0.5).alias("median_size"), F.count_distinct(key).alias("n_objects"),
    )


def changes_by_crawl(changes: DataFrame, date: str = "valid_from", size: str = "change_vs_previous") -> DataFrame:
    """Increases and, with a negative sign, decreases of each crawl."""
    return changes.groupBy(date).agg(F.count_if(F.col(size) > 0).alias("increases"), (-F.count_if(F.col(size) < 0)).alias("decreases"))


def latest_events(changes: DataFrame, n: int = 200, date: str = "valid_from", size: str = "change_vs_previous", key: str = "object_id") -> DataFrame:
    """The newest n events, larger ones first within a day: a top-k report."""
    return changes.orderBy(F.desc(date), F.desc(F.abs(size)), key).limit(n)


def worst_status(results: DataFrame) -> DataFrame:
    """The worst status of each check and delivery (skip < pass < warn < fail < block) and its number of issues."""
    s = F.when((F.col("status") == "fail") & (F.col("severity") == "block"), "block").otherwise(F.col("status"))
    rank = F.array_position(F.array(*map(F.lit, ("skip", "pass", "warn", "fail", "block"))), s)
    return results.groupBy("check_id", "scope", "as_of_date").agg(F.max_by(s, F.struct(rank, s)).alias("worst"), F.count_if(F.col("status").isin("warn", "fail")).alias("n_issues"))


def decision_tallies(health: DataFrame) -> DataFrame:
    return health.groupBy("dataset", "scope").agg(*[F.count_if(F.col("decision") == d).alias(f"n_{d.lower()}") for d in ("PASS", "WARN", "BLOCK")])


def schema_parity(lines: DataFrame, keys: Sequence[str], detail_keys: Sequence[str], json_col: str = "raw_line") -> DataFrame:
    """Lines whose top-level keys aren't the expected ones in order, or whose details have unknown keys."""
    c = F.col(json_col)
    details = F.from_json(F.get_json_object(c, "$.productDetails"), "array<struct<key:string,value:string>>")
    df = lines.withColumns({"top_keys": F.json_object_keys(c), "unknown_details": F.array_except(F.transform(details, lambda x: x["key"]), F.array(*map(F.lit, detail_keys)))})
    return df.filter(~F.col("top_keys").eqNullSafe(F.array(*map(F.lit, keys))) | (F.size("unknown_details") > 0))


def outside_envelope(df: DataFrame, bounds: DataFrame, by: Sequence[str] = ("macro_category", "market"), value: str = "price_local") -> DataFrame:
    """Values outside their group's low and high bound."""
    return df.join(F.broadcast(bounds), list(by)).filter((F.col(value) < F.col("low")) | (F.col(value) > F.col("high")))


def price_bounds(anchor: DataFrame, ratios: DataFrame, category: str = "macro_category", value: str = "price_local") -> DataFrame:
    """low and high of a category and market: the anchor's range times the market's ratio spread, with some slack."""
    span = anchor.groupBy(category).agg(F.min(value).cast("double").alias("_q0"), F.max(value).cast("double").alias("_qn"))
    both = span.join(F.broadcast(ratios.select("market", "p05", "p95")))
    return both.select(category, "market", (F.col("_q0") * F.col("p05") * SLACK_BELOW).alias("low"), (F.col("_qn") * F.col("p95") * SLACK_ABOVE).alias("high"))


def same_times_other_lines(lines: DataFrame, file_col: str = "source_file_name", time: str = "created_at_raw", line: str = "raw_line") -> DataFrame:
    """Pairs of files with the same set of creation times but different lines: a later file and the first of its kind."""
    files = lines.groupBy(file_col).agg(content_fingerprint(F.col(line)).alias("lines_print"))
    times = lines.select(file_col, time).distinct().groupBy(file_col).agg(content_fingerprint(F.col(time).cast("string")).alias("times_print"), F.count(F.lit(1)).alias("n_times"))
    df = files.join(times, file_col)
    w = Window.partitionBy("times_print", "n_times").orderBy(file_col)
    first = df.withColumns({"same_times_as": F.first(file_col).over(w), "_first": F.first("lines_print").over(w)})
    return first.filter((F.col(file_col) != F.col("same_times_as")) & (F.col("lines_print") != F.col("_first"))).select(file_col, "same_times_as")


def shrinkage(counts: DataFrame, member: str = "market", date: str = "crawl_date", n: str = "n_lines") -> DataFrame:
    """Each member's lines against its crawl before."""
    w = Window.partitionBy(member).orderBy(date)
    return counts.withColumn("ratio_to_previous", F.round(F.try_divide(F.col(n).cast("double"), F.lag(n).over(w).cast("double")), 4))


def median_move(now: DataFrame, before: DataFrame, key: str = "object_id", family: str = "macro_category", value: str = "price_local") -> DataFrame:
    """The median relative move of each family between two crawls."""
    both = now.select(key, family, F.col(value).cast("double").alias("_n")).join(before.select(key, F.col(value).cast("double").alias("_b")), key)
    return both.groupBy(family).agg(F.round(F.percentile(F.try_divide(F.col("_n"), F.col("_b")) - 1, 0.5), 4).alias("median_move"), F.count(F.lit(1)).alias("n"))
