"""Reusable data tests: each returns the rows that break it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def not_unique(df: DataFrame, *cols: str) -> DataFrame:
    """Combinations that occur more than once; nulls don't count."""
    rows = df.na.drop(subset=list(cols))
    return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def nulls(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def not_accepted(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))


def orphans(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Rows whose value has no parent."""
    keys = parent.select(F.col(parent_col).alias(col)).distinct()
    return df.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def out_of_range(df: DataFrame, col: str, low=None, high=None) -> DataFrame:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(col) < low)
    if high is not None:
        bad = bad | (F.col(col) > high)
    return df.filter(bad)


def unequal_rowcount(a: DataFrame, b: DataFrame) -> DataFrame:
    n = a.agg(F.count(F.lit(1)).alias("n_a")).withColumn("_k", F.lit(1)).join(b.agg(F.count(F.lit(1)).alias("n_b")).withColumn("_k", F.lit(1)), "_k")
    return n.filter("n_a <> n_b").drop("_k")


def lost_rows(bronze: DataFrame, usable: DataFrame, quarantined: DataFrame, by: str = "source_file_name") -> DataFrame:
    """Files whose delivered lines aren't the sum of usable and quarantined ones."""
    count = lambda df, name: df.groupBy(by).agg(F.count(F.lit(1)).alias(name))
    out = count(bronze, "delivered").join(count(usable, "usable"), by, "full").join(count(quarantined, "quarantined"), by, "full").na.fill(0, ["delivered", "usable", "quarantined"])
    return out.filter("delivered <> usable + quarantined")


def not_latest_eligible(served: DataFrame, dates: DataFrame, batches: DataFrame, date_col: str = "presence_crawl_date") -> DataFrame:
    """Dates and markets that aren't served from the latest eligible crawl known then, recomputed by a plain maximum."""
    known = (F.col("crawl_date") <= F.col("as_of_date")) & (F.col("delivered_at") < F.col("knowledge_cutoff"))
    expected = batches.filter("is_eligible").join(F.broadcast(dates), known).groupBy("as_of_date", "market").agg(F.max("crawl_date").alias("expected_crawl_date"))
    got = served.groupBy("as_of_date", "market").agg(F.min(date_col).alias("min_served"), F.max(date_col).alias("max_served"))
    e = F.col("expected_crawl_date")
    return expected.join(got, ["as_of_date", "market"], "left").filter(~(F.col("min_served").eqNullSafe(e) & F.col("max_served").eqNullSafe(e)))


def look_ahead(catalogue: DataFrame, batches: DataFrame, dates: DataFrame) -> DataFrame:
    """Catalogue rows from a batch that was blocked, partial, of a later day or not delivered by the cutoff."""
    b = batches.select(F.col("market_batch_id").alias("presence_batch_id"), "is_eligible", "crawl_date", "delivered_at")
    df = catalogue.join(b, "presence_batch_id").join(F.broadcast(dates.select("as_of_date", "knowledge_cutoff")), "as_of_date")
    return df.filter(~F.col("is_eligible") | (F.col("crawl_date") > F.col("as_of_date")) | (F.col("delivered_at") >= F.col("knowledge_cutoff")))


def broken_periods(periods: DataFrame, key: str = "object_id") -> DataFrame:
    """Keys with overlapping or empty periods, or not exactly one current one."""
    w = Window.partitionBy(key).orderBy("valid_from")
    bad = F.lead("valid_from").over(w) < F.col("valid_to")
    empty = F.col("valid_to") <= F.col("valid_from")
    df = periods.withColumn("_bad", F.coalesce(bad, F.lit(False)) | F.coalesce(empty, F.lit(False)))
    out = df.groupBy(key).agg(F.count_if("_bad").alias("n_bad"), F.count_if(F.col("valid_to").isNull()).alias("n_current"))
    return out.filter("n_bad > 0 or n_current <> 1")


def not_projected(mart: DataFrame, recomputed: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys where a mart and its recomputation differ, nulls being equal to nulls."""
    a = mart.select(*keys, F.col(value).alias("_a"), F.lit(1).alias("_ina"))
    b = recomputed.select(*keys, F.col(value).alias("_b"), F.lit(1).alias("_inb"))
    return a.join(b, list(keys), "full").filter(~(F.col("_ina").eqNullSafe(F.col("_inb")) & F.col("_a").eqNullSafe(F.col("_b")))).drop("_ina", "_inb")


def blocked_but_published(releases: DataFrame) -> DataFrame:
    return releases.filter("decision = 'BLOCK' and not is_forced")


def not_fully_caught(graded: DataFrame) -> DataFrame:
    return graded.filter("recall < 1 or not coalesce(handled_as_expected, false)")


def uncategorized(products: DataFrame, code: str = "category_code") -> DataFrame:
    return products.filter(F.col(code) == "UNCATEGORIZED")


def verdict(violations: DataFrame, warn_above: int | None = None, error_above: int | None = 0) -> str:
    """pass, warn or error by the number of violating rows; a bound of None never applies."""
    n = violations.count()
    if error_above is not None and n > error_above:
        return "error"
    return "warn" if warn_above is not None and n > warn_above else "pass"
