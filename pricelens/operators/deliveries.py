"""Which delivered files, and which markets in them, can be trusted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelens.functions.text import surrogate_key
from pricelens.operators.medians import lower_median


def content_fingerprint(line: Column) -> Column:
    """An aggregate that equal sets of lines have in common, whatever their order."""
    return F.sum(F.xxhash64(line).cast("decimal(38,0)"))


def profile_files(obs: DataFrame, line: str = "raw_line", file_col: str = "source_file_name", member: str = "market", facts: Sequence[str] = ("delivered_file_name", "file_crawl_date", "file_exported_at", "file_name_has_copy_suffix")) -> DataFrame:
    """A row for each file: its facts, lines, members, first and last crawl time, fingerprint."""
    return obs.groupBy(file_col).agg(
        *[F.first(c).alias(c) for c in facts if c in obs.columns],
        *([F.min("loaded_at").alias("loaded_at")] if "loaded_at" in obs.columns else []),
        F.count(F.lit(1)).alias("n_lines"),
        F.sort_array(F.collect_set(member)).alias(f"{member}s"),
        F.min("crawled_at").alias("first_crawled_at"),
        F.max("crawled_at").alias("last_crawled_at"),
        content_fingerprint(F.col(line)).alias("content_fingerprint"),
    )


def flag_duplicate_content(files: DataFrame, name: str = "delivered_file_name", order: Sequence[str] = ("file_name_has_copy_suffix", "file_exported_at", "source_file_name")) -> DataFrame:
    """Files whose content an earlier one (no copy suffix, then first exported) has, and that one's name."""
    w = Window.partitionBy("content_fingerprint", "n_lines").orderBy(*order)
    out = files.withColumn("is_duplicate_content", F.row_number().over(w) > 1)
    return out.withColumn("duplicate_of_file", F.when(F.col("is_duplicate_content"), F.first(name).over(w)))


def flag_stale_content(files: DataFrame, days: int, claimed: str = "file_crawl_date", newest: str = "last_crawled_at") -> DataFrame:
    """Files whose newest crawl is more than so many days before the date that their name claims."""
    return files.withColumn("is_stale_content", F.date_diff(F.col(claimed), F.to_date(newest)) > days)


def partial_members(obs: DataFrame, threshold: float, file_col: str = "source_file_name", member: str = "market") -> DataFrame:
    """For each file, the members with fewer lines than the threshold times their median over all files."""
    counts = obs.groupBy(file_col, member).agg(F.count(F.lit(1)).alias("n"))
    usual = lower_median(counts, [member], "n", "usual")
    few = counts.join(usual, member).filter(F.col("n") < F.col("usual") * threshold)
    return few.groupBy(file_col).agg(F.sort_array(F.collect_list(member)).alias(f"partial_{member}s"))


def infer_scope(files: DataFrame, base: Sequence[str], members: str = "markets") -> DataFrame:
    return files.withColumn("crawl_scope", F.when(F.size(members) > len(base), "extended").otherwise("weekly"))


def missing_members(files: DataFrame, weekly: Sequence[str], every: Sequence[str], members: str = "markets") -> DataFrame:
    """Members that a file of its scope should have."""
    expected = F.when(F.col("crawl_scope") == "weekly", F.array(*map(F.lit, weekly))).otherwise(F.array(*map(F.lit, every)))
    return files.withColumn(f"missing_{members}", F.array_except(expected, F.col(members)))


def file_status(files: DataFrame, members: str = "markets") -> DataFrame:
    """block for duplicate or stale content, warn for missing or partial members, else ok; trusted unless blocked."""
    blocked = F.col("is_duplicate_content") | F.coalesce("is_stale_content", F.lit(False))
    lacking = (F.size(f"missing_{members}") > 0) | (F.size(f"partial_{members}") > 0)
    return files.withColumns({"file_status": F.when(blocked, "block").when(lacking, "warn").otherwise("ok"), "is_trusted": ~blocked})


def assess_files(obs: DataFrame, weekly: Sequence[str], every: Sequence[str], threshold: float, stale_days: int, line: str = "raw_line") -> DataFrame:
    """All file checks together."""
    files = infer_scope(flag_stale_content(flag_duplicate_content(profile_files(obs, line)), stale_days), weekly)
    files = files.join(partial_members(obs, threshold), "source_file_name", "left")
    files = files.withColumn("partial_markets", F.coalesce("partial_markets", F.array().cast("array<string>")))
    files = file_status(missing_members(files, weekly, every))
    return files.withColumns({"content_crawl_date": F.to_date("first_crawled_at"), "delivered_at": F.col("file_exported_at"), "n_markets": F.size("markets")})


def assess_batches(obs: DataFrame, files: DataFrame) -> DataFrame:
    """A row for each file and market: lines, usable lines, and whether the as-of rule may choose it."""
    rows = obs.groupBy("source_file_name", "market").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("dq_status") != "quarantine").alias("n_usable_lines"),
        F.min("crawled_at").alias("first_crawled_at"),
        F.max("crawled_at").alias("last_crawled_at"),
    )
    facts = files.select("source_file_name", "delivered_file_name", "crawl_scope", F.col("content_crawl_date").alias("crawl_date"), "delivered_at", F.col("file_status").alias("delivery_status"), F.col("is_trusted").alias("is_trusted_delivery"), "partial_markets")
    out = rows.join(facts, "source_file_name").withColumn("is_partial", F.array_contains("partial_markets", F.col("market")))
    return out.withColumns(
        {"market_batch_id": surrogate_key(F.col("source_file_name"), F.col("market")), "is_eligible": F.col("is_trusted_delivery") & ~F.col("is_partial")}
    ).drop("partial_markets")
