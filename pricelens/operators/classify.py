"""One fate for every reading: blocked, duplicate, quarantined, off by a power of ten, or accepted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.operators.medians import lower_median, with_lower_median
from pricelens.sources.tables import materialise, small

#: Readings that an object needs before its own history is its reference.
MIN_HISTORY = 3


def pre_fate(trusted: Column, issues: Column, status: Column) -> Column:
    """What disqualifies a reading before prices are compared; null if nothing does."""
    return F.when(~trusted, "blocked_delivery").when(F.array_contains(issues, "exact_duplicate_line"), "exact_duplicate").when(status == "quarantine", "quarantined_in_staging")


def no_product_page(issues: Column) -> Column:
    """Whether the line isn't a page of a product, whatever its price."""
    return F.arrays_overlap(issues, F.array(F.lit("non_product_page"), F.lit("http_error_or_invalid")))


def with_batches(obs: DataFrame, batches: DataFrame) -> DataFrame:
    """Observations with their market batch and pre_fate."""
    facts = batches.select("source_file_name", "market", "market_batch_id", "crawl_date", "delivered_at", "crawl_scope", "is_trusted_delivery", F.col("is_partial").alias("is_partial_market_batch"))
    joined = obs.join(facts, ["source_file_name", "market"])
    return joined.withColumn("pre_fate", pre_fate(F.col("is_trusted_delivery"), F.col("dq_issues"), F.col("dq_status")))


def usual_value(df: DataFrame, key: str, value: str, usual: str = "usual_value", count: str = "n_candidates") -> DataFrame:
    """The lower median and the number of a key's positive values."""
    return lower_median(df.filter(F.col(value) > 0), [key], value, usual, count)


def is_scale_outlier(value: Column, reference: Column) -> Column:
    """Whether a value is a whole power of ten away from its reference, give or take a tenth in the exponent."""
    ratio = F.log10(F.try_divide(value.cast("double"), reference.cast("double")))
    whole = F.round(ratio)
    return F.coalesce((F.abs(whole) >= 1) & (F.abs(ratio - whole) < 0.1), F.lit(False))


def with_anchor_price(scored: DataFrame, anchor: str, market: str = "market", sku: str = "sku", date: str = "crawl_date", value: str = "price_local") -> DataFrame:
    """Readings with the anchor market's price of their product and crawl, from readings that agree with their own history."""
    own = (F.col("n_candidates") >= MIN_HISTORY) & is_scale_outlier(F.col(value), F.col("usual_value"))
    anchors = F.col("pre_fate").isNull() & (F.col(market) == anchor) & (F.col(value) > 0) & ~F.coalesce(own, F.lit(False))
    return with_lower_median(scored, [sku, date], F.when(anchors, F.col(value)), "anchor_price", "_anchors").drop("_anchors")


def price_ladder(anchored: DataFrame, market: str = "market", value: str = "price_local") -> DataFrame:
    """For each market, the median ratio of its prices to the anchor's."""
    rows = anchored.filter(F.col("pre_fate").isNull() & (F.col(value) > 0) & F.col("anchor_price").isNotNull())
    ratios = rows.select(market, F.try_divide(F.col(value).cast("double"), F.col("anchor_price").cast("double")).alias("_ratio"))
    return lower_median(ratios, [market], "_ratio", "ladder_factor").drop("n_values")


def reference_price(anchored: DataFrame, ladder: DataFrame, market: str = "market") -> DataFrame:
    """The object's own history if it is long enough, else the anchor's price times the market's factor, and which it is."""
    df = anchored.join(ladder, market, "left")
    enough = F.coalesce(F.col("n_candidates") >= MIN_HISTORY, F.lit(False))
    by_ladder = F.col("anchor_price").cast("double") * F.col("ladder_factor")
    return df.withColumns(
        {
            "reference_price_local": F.when(enough, F.col("usual_value").cast("double")).otherwise(by_ladder),
            "reference_method": F.when(enough, "history").when(by_ladder.isNotNull(), "price_ladder"),
        }
    )


def classify(with_pre_fate: DataFrame, anchor: str, key: str = "object_id", market: str = "market", sku: str = "sku", date: str = "crawl_date", value: str = "price_local") -> DataFrame:
    """Every reading with its reference, whether it is a scale outlier, and exactly one fate.

    Readings are shuffled by object and by product and crawl, once each, and written with both medians; the ladder, a row a market, is
    found from what is written.
    """
    candidate = F.col("pre_fate").isNull() & (F.col(value) > 0)
    scored = with_lower_median(with_pre_fate, [key], F.when(candidate, F.col(value)), "usual_value", "n_candidates")
    anchored = materialise(with_anchor_price(scored, anchor, market, sku, date, value), "anchored")
    df = reference_price(anchored, small(materialise(price_ladder(anchored, market, value), "ladder")), market)
    outlier = F.col("reference_method").isNotNull() & is_scale_outlier(F.col(value), F.col("reference_price_local"))
    df = df.withColumn("is_price_scale_outlier", outlier)
    df = df.withColumn("fate", F.coalesce("pre_fate", F.when(F.col("is_price_scale_outlier"), "price_scale_outlier"), F.lit("accepted")))
    if "dq_issues" in df.columns:
        df = df.withColumn("is_not_a_product_page", no_product_page(F.col("dq_issues")))
    return df.withColumns(
        {
            "price_to_reference_ratio": F.round(F.try_divide(F.col(value).cast("double"), F.col("reference_price_local")), 4),
            "reference_price_local": F.round("reference_price_local", 2),
        }
    )


def accepted(classified: DataFrame) -> DataFrame:
    """The trustworthy readings."""
    return classified.filter(F.col("fate") == "accepted")
