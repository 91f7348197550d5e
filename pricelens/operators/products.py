"""One row for each product: attributes, lifespan, category."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNCATEGORIZED = "UNCATEGORIZED"


@dataclass(frozen=True)
class Rule:
    rule_id: str
    priority: int
    match_field: str
    pattern: str
    category: str


def latest_attributes(df: DataFrame, key: str, order: Sequence[Column], attributes: Sequence[str]) -> DataFrame:
    """The attributes of each key's first row in order, as a minimum that combines before the shuffle.

    Columns of ``order`` sort ascending; for a descending one pass its negative.
    """
    best = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *attributes)).alias("_b")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_b.{a}").alias(a) for a in attributes])


def lifespan(df: DataFrame, key: str, date: str, market: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.min(date).alias("first_seen_date"), F.max(date).alias("last_seen_date"), F.count_distinct(market).alias("n_markets_seen"), F.count(F.lit(1)).alias("n_observations")
    )


def apply_rules(df: DataFrame, rules: Sequence[Rule], exact: Sequence[str] = ("sku",)) -> DataFrame:
    """rule_id, match_field and category of the matching rule with the lowest priority; null where none matches.

    The rules become one ordered expression, so every pattern is compiled once and no join is needed. Fields in ``exact`` are
    compared whole, others by regular expression.
    """
    out = F.lit(None).cast("struct<rule_id:string,match_field:string,category:string>")
    for r in sorted(rules, key=lambda r: r.priority, reverse=True):
        hit = F.col(r.match_field) == r.pattern if r.match_field in exact else F.col(r.match_field).rlike(r.pattern)
        out = F.when(hit, F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.match_field).alias("match_field"), F.lit(r.category).alias("category"))).otherwise(out)
    return df.withColumn("_r", out).select(*df.columns, F.col("_r.rule_id").alias("categorized_by_rule"), F.col("_r.match_field").alias("categorized_on"), F.col("_r.category").alias("rule_category"))


def categorize(products: DataFrame, rules: Sequence[Rule], tree: DataFrame, code: str = "category_code", exact: Sequence[str] = ("sku",)) -> DataFrame:
    """Products with their category code (UNCATEGORIZED where no rule matches) and the taxonomy's columns."""
    coded = apply_rules(products, rules, exact).withColumn(code, F.coalesce("rule_category", F.lit(UNCATEGORIZED))).drop("rule_category")
    return coded.join(tree, code, "left")
