"""Exact medians of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Value buckets for each doubling of a value, about.
FINENESS = 45


def _bucket(x: Column) -> Column:
    """A number that never falls when x grows."""
    x = x.cast("double")
    return F.when(F.isnan(x), 1_000_000).otherwise(F.signum(x) * F.floor(F.log1p(F.abs(x)) * FINENESS / 0.6931)).cast("int")


def lower_median(df: DataFrame, by: Sequence[str], value: str, name: str, n: str = "n_values", times: str | None = None) -> DataFrame:
    """For each group its lower median, the least value that at least half of the values aren't above, and how many values it has.

    With the column ``times`` rows are counts already: one for each value of a group, which stands for so many. Else equal values are counted first, which deals large groups out by value and combines before the shuffle. Counts by bucket of value
    say which bucket holds the median, and only that bucket's values are put in order, so no task holds or sorts a whole group. Nulls are
    no values, and a group without values has no row; a null in ``by`` is a group like any other.
    """
    some = df.filter(F.col(value).isNotNull())
    counts = some.select(*by, F.col(value).alias("_v"), F.col(times).alias("_n")) if times else some.groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    held = counts.withColumn("_b", _bucket(F.col("_v")))
    w = Window.partitionBy(*by)
    ranked = held.groupBy(*by, "_b").agg(F.sum("_n").alias("_k")).withColumns(
        {"_upto": F.sum("_k").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)), n: F.sum("_k").over(w)}
    )
    middle = F.floor((F.col(n) + 1) / 2)
    found = ranked.filter((F.col("_upto") >= middle) & (F.col("_upto") - F.col("_k") < middle))
    found = found.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_b").alias("_at"), (middle - F.col("_upto") + F.col("_k")).alias("_rank"), n)
    same = F.col("_b") == F.col("_at")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    inside = held.join(found, same).select(*by, "_v", "_n", "_rank", n)
    upto = F.sum("_n").over(w.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return inside.withColumn("_upto", upto).filter(F.col("_upto") >= F.col("_rank")).groupBy(*by).agg(F.min("_v").alias(name), F.first(n).alias(n))


def with_lower_median(df: DataFrame, by: Sequence[str], value: Column, name: str, n: str) -> DataFrame:
    """df with the lower median of its group's values and their number, both null for groups without values and where a part of ``by`` is
    null, which no join would match.

    Rows are shuffled and sorted once by group, without a second pass that joins them to their median. For groups that one task can sort,
    as of an object's readings; lower_median() deals out larger ones.
    """
    known = F.lit(True)
    for c in by:
        known = known & F.col(c).isNotNull()
    w = Window.partitionBy(*by).orderBy(F.col("_v").asc_nulls_last())
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumn("_v", F.when(known, value)).withColumns({"_at": F.row_number().over(w), n: F.nullif(F.count("_v").over(whole), F.lit(0))})
    return df.withColumn(name, F.max(F.when(F.col("_at") == F.floor((F.col(n) + 1) / 2), F.col("_v"))).over(whole)).drop("_v", "_at")


def joined(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """An inner join on columns of which a null equals a null; the right side's come once."""
    renamed = right.select(*[F.col(c).alias(f"_by{i}") if c in by else F.col(c) for i, c in enumerate(right.columns)])
    on = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(right.columns) if c in by]
    return left.join(renamed, on).select(*left.columns, *[c for c in right.columns if c not in by])
