"""Price periods by gaps and islands, and the changes between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelens.functions.text import surrogate_key


def price_islands(df: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """Number the runs of equal values of each key, in order."""
    w = Window.partitionBy(key).orderBy(*order)
    changed = df.withColumn("_new", F.when(F.lag(value).over(w) == F.col(value), 0).otherwise(1))
    return changed.withColumn("period_number", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_new")


def scd2_periods(df: DataFrame, key: str, order: Sequence[str], value: str, attributes: Sequence[str] = ()) -> DataFrame:
    """A row for each run: valid_from (the first of order's leading column) to valid_to, previous value, relative change."""
    date = order[0]
    runs = price_islands(df, key, order, value).groupBy(key, "period_number").agg(
        F.first(value).alias(value),
        *[F.first(a).alias(a) for a in attributes],
        F.min(date).alias("valid_from"),
        F.max(date).alias("last_observed_date"),
        F.count(F.lit(1)).alias("n_observations"),
    )
    w = Window.partitionBy(key).orderBy("valid_from", "period_number")
    out = runs.withColumns({f"previous_{value}": F.lag(value).over(w), "valid_to": F.lead("valid_from").over(w)})
    return out.withColumns(
        {
            "change_vs_previous": F.round(F.try_divide(F.col(value), F.col(f"previous_{value}")) - 1, 4),
            "is_current_period": F.col("valid_to").isNull(),
            "price_period_id": surrogate_key(F.col(key), F.col("valid_from")),
        }
    )


def changed_readings(df: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """The readings that begin a period of scd2_periods() other than a key's first, with the columns that periods have of their start
    and of the value before: one sort, and no period is put together.
    """
    previous = F.lag(value).over(Window.partitionBy(key).orderBy(*order))
    rows = df.withColumn(f"previous_{value}", previous).filter(F.col(f"previous_{value}").isNotNull() & ~F.col(f"previous_{value}").eqNullSafe(F.col(value)))
    change = F.round(F.try_divide(F.col(value), F.col(f"previous_{value}")) - 1, 4)
    return rows.withColumns({"valid_from": F.col(order[0]), "change_vs_previous": change, "price_period_id": surrogate_key(F.col(key), F.col(order[0]))})


def change_events(periods: DataFrame, value: str, products: DataFrame | None = None, on: str = "sku") -> DataFrame:
    """Every period but a key's first, with its direction, and the product's columns if given."""
    previous = F.col(f"previous_{value}")
    out = periods.filter(previous.isNotNull()).withColumn("direction", F.when(F.col(value) > previous, "increase").otherwise("decrease"))
    return out if products is None else out.join(products, on, "left")
