"""What of the marts is public: only what the release ledger names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def released(releases: DataFrame) -> DataFrame:
    """Each released delivery: its latest decision, whether it was ever forced, its first release."""
    return releases.groupBy("scope", "as_of_date").agg(
        F.max_by("decision", F.struct("released_at", "release_id")).alias("decision"), F.bool_or("is_forced").alias("is_forced"), F.min("released_at").alias("first_released_at")
    )


def only_released(df: DataFrame, date_col: str, releases: DataFrame, scope: str | None = None) -> DataFrame:
    """Rows whose date is released, in one scope or in any."""
    ok = releases if scope is None else releases.filter(F.col("scope") == scope)
    return df.join(ok.select(F.col("as_of_date").alias(date_col)).distinct(), date_col, "left_semi").select(*df.columns)


def only_released_months(df: DataFrame, month_col: str, releases: DataFrame, scope: str) -> DataFrame:
    months = releases.filter(F.col("scope") == scope).select(F.trunc("as_of_date", "MM").alias(month_col)).distinct()
    return df.join(months, month_col, "left_semi").select(*df.columns)


def until_released(df: DataFrame, date_col: str, releases: DataFrame) -> DataFrame:
    """Rows strictly before the latest released date, a single value that the scan can filter by."""
    last = releases.agg(F.max("as_of_date")).first()[0]
    return df.filter(F.lit(False)) if last is None else df.filter(F.col(date_col) < F.lit(last))


def reference(df: DataFrame) -> DataFrame:
    """A reference table is no part of a delivery: it is published as it is, whatever was released."""
    return df


def enforce_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """df if its column names and types are exactly the contract's; else an error that names the differences."""
    have, want = {f.name: f.dataType.simpleString() for f in df.schema}, {f.name: f.dataType.simpleString() for f in contract}
    wrong = [f"{c}: {have.get(c, 'missing')}, not {want.get(c, 'in the contract')}" for c in sorted(have.keys() | want.keys()) if have.get(c) != want.get(c)]
    if wrong:
        raise ValueError("contract broken: " + "; ".join(wrong))
    return df.select(*contract.fieldNames())
