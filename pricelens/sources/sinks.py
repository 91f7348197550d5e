"""Writing results: incremental upserts, ledgers and public snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.sources.tables import materialise, small


def recent_rows(source: DataFrame, target: DataFrame, time_col: str, lookback_days: int) -> DataFrame:
    """Source rows newer than the target's newest time less the lookback; all of them for an empty target.

    The one newest time comes to the driver, so that the scan of the source can skip what is older.
    """
    newest = target.agg(F.max(time_col)).first()[0]
    return source if newest is None else source.filter(F.col(time_col) > F.lit(newest) - F.expr(f"interval {lookback_days} days"))


def latest_changes(changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row a key: the greatest by ``order``, then by the other columns, so that ties have one answer."""
    rest = [c for c in changes.columns if c != key and c not in order]
    return changes.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_c")).select(*[F.col(key) if c == key else F.col(f"_c.{c}").alias(c) for c in changes.columns])


def upsert(target: DataFrame, changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The target with rows of equal key replaced by the latest change and new keys added.

    Target rows whose key isn't among the changes pass as they are, unsorted, and unshuffled too where the changes' keys are few
    enough to be broadcast.
    """
    new = materialise(latest_changes(changes, key, order), "changes")
    return target.join(small(new.select(key)), key, "left_anti").select(*target.columns).unionByName(new)


def upsert_incremental(target: DataFrame, source: DataFrame, key: str, time_col: str, lookback_days: int) -> DataFrame:
    """What an incremental run makes of the target; from an empty target it is a full refresh."""
    return upsert(target, recent_rows(source, target, time_col, lookback_days), key, [time_col])


def format_cells(df: DataFrame) -> DataFrame:
    """Every column as text: ISO dates and times, plain decimals without trailing zeros, true/false, arrays joined by '; '."""
    out = []
    for f in df.schema:
        c, kind = F.col(f.name), f.dataType
        if isinstance(kind, T.ArrayType):
            text = F.array_join(c.cast("array<string>"), "; ")
        elif isinstance(kind, T.DecimalType):
            text = F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
        elif isinstance(kind, T.TimestampType):
            text = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        else:
            text = c.cast("string")
        out.append(text.alias(f.name))
    return df.select(*out)


def mask_columns(df: DataFrame, masks: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Replace a pattern in named text columns; nulls and other columns stay."""
    return df.withColumns({c: F.regexp_replace(c, pattern, to) for c, (pattern, to) in masks.items()})


def assert_public(names: Sequence[str], allowed: Sequence[str]) -> None:
    refused = sorted(set(names) - set(allowed))
    if refused:
        raise ValueError(f"not public: {', '.join(refused)}")


def unreleased(df: DataFrame, date_col: str, releases: DataFrame, released_col: str = "as_of_date") -> DataFrame:
    """Dates of df without a release."""
    return df.select(F.col(date_col).alias(released_col)).distinct().join(releases.select(released_col).distinct(), released_col, "left_anti")


def assert_released(df: DataFrame, date_col: str, releases: DataFrame) -> None:
    if releases.isEmpty():
        raise ValueError("nothing is released")
    left = [str(r[0]) for r in unreleased(df, date_col, releases).limit(5).collect()]
    if left:
        raise ValueError(f"not released: {', '.join(left)}")


def export_snapshot(tables: Mapping[str, DataFrame], order: Mapping[str, Sequence[str]], folder: str, masks: Mapping[str, tuple[str, str]] | None = None) -> None:
    """Write each table as CSV in its fixed order, cells as format_cells() has them, masked columns masked."""
    for name, df in tables.items():
        own = {c: m for c, m in (masks or {}).items() if c in df.columns}
        format_cells(mask_columns(df.orderBy(*order[name]), own)).write.mode("overwrite").csv(f"{folder}/{name}", header=True)


def snapshot_manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table, n_rows, columns and a checksum that doesn't depend on the order of rows."""
    out = None
    for name, df in tables.items():
        line = F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("\x00")) for c in df.columns])
        text = format_cells(df).select(F.md5(line).alias("h"))
        row = text.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.lit(", ".join(df.columns)).alias("columns"),
            F.coalesce(F.sum(F.conv(F.substring("h", 1, 12), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"),
        )
        out = row if out is None else out.unionByName(row)
    return out


#: Buckets that two snapshots are compared by before their rows are.
DRIFT_BUCKETS = 256


def _fingerprint(df: DataFrame, salt: int):
    """A hash of a row in which a null differs from every value, wherever it stands, and equal numbers are equal."""
    plain = [F.col(f"`{f.name}`") + 0.0 if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`") for f in df.schema]
    return F.xxhash64(F.lit(salt), *plain, *[c.isNull() for c in plain])


def drifted_buckets(now: DataFrame, then: DataFrame, n_buckets: int = DRIFT_BUCKETS) -> list[int]:
    """The buckets of rows in which the two sides differ, from counts and sums of two hashes: rows aren't shuffled for it."""

    def sums(df: DataFrame) -> DataFrame:
        two = df.select(_fingerprint(df, 1).alias("h"), _fingerprint(df, 2).alias("g"))
        held = two.groupBy(F.pmod("h", F.lit(n_buckets)).alias("b"))
        return held.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("h", "g")])

    a, b = sums(now).alias("a"), sums(then).alias("b")
    same = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.h").eqNullSafe(F.col("b.h")) & F.col("a.g").eqNullSafe(F.col("b.g"))
    both = a.join(b, F.col("a.b") == F.col("b.b"), "full").filter(~same)
    return sorted(r[0] for r in both.select(F.coalesce("a.b", "b.b")).collect())


def diff_snapshot(now: DataFrame, then: DataFrame, n_buckets: int = DRIFT_BUCKETS) -> DataFrame:
    """Rows that one side has more often than the other, with the side in ``side``.

    Sums by bucket are compared first, over one narrow pass of each side; rows meet only in buckets that differ, and where none does
    there is nothing more to do.
    """
    differ = drifted_buckets(now, then, n_buckets)
    if not differ:
        return now.sparkSession.createDataFrame([], now.withColumn("side", F.lit("now")).schema)
    inside = lambda df: df.filter(F.pmod(_fingerprint(df, 1), F.lit(n_buckets)).isin(differ))
    a, b = inside(now), inside(then)
    return a.exceptAll(b).withColumn("side", F.lit("now")).unionByName(b.exceptAll(a).withColumn("side", F.lit("then")))
