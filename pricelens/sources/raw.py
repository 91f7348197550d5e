"""Reading delivered files and reference data, and first looks at what was loaded."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.sources.commits import CommitLog
from pricelens.sources.tables import delete_folder

BRONZE = T.StructType(
    [
        T.StructField("raw_line", T.StringType()),
        T.StructField("source_file_path", T.StringType()),
        T.StructField("source_file_name", T.StringType()),
        T.StructField("source_file_size", T.LongType()),
        T.StructField("source_file_modified_at", T.TimestampType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)


def with_file_facts(lines: DataFrame) -> DataFrame:
    """Raw text lines with the facts of their file and the time they were loaded."""
    return lines.select(
        F.col("value").alias("raw_line"),
        F.col("_metadata.file_path").alias("source_file_path"),
        F.col("_metadata.file_name").alias("source_file_name"),
        F.col("_metadata.file_size").alias("source_file_size"),
        F.col("_metadata.file_modification_time").alias("source_file_modified_at"),
        F.current_timestamp().alias("loaded_at"),
    )


def read_raw_lines(spark: SparkSession, folder: str, glob: str = "*.ndjson.gz") -> DataFrame:
    """Every line of the folder's files as text."""
    return with_file_facts(spark.read.option("pathGlobFilter", glob).text(folder))


def new_files(lines: DataFrame, bronze: DataFrame) -> DataFrame:
    """Lines of files whose path isn't in bronze yet; the same content under a new name is new."""
    seen = bronze.select("source_file_path").distinct()
    return lines.join(seen, "source_file_path", "left_anti").select(*lines.columns)


class AppendOnlyTable:
    """A Parquet table that can be appended to and read; there is no way to update, delete or overwrite rows.

    A run's rows go to a folder of their own and belong to the table when the commit log names it. A run that dies half-way adds nothing,
    and one that is repeated under its id adds its rows once, whichever attempt commits first.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.log = CommitLog(spark, f"{self.path}/_runs")

    def append(self, df: DataFrame, run: str | None = None) -> bool:
        """Whether the rows were added: a run whose id has been committed isn't written again."""
        missing = [f.name for f in self.schema if f.name not in df.columns]
        if missing or len(df.columns) != len(self.schema):
            raise ValueError(f"columns must be {self.schema.fieldNames()}, got {df.columns}")
        run = run or uuid.uuid4().hex
        if self.log.has(run):
            return False
        folder = f"data/{uuid.uuid4().hex}"
        df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).write.parquet(f"{self.path}/{folder}")
        if self.log.add(run, {"folder": folder}):
            return True
        delete_folder(self.spark, f"{self.path}/{folder}")
        return False

    def runs(self) -> list[str]:
        return self.log.names()

    def read(self) -> DataFrame:
        folders = [f"{self.path}/{self.log.read(run)['folder']}" for run in self.runs()]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)


def ingest_new_files(spark: SparkSession, folder: str, bronze: AppendOnlyTable, glob: str = "*.ndjson.gz") -> None:
    """Append the lines of files that bronze hasn't seen."""
    bronze.append(new_files(read_raw_lines(spark, folder, glob), bronze.read()))


def read_reference_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header as text: quoted fields may hold line breaks and doubled quotes."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)


def read_seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A typed CSV whose empty cells are null."""
    return spark.read.schema(schema).csv(path, header=True, escape='"', nullValue="", emptyValue="")


def reconcile_load(loaded: DataFrame, expected: DataFrame, file_col: str = "source_file_name", rows_col: str = "n_rows") -> DataFrame:
    """Files whose number of lines isn't the expected one, or that are on one side only."""
    counts = loaded.groupBy(file_col).agg(F.count(F.lit(1)).alias("loaded_rows"))
    both = counts.join(expected.select(file_col, F.col(rows_col).alias("expected_rows")), file_col, "full")
    return both.filter(~F.col("loaded_rows").eqNullSafe(F.col("expected_rows"))).select(file_col, "expected_rows", "loaded_rows")


def load_overview(loaded: DataFrame, file_col: str = "source_file_name", time_col: str = "loaded_at") -> DataFrame:
    return loaded.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_lines"), F.min(time_col).alias("first_loaded_at"))


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def probe_json(lines: DataFrame, path: str, keep: Column | None = None, n: int = 20, json_col: str = "raw_line") -> DataFrame:
    """The n most frequent values of a JSON path; by default only those that aren't plain digits."""
    value = F.get_json_object(F.col(json_col), path)
    rows = lines.select(value.alias("value"))
    rows = rows.filter(~F.col("value").rlike("^[0-9]+$") if keep is None else keep)
    return rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(n)


def check_freshness(df: DataFrame, time_col: str, warn_days: int, error_days: int, now: Column | None = None) -> DataFrame:
    """The newest value, its age in days and pass, warn or error; an empty table is an error."""
    newest = df.agg(F.max(time_col).alias("newest"))
    aged = newest.withColumn("age_days", F.date_diff(F.to_date(now if now is not None else F.current_timestamp()), F.to_date("newest")))
    return aged.withColumn("status", F.when(F.col("age_days").isNull() | (F.col("age_days") > error_days), "error").when(F.col("age_days") > warn_days, "warn").otherwise("pass"))


def time_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """A row for each day from start to end, both included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))
