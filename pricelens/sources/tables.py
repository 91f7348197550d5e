"""Intermediate tables that end a long lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: A side that can grow with the data is broadcast only when it was counted and has at most so many narrow rows.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most ``rows`` rows, else df for a shuffled join. Call it on a written table."""
    return F.broadcast(df) if df.count() <= rows else df


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which the driver and all executors share; a temporary one only in local mode."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="pricelens-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet to the folder in spark.checkpoint.dir (in local mode, where that is unset, to a temporary one) and read it
    back.

    What reads it is planned anew from a scan, with its statistics, and survives lost executors. It is deleted when the application
    ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"

    atexit.register(delete_folder, spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder; nothing happens once the session has stopped."""
    sc = spark.sparkContext
    if sc._jsc is not None and not sc._jsc.sc().isStopped():
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
