"""What the corpus operators share: intermediate tables, bounded broadcasts and row-wise Arrow helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A side of a join is broadcast only when it was counted and has at most so many rows of a few dozen bytes.
BROADCAST_ROWS = 1_000_000
#: Rows of one Arrow batch that are turned into Python objects at once, and bytes of them if they are more than one row.
SLICE_ROWS = 256
SLICE_BYTES = 4_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir; in local mode, where that is unset, a temporary one."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="pricelens-")
        sc.setCheckpointDir(folder)
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    atexit.register(delete, spark, path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path of new_path(); nothing happens once the session has stopped."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def stash(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: the lineage ends here and survives lost executors."""
    return stash_at(df, what)[0]


def stash_at(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    """stash() that also returns the path, for delete()."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has been counted to have at most ``rows`` rows; else df, for a shuffled join.

    Call it on a stashed table: counting reads Parquet footers only.
    """
    return F.broadcast(df) if df.count() <= rows else df


_shipped: weakref.WeakSet = weakref.WeakSet()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a context, so that it need not be installed on the executors."""
    sc = spark.sparkContext
    if sc not in _shipped:
        package = Path(__file__).resolve().parent.parent
        folder = tempfile.mkdtemp()
        sc.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        _shipped.add(sc)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most SLICE_ROWS rows and, unless it is a single row, SLICE_BYTES bytes, in order."""
    n = batch.num_rows
    if n > SLICE_ROWS or (n > 1 and batch.nbytes > SLICE_BYTES):
        yield from slices(batch.slice(0, n // 2))
        yield from slices(batch.slice(n // 2))
    elif n:
        yield batch


def map_rows(
    df: DataFrame, make: Callable[[], Callable[[list[list]], dict[str, object]]], schema: str, keep: list[str] | None = None
) -> DataFrame:
    """Apply a Python function to slices of rows by Arrow.

    ``make()`` is called once a task and returns a function from the columns' value lists to the new columns (lists or Arrow
    arrays). ``keep`` columns are passed on as they are, by position, so clashing names do no harm; ``schema`` is that of
    the new columns.
    """
    ship(df.sparkSession)
    keep = keep or []
    new = T.StructType.fromDDL(schema)
    names = [f.name for f in new]
    fields = [df.schema[df.columns.index(c)] for c in keep] + list(new)
    out = T.StructType([T.StructField(f"_{i}", f.dataType, f.nullable) for i, f in enumerate(fields)])
    arrow = to_arrow_schema(out)
    rest = [i for i, c in enumerate(df.columns) if c not in keep]
    held = [df.columns.index(c) for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for part in slices(whole):
                got = fn([part.column(i).to_pylist() for i in rest])
                cols = [part.column(i) for i in held] + [got[n] for n in names]
                cols = [c.cast(t.type) if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(cols, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return df.mapInArrow(run, out).toDF(*keep, *names)
