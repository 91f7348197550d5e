"""A keyed table in buckets, of which an upsert rewrites only those that its keys fall into."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.sources.commits import CommitLog
from pricelens.sources.tables import delete_folder, materialise

#: Runs whose ids a version remembers, and versions whose files stay for readers that began before.
RUNS, VERSIONS = 1000, 2


class BucketedTable:
    """Rows dealt to buckets by a hash of their key; a version is an entry in a commit log that names each bucket's folder.

    An upsert reads and writes the buckets that its changes touch and then commits the next version; other buckets' files stay as they
    are, byte for byte. Readers see a version as a whole. A run that dies before its commit changes nothing, and one that is repeated
    under its id changes nothing more. Of two runs at once one commits, and the other is told.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType | str, n_buckets: int = 64):
        self.spark, self.path, self.key, self.n_buckets = spark, path.rstrip("/"), key, n_buckets
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.log = CommitLog(spark, f"{self.path}/_versions")

    def version(self) -> tuple[int, dict]:
        """The newest version's number (0: none) and entry."""
        numbers = [int(n) for n in self.log.names()]
        empty = {"runs": [], "streams": {}, "n_buckets": self.n_buckets, "buckets": {}}
        return (max(numbers), self.log.read(f"{max(numbers):012d}")) if numbers else (0, empty)

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        paths = [f"{self.path}/{f}" for f in folders]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        return self._rows(sorted(self.version()[1]["buckets"].values()))

    def upsert(self, changes: DataFrame, order: Sequence[str], run: str | None = None, stream: tuple[str, int] | None = None, rivals: bool = False) -> list[int]:
        """Replace rows of equal key by the latest change, add new keys, and return the buckets that were written.

        Of several changes of a key the greatest by ``order``, then by the other columns, counts; with ``rivals`` the row that is there
        counts among them, so that a late change changes nothing. ``run``, or a stream's name and batch number, is what makes a
        repeated run known.
        """
        number, now = self.version()
        if now["n_buckets"] != self.n_buckets:
            raise ValueError(f"the table has {now['n_buckets']} buckets")
        if run in now["runs"] or (stream and stream[1] <= now["streams"].get(stream[0], -1)):
            return []
        names = self.schema.fieldNames()
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.n_buckets)).cast("int").alias("_bucket")
        new = materialise(changes.select(*[F.col(f.name).cast(f.dataType) for f in self.schema], bucket), "changes")
        touched = sorted(r[0] for r in new.select("_bucket").distinct().collect())
        old = self._rows([now["buckets"][str(b)] for b in touched if str(b) in now["buckets"]]).select("*", bucket)
        age = lambda is_new: F.lit(0 if rivals else is_new).alias("_new")
        both = old.select("*", age(0)).unionByName(new.select("*", age(1))).repartition("_bucket")
        rest = [c for c in names if c != self.key and c not in order]
        best = both.groupBy("_bucket", self.key).agg(F.max(F.struct("_new", *order, *rest)).alias("_r"))
        rows = best.select("_bucket", *[F.col(c) if c == self.key else F.col(f"_r.{c}").alias(c) for c in names])
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        entry = {
            "runs": (now["runs"] + [run] if run else now["runs"])[-RUNS:],
            "streams": now["streams"] | ({stream[0]: stream[1]} if stream else {}),
            "n_buckets": self.n_buckets,
            "buckets": now["buckets"] | {str(b): f"{folder}/_bucket={b}" for b in touched},
        }
        if not self.log.add(f"{number + 1:012d}", entry):
            delete_folder(self.spark, f"{self.path}/{folder}")
            raise RuntimeError(f"another run committed version {number + 1}: start again from there")
        self._forget(number + 1)
        return touched

    def _forget(self, newest: int) -> None:
        """Delete the folders that only versions older than the last few name."""
        old = [n for n in self.log.names() if int(n) <= newest - VERSIONS]
        kept = {f for n in self.log.names() if n not in old for f in self.log.read(n)["buckets"].values()}
        for n in old:
            for f in set(self.log.read(n)["buckets"].values()) - kept:
                delete_folder(self.spark, f"{self.path}/{f}")
            self.log.remove(n)
