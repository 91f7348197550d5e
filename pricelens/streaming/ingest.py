"""File pickup and upserts as streams that stop when they have caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pricelens.sources.buckets import BucketedTable
from pricelens.sources.raw import with_file_facts


def ingest_available(spark: SparkSession, folder: str, bronze: str, checkpoint: str, glob: str = "*.ndjson.gz") -> StreamingQuery:
    """Append the lines of files not seen before to bronze; the checkpoint remembers paths, so a re-run adds nothing."""
    lines = with_file_facts(spark.readStream.option("pathGlobFilter", glob).text(folder))
    return lines.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).format("parquet").start(bronze)


def upsert_stream(changes: DataFrame, target: BucketedTable, order: str, checkpoint: str, name: str = "stream") -> StreamingQuery:
    """Merge each batch of changes into a table in buckets: a batch rewrites the buckets of its keys and commits the next version.

    Of the changes of one key in a batch, and of a change and the row that is there, the greatest by ``order`` stays, so late changes
    change nothing. A version remembers the stream's last batch, so one that is run again after its commit changes nothing either.
    """

    def merge(batch: DataFrame, number: int) -> None:
        target.upsert(batch, [order], stream=(name, number), rivals=True)

    return changes.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(merge).start()
