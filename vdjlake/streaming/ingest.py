"""Sequence records as a stream of files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType


def file_stream(spark: SparkSession, folder: str, schema: StructType, files_a_batch: int = 100) -> DataFrame:
    """Rows of Parquet files as they arrive in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def first_seen(stream: DataFrame, value: str = "sequence_aa", event_time: str | None = None, late: str = "1 day") -> DataFrame:
    """The first row of each value; rows with a null or empty value all pass, beside the state.

    Without an event time the state grows with the values seen and lives as long as the checkpoint. With one, a value
    is remembered for ``late`` behind the watermark and may come out again after that.
    """
    timed = stream.withWatermark(event_time, late) if event_time else stream
    is_named = F.coalesce(F.col(value) != "", F.lit(False))
    named, others = timed.filter(is_named), timed.filter(~is_named)
    once = named.dropDuplicatesWithinWatermark([value]) if event_time else named.dropDuplicates([value])
    return once.unionByName(others)


def windowed_counts(stream: DataFrame, event_time: str, keys: Sequence[str], width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Rows by key in tumbling windows; a window closes when the watermark passes it."""
    return stream.withWatermark(event_time, late).groupBy(F.window(event_time, width), *keys).agg(F.count(F.lit(1)).alias("count"))


def ingest(stream: DataFrame, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append what is there now to a Parquet table and stop; a later call goes on from the checkpoint.

    Each batch is written to its own folder under a name of its number, so that a batch repeated after a failure
    replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
