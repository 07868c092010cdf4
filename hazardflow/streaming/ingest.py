"""Streams of landed documents and their sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from hazardflow import config
from hazardflow.operators import dedup
from hazardflow.sources import geojson, tables


def landed_documents(
    spark: SparkSession, landing: str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of documents, one per line, from a landing folder."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return geojson.from_text(reader.text(landing).filter("trim(value) != ''"), "value")


def start(writer: DataStreamWriter, available_now: bool = False) -> StreamingQuery:
    """Poll on the configured interval, or drain what is there and stop."""
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=config.POLL_INTERVAL).start()


def append_table(stream: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    """Day-partitioned append; the file sink's log makes it exactly once."""
    writer = stream.writeStream.format("parquet").option("path", root)
    return writer.option("checkpointLocation", checkpoint).partitionBy(*tables.PARTS)


def upsert_table(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    merge: Callable[[DataFrame], DataFrame] = dedup.latest_quakes,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
    key: str = "event_id",
    then: Callable[[tables.Touched, int], None] | None = None,
) -> DataStreamWriter:
    """Merge every micro-batch into a day-partitioned table.

    Streaming dedup keeps the first row it sees. Here the newest wins, so the
    batch is merged with the stored days. The stage of a batch lives under the
    checkpoint, so a retried batch finds its own and no other query's.

    ``then`` gets the touched days after each batch, with its changes, and the batch's number, to
    bring tables that derive from this one up to date. It is part of the batch: a retry repeats it.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch if prepare is None else prepare(batch, batch_id)
        after = None if then is None else lambda touched: then(touched, batch_id)
        tables.upsert_days(rows, root, merge, [key], f"{checkpoint}/stage/{batch_id}", after)

    writer = stream.writeStream.foreachBatch(merge_batch)
    return writer.option("checkpointLocation", checkpoint)
