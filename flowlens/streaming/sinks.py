"""Sinks for predictions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.schema import STORED_NAMES
from flowlens.streaming.archive import compact_day, read_batches, read_once

#: Kinds of rows in a table of predictions: scored flows, and messages that could not be scored.
SCORED, UNFIT = "scored", "unfit"

# The columns of a stored prediction, before the bookkeeping columns.
STORED = [
    "uid", "timestamp", "id_orig_h", "id_orig_p", "id_resp_h", "id_resp_p", "proto",
    "prediction", "probability", "predicted_label", "label", "detailed_label",
]


STORED_TYPES = (
    "uid string, timestamp timestamp, id_orig_h string, id_orig_p double, id_resp_h string, "
    "id_resp_p double, proto string, prediction double, probability array<double>, "
    "predicted_label string, label string, detailed_label string, processing_time timestamp, "
    "batch_id long"
)
UNFIT_TYPES = "value string, reason string, timestamp timestamp, batch_id long"


def stored_columns(scored: DataFrame, batch_id: int, *also: str) -> DataFrame:
    """The columns kept for a prediction, with the time of processing and the batch."""
    return (
        scored.withColumnsRenamed(STORED_NAMES)
        .select(*STORED, *also)
        .withColumns(
            {
                "processing_time": F.current_timestamp(),
                "batch_id": F.lit(batch_id).cast("long"),
            }
        )
    )


@dataclass(frozen=True)
class Batch:
    """A micro-batch: the same input always has the same folder below a table's path.

    The query's id is part of it, as a new checkpoint starts a new query whose batches count
    from 0 again.
    """

    query_id: str
    batch_id: int

    @property
    def key(self) -> str:
        return f"{self.query_id}-{self.batch_id}"


def running_batch(rows: DataFrame, batch_id: int) -> Batch:
    """The batch that a stream is running now."""
    context = rows.sparkSession.sparkContext
    return Batch(context.getLocalProperty("sql.streaming.queryId"), batch_id)


def start_batches(
    stream: DataFrame,
    store: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Give each micro-batch to ``store``; without a trigger interval, read what is there and stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def write_batch(df: DataFrame, path: str, batch: Batch) -> None:
    """Write a micro-batch to its folder, replacing what an earlier try left there on any day.

    Rows that have a ``kind`` lie below it by kind. Each keeps its ``event_day``, by default the day
    of its own ``timestamp``; a reader of one day gets exactly its rows, and skips files by their
    statistics. Tasks write what they have made, without a shuffle: a file for each task and kind,
    until a compaction puts closed days together.
    """
    if "event_day" not in df.columns:
        df = df.withColumn("event_day", F.to_date("timestamp"))
    writer = df.write.mode("overwrite")
    if "kind" in df.columns:
        writer = writer.partitionBy("kind")
    writer.parquet(f"{path}/write_key={batch.key}")


def read_scored(spark: SparkSession, path: str, archive: str | None = None) -> DataFrame:
    """Each stored prediction once, from the batches below ``path`` and the archive's closed days."""
    schema = f"{STORED_TYPES}, kind string"
    rows = read_once(spark, path, schema, archive)
    return rows.where(F.col("kind") == SCORED).drop("kind")


def read_unfit(spark: SparkSession, path: str) -> DataFrame:
    """Messages that could not be scored, with the reason; they stay in their batches."""
    rows = read_batches(spark, path, f"{UNFIT_TYPES}, kind string")
    return rows.where(F.col("kind") == UNFIT).drop("kind", "write_key")


def compact_scored(spark: SparkSession, path: str, archive: str, day: str, ended: bool = False) -> None:
    """Put a closed day's predictions of all batches into few files of the archive."""
    only = lambda rows: rows.where(F.col("kind") == SCORED)
    compact_day(spark, path, archive, day, f"{STORED_TYPES}, kind string", only, ended)


BatchWriter = Callable[[DataFrame, str, Batch], None]


def document_writer(uri: str, database: str, collection: str) -> BatchWriter:
    """A batch writer for a MongoDB collection, which needs Spark's MongoDB connector.

    Executors write their own rows. A document is replaced by one with the same id, so a batch
    that is run again adds nothing twice. The id is the flow's, or without one made of the query,
    the batch and the row.
    """
    options = {
        "connection.uri": uri,
        "database": database,
        "collection": collection,
        "operationType": "replace",
        "upsertDocument": "true",
        "idFieldList": "_id",
    }

    def write(df: DataFrame, path: str, batch: Batch) -> None:
        row = F.to_json(F.struct(*(c for c in df.columns if c != "processing_time")))
        own = F.sha2(F.concat_ws("|", F.lit(batch.key), row), 256)
        named = df.withColumn("_id", F.coalesce(F.col("uid").cast("string"), own))
        named.write.format("mongodb").mode("append").options(**options).save()

    return write


def start_table(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Stream into a Parquet table; without a trigger interval, read what is there and stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def start_memory(stream: DataFrame, name: str, mode: str = "append") -> StreamingQuery:
    """Stream into a table on the driver, starting anew each time; for tests and small results."""
    return (
        stream.writeStream.format("memory")
        .queryName(name)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )


def write_snapshot(df: DataFrame, path: str) -> None:
    """Predictions as CSV with a header; array columns become text separated by spaces."""
    arrays = {
        f.name: F.concat_ws(" ", F.transform(f.name, lambda x: x.cast("string")))
        for f in df.schema.fields
        if f.dataType.typeName() == "array"
    }
    df.withColumns(arrays).write.mode("overwrite").option("header", True).csv(path)
