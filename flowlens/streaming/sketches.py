"""Distributions of a stream's measures by class, from sketches kept for each micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators.quantiles import SKETCH, merge_sketches, sketches
from flowlens.streaming.archive import compact_day, read_once
from flowlens.streaming.sinks import running_batch, start_batches, write_batch


def _schema(by: str) -> str:
    return f"column string, {by} string, sketch binary, n long"


def start_sketches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    columns: Sequence[str],
    by: str = "label",
    k: int = SKETCH,
    every: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch's sketches by class and day; a batch run again replaces its own."""

    def store(rows: DataFrame, batch_id: int) -> None:
        dated = rows.withColumn("event_day", F.to_date("timestamp"))
        parts = sketches(dated, columns, [by, "event_day"], k)
        write_batch(parts, path, running_batch(rows, batch_id))

    return start_batches(stream, store, checkpoint, every)


def read_sketches(
    spark: SparkSession, path: str, by: str = "label", archive: str | None = None
) -> DataFrame:
    """One sketch for each measure and class, over all days and batches."""
    return merge_sketches(read_once(spark, path, _schema(by), archive), [by])


def compact_sketches(
    spark: SparkSession, path: str, archive: str, day: str, by: str = "label", ended: bool = False
) -> None:
    """Merge a closed day's sketches into one for each measure and class."""
    fold = lambda rows: merge_sketches(rows, [by])
    compact_day(spark, path, archive, day, _schema(by), fold, ended)
