"""Event-time windows over a stream of predictions.

``start_counts`` and its readers give complete results: each micro-batch writes its own partial
counts, and a reader adds them up. No row is late and no window is held back, and there is no state.
The functions with a watermark serve live use, where a window comes out once and is then final;
rows that arrive after that are dropped, which the progress table shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators.timeline import with_alert
from flowlens.schema import MALICIOUS
from flowlens.streaming.archive import compact_day, read_once
from flowlens.streaming.sinks import running_batch, start_batches, write_batch


def counts_per_window(
    stream: DataFrame,
    time: str = "timestamp",
    seconds: int = 60,
    delay: str = "1 minute",
    by: str = "predicted_label",
) -> DataFrame:
    """Rows per tumbling window and label; a window is final once the watermark has passed it.

    Empty windows do not appear; a reader adds them with ``per_bucket``'s rule.
    """
    window = F.window(time, f"{seconds} seconds")
    counts = stream.withWatermark(time, delay).groupBy(window, by).agg(F.count("*").alias("count"))
    return counts.select(F.col("window.start").alias("start"), by, "count")


def alerts_per_window(
    stream: DataFrame,
    time: str = "timestamp",
    seconds: int = 60,
    slide: int = 10,
    delay: str = "1 minute",
    min_rows: int = 10,
    threshold: float = 0.20,
) -> DataFrame:
    """Sliding windows whose malicious rate fires the alert rule."""
    window = F.window(time, f"{seconds} seconds", f"{slide} seconds")
    counts = stream.withWatermark(time, delay).groupBy(window).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("predicted_label") == MALICIOUS).alias("malicious"),
    )
    fired = with_alert(counts, min_rows, threshold).where("alert")
    return fired.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"),
        "total", "malicious", "rate",
    )


COUNTS = "start timestamp, value string, count long"


def start_counts(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    time: str = "timestamp",
    seconds: int = 60,
    by: str = "predicted_label",
    every: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch's rows per bucket and value into its own folder below ``path``.

    A batch that is run again replaces its folder. ``compact_counts`` merges the files of a day.
    """

    def store(rows: DataFrame, batch_id: int) -> None:
        bucket = F.timestamp_seconds(F.floor(F.unix_seconds(F.col(time)) / seconds) * seconds)
        counts = rows.groupBy(bucket.alias("start"), F.col(by).alias("value")).agg(
            F.count("*").alias("count")
        )
        dated = counts.withColumn("event_day", F.to_date("start"))
        write_batch(dated, path, running_batch(rows, batch_id))

    return start_batches(stream, store, checkpoint, every)


def read_counts(
    spark: SparkSession, path: str, by: str = "predicted_label", archive: str | None = None
) -> DataFrame:
    """Rows per bucket and value over all micro-batches; a bucket without a time is left out."""
    parts = read_once(spark, path, COUNTS, archive).where("start is not null")
    return parts.groupBy("start", F.col("value").alias(by)).agg(F.sum("count").alias("count"))


def compact_counts(spark: SparkSession, path: str, archive: str, day: str, ended: bool = False) -> None:
    """Add up a closed day's counts of all batches into one row for each bucket and value."""

    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy("start", "value").agg(F.sum("count").alias("count"))

    compact_day(spark, path, archive, day, COUNTS, fold, ended)


def read_alerts(
    spark: SparkSession,
    path: str,
    seconds: int = 60,
    slide: int = 10,
    min_rows: int = 10,
    threshold: float = 0.20,
    archive: str | None = None,
) -> DataFrame:
    """Sliding windows whose malicious rate fires the alert rule, from counts per slide.

    ``slide`` is the bucket that the counts were written with, and divides ``seconds``.
    """
    counts = read_counts(spark, path, archive=archive)
    first = F.unix_seconds("start") - seconds + slide
    starts = F.explode(F.sequence(first, F.unix_seconds("start"), F.lit(slide)))
    windows = counts.select(starts.alias("at"), "predicted_label", "count").groupBy("at").agg(
        F.sum("count").alias("total"),
        F.coalesce(
            F.sum(F.when(F.col("predicted_label") == MALICIOUS, F.col("count"))), F.lit(0)
        ).alias("malicious"),
    )
    fired = with_alert(windows, min_rows, threshold).where("alert")
    return fired.select(
        F.timestamp_seconds("at").alias("start"),
        F.timestamp_seconds(F.col("at") + seconds).alias("end"),
        "total", "malicious", "rate",
    )
