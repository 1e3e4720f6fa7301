"""The alert on the newest minute, decided anew after every micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators.timeline import recent, with_alert
from flowlens.schema import MALICIOUS
from flowlens.streaming.sinks import Batch, running_batch, start_batches

STATE = "at timestamp, total long, malicious long"
ALERTS = "batch_id long, newest timestamp, total long, malicious long, rate double, alert boolean"
#: States kept: that of the batch before, the one being written, and one more.
_SLOTS = 3


def start_alerts(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    time: str = "timestamp",
    seconds: int = 60,
    min_rows: int = 10,
    threshold: float = 0.20,
    every: str | None = None,
) -> StreamingQuery:
    """After each micro-batch, the decision that ``alert`` would make on all rows so far.

    The state is the number of rows for each time of the newest window: no older row can count
    again, since the newest time never falls. It is a small table for each batch, made from that of
    the batch before, so a batch that is run again starts from the same state and replaces what it
    wrote. Rows may come in any order; ones without a time do not count.
    """

    def slot(batch: Batch) -> str:
        return f"{path}/state/{batch.query_id}/{batch.batch_id % _SLOTS}"

    def store(rows: DataFrame, batch_id: int) -> None:
        spark, batch = rows.sparkSession, running_batch(rows, batch_id)
        bad = F.col("predicted_label") == MALICIOUS
        counts = rows.where(F.col(time).isNotNull()).groupBy(F.col(time).alias("at")).agg(
            F.count("*").alias("total"), F.count_if(bad).alias("malicious")
        )
        if batch_id:
            before = spark.read.schema(STATE).parquet(slot(Batch(batch.query_id, batch_id - 1)))
            counts = counts.unionByName(recent(before, "at", seconds)).groupBy("at").agg(
                F.sum("total").alias("total"), F.sum("malicious").alias("malicious")
            )
        counts.write.mode("overwrite").parquet(slot(batch))
        state = spark.read.schema(STATE).parquet(slot(batch))
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
        decision = with_alert(
            recent(state, "at", seconds).agg(
                F.lit(batch_id).cast("long").alias("batch_id"), F.max("at").alias("newest"),
                total("total"), total("malicious"),
            ),
            min_rows, threshold,
        )
        decision.write.mode("overwrite").parquet(f"{path}/alerts/write_key={batch.key}")

    return start_batches(stream, store, checkpoint, every)


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """The decision after each micro-batch."""
    return spark.read.schema(ALERTS).parquet(f"{path}/alerts")
