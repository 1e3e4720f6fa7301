"""Counts per time bucket and the alert on recent predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.schema import MALICIOUS

DAY_SECONDS = 86400


def per_bucket(df: DataFrame, time: str = "processing_time", seconds: int = 60) -> DataFrame:
    """Rows per time bucket, with 0 for every empty bucket between the first and the last.

    The rows are counted in one scan and one shuffle; first and last bucket come from those
    counts, and both uses read the same shuffle. Buckets are laid out day by day on several
    tasks, so one wild timestamp does not build a huge array in one of them.
    """
    bucket = F.floor(F.unix_seconds(F.col(time)) / seconds)
    counts = (
        df.select(bucket.alias("bucket"))
        .where(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.count("*").alias("rows"))
    )
    # The total takes part so that both uses of the counts need the same columns.
    ends = counts.agg(
        F.min("bucket").alias("first"), F.max("bucket").alias("last"), F.sum("rows").alias("total")
    ).where(F.col("total") > 0)
    width = max(DAY_SECONDS // seconds, 1)
    days = F.sequence(F.floor(F.col("first") / width), F.floor(F.col("last") / width))
    start = F.col("day") * width
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = (
        ends.select(F.explode(days).alias("day"), "first", "last")
        .repartition(tasks, "day")
        .select(F.explode(F.sequence(start, start + (width - 1))).alias("bucket"), "first", "last")
        .where(F.col("bucket").between(F.col("first"), F.col("last")))
    )
    return buckets.join(counts, on="bucket", how="left").select(
        F.timestamp_seconds(F.col("bucket") * seconds).alias(time),
        F.coalesce(F.col("rows"), F.lit(0)).alias("count"),
    )


def recent(df: DataFrame, time: str = "processing_time", seconds: int = 60) -> DataFrame:
    """Rows at most ``seconds`` older than the newest one, that limit included.

    The newest time is a scalar subquery, whose value also reaches the Parquet scan as a filter.
    """
    oldest = df.agg(F.max(time) - F.make_dt_interval(secs=F.lit(seconds))).scalar()
    return df.where(F.col(time) >= oldest)


def _predicted_malicious() -> Column:
    return F.col("predicted_label") == MALICIOUS


def alert(
    df: DataFrame,
    time: str = "processing_time",
    seconds: int = 60,
    min_rows: int = 10,
    threshold: float = 0.20,
) -> DataFrame:
    """One row for the newest window: counts, malicious rate, and whether to alert.

    An alert needs at least ``min_rows`` rows and a rate strictly above ``threshold``.
    """
    counts = recent(df, time, seconds).agg(
        F.count("*").alias("total"), F.count_if(_predicted_malicious()).alias("malicious")
    )
    return with_alert(counts, min_rows, threshold)


def with_alert(counts: DataFrame, min_rows: int, threshold: float) -> DataFrame:
    """Add rate and decision to counts named ``total`` and ``malicious``."""
    rate = F.coalesce(F.try_divide(F.col("malicious"), F.col("total")), F.lit(0.0))
    fires = (F.col("total") >= min_rows) & (F.col("rate") > threshold)
    return counts.withColumn("rate", rate).withColumn("alert", fires)


def alert_rows(
    df: DataFrame, time: str = "processing_time", seconds: int = 60, k: int = 20
) -> DataFrame:
    """The first k malicious rows of the newest window, oldest first."""
    rows = recent(df, time, seconds).where(_predicted_malicious())
    return rows.orderBy(time, "uid").limit(k)
