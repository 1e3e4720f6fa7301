"""Stored predictions: reading the newest, and normalising their time and label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.functions.values import label_of

# Time fields in the order in which they are looked for.
SORT_FIELDS = ["processing_time", "timestamp", "original_ts"]
TIME_FIELDS = ["processing_time", "original_ts", "timestamp"]

REPORT_ROWS = 20_000
DASHBOARD_ROWS = 8_000


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def newest(df: DataFrame, n: int | None = None, seconds: int = 60) -> DataFrame:
    """The n newest predictions by the first time field present; any n without such a field.

    Ties go by ``uid``; predictions without a time come last. Without n, all. Runs a job that
    counts predictions per time bucket; the filter that follows from it reaches the scan, and only
    the rows of the newest buckets are sorted.
    """
    if n is None:
        return df
    field = next((f for f in SORT_FIELDS if f in df.columns), None)
    if field is None:
        return df.limit(n)
    order = [F.desc(field), *([F.asc("uid")] if "uid" in df.columns else [])]
    if df.schema[field].dataType.typeName() == "timestamp":
        start = _start_of_newest(df, F.unix_seconds(F.col(field)), n, seconds)
        begin = F.timestamp_seconds(F.lit(start))
    elif df.schema[field].dataType.typeName() in ("double", "float", "long", "integer"):
        start = _start_of_newest(df, F.col(field), n, seconds)
        begin = F.lit(start).cast("double")
    else:
        start = None
    if start is not None:
        df = df.where(F.col(field) >= begin)
    return df.orderBy(*order).limit(n)


def _start_of_newest(df: DataFrame, time: Column, n: int, seconds: int) -> int | None:
    """Epoch second from which on there are n rows; None if there are fewer.

    From one scan of the time column. At most the newest n buckets matter, as each holds a row.
    """
    bucket = F.floor(time / seconds)
    counts = (
        df.select(bucket.alias("bucket"))
        .where(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.count("*").alias("rows"))
        .orderBy(F.desc("bucket"))
        .limit(n)
    )
    newer = F.sum("rows").over(Window.orderBy(F.desc("bucket")))
    enough = counts.withColumn("newer", newer).where(F.col("newer") >= n)
    return enough.agg((F.max("bucket") * seconds).alias("start")).first()["start"]


def _as_time(df: DataFrame, field: str) -> Column:
    value = F.col(field)
    if field == "original_ts":
        micros = (value.try_cast("double") * 1e6).try_cast("long")
        return F.timestamp_micros(micros)
    return value.try_cast("timestamp")


def normalise_time(df: DataFrame) -> DataFrame:
    """Give ``processing_time`` as a timestamp, from the first time field present.

    ``original_ts`` holds epoch seconds. A value that is no time gives NULL.
    """
    field = next((f for f in TIME_FIELDS if f in df.columns), None)
    if field is None:
        return df
    return df.withColumn("processing_time", _as_time(df, field))


def with_predicted_label(df: DataFrame, labels: list[str]) -> DataFrame:
    """Derive a missing ``predicted_label`` from the numeric prediction and the model's labels."""
    if "predicted_label" in df.columns or "prediction" not in df.columns:
        return df
    return df.withColumn("predicted_label", label_of("prediction", labels))
