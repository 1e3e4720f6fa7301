"""Split of flows into training and test rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 100


def split_bucket(key: Column | str = "uid") -> Column:
    """A number from 0 to 99 that depends on the key alone.

    It does not change with partitioning or row order, and any system with MD5 can repeat it.
    """
    key = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(BUCKETS))


def flow_key(df: DataFrame) -> Column:
    """The record's id, or its time and end points where it has none."""
    parts = ["ts", "orig_h", "orig_p", "resp_h", "resp_p"]
    ends = F.concat_ws("|", *[F.col(p).cast("string") for p in parts])
    return F.coalesce(F.col("uid").cast("string"), ends) if "uid" in df.columns else ends


def train_test_split(df: DataFrame, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    bucket = split_bucket(flow_key(df))
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def random_split(
    df: DataFrame, train_share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split; it depends on how the input is partitioned."""
    train, test = df.randomSplit([train_share, 1 - train_share], seed=seed)
    return train, test
