"""Ranges of ports that malicious traffic hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.values import is_malicious


def port_counts(flows: DataFrame) -> DataFrame:
    """Malicious and benign flows per (protocol, port); one scan, one shuffle of partial counts."""
    bad = is_malicious()
    return flows.where(F.col("resp_port").isNotNull()).groupBy("proto", "resp_port").agg(
        F.count_if(bad).alias("malicious_count"), F.count_if(~bad).alias("benign_count")
    )


def port_ranges(
    flows: DataFrame, gap: int = 1, min_malicious: int = 1, min_ratio: float = 0.0
) -> DataFrame:
    """Ports that malicious flows hit, joined into ranges by protocol, most hit first.

    A port takes part with at least ``min_malicious`` such flows and a risk ratio, malicious over
    benign plus one, of at least ``min_ratio``. Ports at most ``gap`` apart lie in one range; ports
    inside a range that take no part count neither as ports nor with their flows. A NULL protocol
    has ranges of its own; flows without a port have none.

    Windows run over the counts per port of a protocol, never over flows.
    """
    risky = port_counts(flows).where(
        (F.col("malicious_count") >= min_malicious)
        & (F.col("malicious_count") / (F.col("benign_count") + 1) >= min_ratio)
    )
    ports = Window.partitionBy("proto").orderBy("resp_port")
    before = F.lag("resp_port").over(ports)
    apart = F.col("resp_port").cast("long") - before > gap
    marked = risky.withColumn("starts", F.coalesce(apart, F.lit(True)).cast("int"))
    numbered = marked.withColumn("island", F.sum("starts").over(ports))
    ranges = numbered.groupBy("proto", "island").agg(
        F.min("resp_port").alias("first_port"), F.max("resp_port").alias("last_port"),
        F.count("*").alias("ports"),
        F.sum("malicious_count").alias("malicious_count"),
        F.sum("benign_count").alias("benign_count"),
    )
    ratio = F.col("malicious_count") / (F.col("benign_count") + 1)
    return ranges.drop("island").withColumn("risk_ratio", ratio).orderBy(
        F.desc("malicious_count"), F.asc_nulls_first("proto"), "first_port"
    )
