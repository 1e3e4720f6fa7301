"""Counts and per-label statistics of flows.

Each is one partial and one final hash aggregate, so a hot value costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.values import is_malicious
from flowlens.operators.quantiles import exact_quantiles
from flowlens.session import written


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("count"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Count per key, most frequent first, ties by key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), *[F.asc_nulls_first(k) for k in keys])


def count_by_key_order(df: DataFrame, *keys: str) -> DataFrame:
    """Count per key, ordered by the keys."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("count"))
    return counts.orderBy(*[F.asc_nulls_first(k) for k in keys])


def label_statistics(df: DataFrame) -> DataFrame:
    """Mean and sample deviation of duration, mean bytes, per label, after the zero fill."""
    return df.groupBy("label").agg(
        F.avg("duration").alias("avg_duration"),
        F.stddev_samp("duration").alias("std_duration"),
        F.avg("orig_bytes").alias("avg_orig_bytes"),
        F.avg("resp_bytes").alias("avg_resp_bytes"),
    )


def top_malicious_ports(df: DataFrame, k: int = 10) -> DataFrame:
    """The k (port, protocol) pairs with the most malicious flows."""
    return count_by(df.where(is_malicious()), "resp_port", "proto").limit(k)


def category_counts(df: DataFrame) -> DataFrame:
    """All exploratory counts from one scan and one shuffle.

    One row per value of label, detailed label, protocol, state, and (protocol, label);
    ``dimension`` tells which. Fit for tables too large to cache between separate counts.
    """
    keys = ["label", "detailed_label", "proto", "conn_state"]
    # The finest grouping is small (few values per key); the coarser ones are built from it.
    finest = df.groupBy(*keys).agg(F.count("*").alias("n"))
    label, detailed, proto, state = (F.col(k) for k in keys)
    nothing = F.lit(None).cast("string")
    dimensions = [
        ("label", label, nothing),
        ("detailed_label", detailed, nothing),
        ("proto", proto, nothing),
        ("conn_state", state, nothing),
        ("proto_label", proto, label),
    ]
    pieces = F.array(
        *[
            F.struct(F.lit(name).alias("dimension"), first.alias("value"), second.alias("label"))
            for name, first, second in dimensions
        ]
    )
    return (
        finest.select(F.explode(pieces).alias("d"), "n")
        .groupBy("d.dimension", "d.value", "d.label")
        .agg(F.sum("n").alias("count"))
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count per value of each text column, from one scan: ``column``, ``value``, ``count``.

    Rows are taken apart by column first, so that what is shuffled is a count for each value and
    task, however many combinations of values there are.
    """
    parts = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    )
    taken = df.select(F.explode(parts).alias("p"))
    return taken.groupBy("p.column", "p.value").agg(F.count("*").alias("count"))


def distinct_pairs(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


STATISTICS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum, one row each.

    The quartiles come from ranks over counted values, so no task holds a column's values. The
    columns are written once for the passes that this takes.
    """
    df = written(df.select(*columns), "described")
    moments = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(s).alias("statistic"), value.alias("value"))
            for c in columns
            for x in [F.col(c).cast("double")]
            for s, value in [
                ("count", F.count(x).cast("double")), ("mean", F.avg(x)),
                ("std", F.stddev_samp(x)), ("min", F.min(x)), ("max", F.max(x)),
            ]
        ]
    )
    rows = df.agg(moments.alias("rows")).select(F.inline("rows"))
    names = {0.25: "25%", 0.5: "50%", 0.75: "75%"}
    quartiles = exact_quantiles(df, columns, tuple(names))
    name = F.coalesce(*[F.when(F.col("fraction") == f, s) for f, s in names.items()])
    rows = rows.unionByName(quartiles.select("column", name.alias("statistic"), "value"))
    # An empty table has no quartiles, but a row for each.
    place = F.array_position(F.array(*map(F.lit, STATISTICS)), F.col("statistic"))
    nothing = F.array(*[F.struct(F.lit(None).cast("string").alias("column"), F.lit(s).alias("statistic"), F.lit(None).cast("double").alias("value")) for s in STATISTICS])
    rows = rows.unionByName(df.sparkSession.range(1).select(F.inline(nothing)))
    wide = rows.groupBy("statistic").agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns]
    )
    return wide.orderBy(place)
