"""Port signatures: how much more often a port is hit by malicious than by benign flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.values import is_malicious
from flowlens.operators.cleaning import malicious, not_malicious
from flowlens.operators.joins import BROADCAST_BYTES, SALTS, lookup_join

KEYS = ["resp_port", "proto"]


def _with_ratio(counts: DataFrame) -> DataFrame:
    ratio = F.col("malicious_count") / (F.col("benign_count") + 1)
    return counts.withColumn("risk_ratio", ratio)


def _ranked(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("risk_ratio"), *[F.asc_nulls_first(k) for k in KEYS])


def port_signatures(flows: DataFrame) -> DataFrame:
    """Counts and risk ratio per (port, protocol) seen in malicious flows, riskiest first.

    One scan and one shuffle. Rows of a NULL port or protocol form a group of their own.
    """
    bad = is_malicious()
    counts = flows.groupBy(*KEYS).agg(
        F.count_if(bad).alias("malicious_count"), F.count_if(~bad).alias("benign_count")
    )
    return _ranked(_with_ratio(counts.where(F.col("malicious_count") > 0)))


def port_signatures_joined(flows: DataFrame) -> DataFrame:
    """The same from two aggregates and a left outer join.

    A NULL port or protocol never matches, so its benign count stays 0.
    """
    bad = malicious(flows).groupBy(*KEYS).agg(F.count("*").alias("malicious_count"))
    good = not_malicious(flows).groupBy(*KEYS).agg(F.count("*").alias("benign_count"))
    joined = bad.join(good, on=KEYS, how="left_outer").fillna(0, subset=["benign_count"])
    return _ranked(_with_ratio(joined))


def two_decimals(value: Column) -> Column:
    """Two decimals, halves to the even digit of the exact binary value, no group separators."""
    return F.call_function("format_number", value, F.lit("0.00"))


def rule_texts(signatures: DataFrame, k: int = 5) -> DataFrame:
    """Readable rules for the k riskiest signatures."""
    missing = F.lit("None")
    # The rule's text.
    rule = F.concat(
        F.lit("IF dest_port == "),
        F.coalesce(F.col("resp_port").cast("string"), missing),
        F.lit(" AND proto == '"),
        F.coalesce(F.col("proto"), missing),
        F.lit("' THEN POTENTIAL MALWARE (Risk Ratio: "),
        two_decimals(F.col("risk_ratio")),
        F.lit(")"),
    )
    return _ranked(signatures).limit(k).select(rule.alias("rule"), "risk_ratio", *KEYS)


def apply_signatures(
    flows: DataFrame,
    signatures: DataFrame,
    threshold: float,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Flag flows whose (port, protocol) has a risk ratio of at least ``threshold``."""
    rules = signatures.where(F.col("risk_ratio") >= threshold).select(*KEYS, "risk_ratio")
    matched = lookup_join(
        flows, rules, KEYS, spread=["uid", "ts"], broadcast_bytes=broadcast_bytes, salts=salts
    )
    return matched.withColumn("flagged", F.col("risk_ratio").isNotNull())
