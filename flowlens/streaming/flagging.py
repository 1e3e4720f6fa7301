"""Flows flagged by port signatures that change while the query runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators.joins import BROADCAST_BYTES, SALTS, content_bytes, keyed_join
from flowlens.operators.signatures import KEYS
from flowlens.session import table_or_empty
from flowlens.streaming.sinks import running_batch, start_batches, write_batch

RULES = "resp_port int, proto string, risk_ratio double"


def publish_rules(signatures: DataFrame, path: str, threshold: float) -> int:
    """Make the signatures from ``threshold`` on the newest version of the rules; its number.

    A version is one file, so it is seen as a whole or not at all; it has at most one row for each
    port and protocol.
    """
    spark = signatures.sparkSession
    version = newest_version(spark, path) + 1
    rules = signatures.where(F.col("risk_ratio") >= threshold).select(*KEYS, "risk_ratio")
    numbered = rules.withColumn("version", F.lit(version).cast("long"))
    # A version without rules is a version too.
    mark = spark.createDataFrame([(None, None, None, version)], f"{RULES}, version long")
    numbered.unionByName(mark).coalesce(1).write.mode("append").parquet(path)
    return version


def _versions(spark: SparkSession, path: str) -> DataFrame:
    return table_or_empty(spark, path, f"{RULES}, version long")


def newest_version(spark: SparkSession, path: str) -> int:
    """0 where there are no rules yet."""
    return _versions(spark, path).agg(F.max("version")).first()[0] or 0


def start_flagging(
    stream: DataFrame,
    rules: str,
    output: str,
    checkpoint: str,
    every: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> StreamingQuery:
    """Flag each micro-batch by the newest rules at ``rules``; rows keep the version they met.

    The rules' size is measured once a version. Up to ``broadcast_bytes`` they are broadcast; beyond
    that both sides are shuffled with hot keys spread. A batch that is run again may meet newer
    rules, and replaces what it wrote.
    """
    sizes: dict[int, int] = {}

    def store(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        version = newest_version(spark, rules)
        known = _versions(spark, rules).where(F.col("version") == version)
        known = known.where("risk_ratio is not null").drop("version")
        if version not in sizes:
            sizes.clear()
            sizes[version] = content_bytes(known)
        small = sizes[version] <= broadcast_bytes
        flagged = keyed_join(rows, known, KEYS, ["uid", "ts"], small, salts).withColumns(
            {"flagged": F.col("risk_ratio").isNotNull(), "rule_version": F.lit(version).cast("long")}
        )
        write_batch(flagged, output, running_batch(rows, batch_id))

    return start_batches(stream, store, checkpoint, every)
