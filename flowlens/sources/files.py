"""Flow records at rest: delimited files and the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.values import to_double
from flowlens.operators.cleaning import rename_fields
from flowlens.schema import RAW_SCHEMA, TABLE_NAMES


def read_delimited(spark: SparkSession, path: str, separator: str = "|") -> DataFrame:
    """Raw records from delimited text with a header line, as parsed flows.

    The schema is fixed, so nothing is inferred; a header with other names is an error.
    """
    raw = (
        spark.read.schema(RAW_SCHEMA)
        .option("sep", separator)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )
    numbers = {c: to_double(c) for c in ("ts", "orig_p", "resp_p")}
    return rename_fields(raw).withColumns(numbers)


def write_delimited(flows: DataFrame, path: str, separator: str = "|") -> None:
    """Parsed flows as delimited text in the raw layout; columns they lack are written as ``-``."""
    columns = []
    for name in RAW_SCHEMA.names:
        have = TABLE_NAMES.get(name, name)
        value = F.col(have).cast("string") if have in flows.columns else F.lit("-")
        columns.append(value.alias(name))
    flows.select(*columns).write.option("sep", separator).option("header", True).csv(path)


def flows_from_events(events: DataFrame) -> DataFrame:
    """Parsed flows derived from the event table, one per event."""
    # The number in the JSON text is taken out once; port and label both use it.
    events = events.withColumn("k", F.get_json_object("props", "$.k"))
    k = F.col("k")
    id_, user = F.col("event_id"), F.col("user_id")
    kind = F.col("event_type")

    def text_unless(step: int, value):
        return F.when(id_ % step == 0, "-").otherwise(value.cast("string"))

    hundredths = F.round(F.col("value") * 100).cast("long")
    bad = (kind == "error") | (k.cast("int") >= 90)
    return events.select(
        id_.alias("uid"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts"),
        F.concat(F.lit("10.0.0."), user.cast("string")).alias("orig_h"),
        (20000 + id_ % 30000).cast("double").alias("orig_p"),
        F.concat(F.lit("10.1.0."), (id_ % 16).cast("string")).alias("resp_h"),
        k.cast("double").alias("resp_p"),
        F.when(kind.isin("click", "view"), "udp")
        .when(kind == "purchase", "icmp")
        .otherwise("tcp")
        .alias("proto"),
        text_unless(7, hundredths).alias("duration"),
        text_unless(7, (user * id_) % 1000).alias("orig_bytes"),
        text_unless(5, id_ % 4096).alias("resp_bytes"),
        F.when(kind == "error", "S0")
        .when(kind == "signup", "REJ")
        .otherwise("SF")
        .alias("conn_state"),
        F.when(id_ % 101 == 0, None)
        .when(bad, "Malicious")
        .otherwise("Benign")
        .alias("label"),
        kind.alias("detailed_label"),
    )


def read_event_flows(spark: SparkSession, folder: str) -> DataFrame:
    return flows_from_events(spark.read.parquet(f"{folder}/events.parquet"))
