"""Headline queries, timed: prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the number of local threads.
``BENCH_COPIES`` (default 1) repeats the flows that many times in an extra offline scoring run.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from flowlens.catalog import queries as Q
from flowlens.catalog.queries import QUERIES
from flowlens.plans.offline import timed_scoring
from flowlens.session import build_session, fresh_path
from flowlens.sources.files import read_delimited, write_delimited
from flowlens.sources.topics import encode, stream_topic, write_topic
from flowlens.streaming.progress import ProgressLog
from flowlens.streaming.scorer import start_scoring

HEADLINE = [
    "par1_decode", "par2_quarantine", "src5_newest_for_dashboard", "fea5_bytes_per_sec",
    "agg1_to_5_in_one_scan", "agg6_label_statistics", "agg7_top_malicious_ports",
    "agg12_classification_report", "agg16_metric_summary", "joi1_signatures_by_join",
    "sig1_port_signatures", "sig2_rules", "sig3_flagged_flows", "tim1_per_minute",
    "alr1_alert", "alr2_alert_rows", "mlf3_one_hot", "mlf5_scaled", "mlm1_split",
    "mlm4_accuracy_and_f1", "sco2_scored_flows", "tim2_stream_per_minute",
]


def run_whole(df) -> None:
    """Compute every row and column without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    begin = time.perf_counter()
    action()
    return time.perf_counter() - begin


def train_seconds(spark, folder: str, kind: str) -> float:
    def again():
        Q.forget_trained()
        Q.trained(spark, folder, kind)

    return min(timed(again) for _ in range(2))


def stream_numbers(spark, folder: str) -> dict[str, float]:
    """Rows per second and batch times of a scoring stream over eight files, two per batch."""
    topic = fresh_path(spark, "topic")
    write_topic(encode(Q.flows(spark, folder)).repartition(8), path=topic)
    log = ProgressLog(spark, fresh_path(spark, "progress"))
    spark.streams.addListener(log)
    query = start_scoring(
        stream_topic(spark, path=topic, per_trigger=2),
        Q.trained(spark, folder).bundle,
        fresh_path(spark, "scored"),
        fresh_path(spark, "offsets"),
        available_now=True,
    )
    query.awaitTermination()
    log.wait(query)
    spark.streams.removeListener(log)
    row = log.table().where("inputRows > 0").agg(
        (F.sum("inputRows") / F.sum("procTimeMs") * 1000).alias("rows_per_sec"),
        F.percentile("procTimeMs", F.lit(0.5)).alias("batch_ms_p50"),
        F.percentile("procTimeMs", F.lit(0.95)).alias("batch_ms_p95"),
    ).first()
    return {k: round(v, 1) for k, v in row.asDict().items()}


def offline_numbers(spark, folder: str, copies: int) -> dict[str, float]:
    """Delimited text to counts per predicted class."""
    path = fresh_path(spark, "delimited")
    rows = Q.flows(spark, folder)
    if copies > 1:
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
        rows = rows.repartition(64)
    write_delimited(rows, path)
    counts, seconds = timed_scoring(read_delimited(spark, path), Q.trained(spark, folder).bundle)
    total = sum(r["count"] for r in counts)
    return {"rows": total, "seconds": round(seconds, 3), "rows_per_sec": round(total / seconds)}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__log__level="ERROR",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),  # one machine, so it is shared
    )
    run_whole(QUERIES["sig1_port_signatures"](spark, folder))  # start-up is not measured
    seconds = {
        "mlm3_boosted_trees_training": train_seconds(spark, folder, "boosted"),
        "mlm2_random_forest_training": train_seconds(spark, folder, "forest"),
    }
    for name in HEADLINE:
        runs = [timed(lambda: run_whole(QUERIES[name](spark, folder))) for _ in range(2)]
        seconds[name] = min(runs)
    stream = stream_numbers(spark, folder)
    offline = offline_numbers(spark, folder, int(os.environ.get("BENCH_COPIES", "1")))
    seconds["snk4_offline_scoring"] = offline["seconds"]
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "stream_scoring": stream,
                "offline_scoring": offline,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
