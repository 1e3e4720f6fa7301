from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowlens.operators import cleaning as C
from flowlens.operators import signatures as S
from flowlens.operators.joins import lookup_join


def counted(spark, *groups):
    """Flows with given numbers of rows per (port, protocol, label)."""
    df = spark.createDataFrame(list(groups), "resp_port int, proto string, label string, n int")
    return df.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).select(
        F.concat_ws("-", "resp_port", "label", "i").alias("uid"),
        F.col("i").cast("double").alias("ts"), "resp_port", "proto", "label",
    )


def test_recorded_counts_give_recorded_ratios_and_rules(spark):
    # Recorded counts, ratios and rule texts.
    flows = counted(
        spark,
        (59353, "tcp", "Malicious", 23295),
        (22, "tcp", "Malicious", 128264),
        (22, "tcp", "Benign", 2591),
        (2407, "tcp", "Malicious", 8),
        (80, "tcp", "Benign", 10),
    )
    signatures = S.port_signatures(flows)
    assert signatures.collect() == [
        (59353, "tcp", 23295, 0, 23295.0),
        (22, "tcp", 128264, 2591, 49.48456790123457),
        (2407, "tcp", 8, 0, 8.0),
    ]
    assert [r.rule for r in S.rule_texts(signatures).collect()] == [
        "IF dest_port == 59353 AND proto == 'tcp' THEN POTENTIAL MALWARE (Risk Ratio: 23295.00)",
        "IF dest_port == 22 AND proto == 'tcp' THEN POTENTIAL MALWARE (Risk Ratio: 49.48)",
        "IF dest_port == 2407 AND proto == 'tcp' THEN POTENTIAL MALWARE (Risk Ratio: 8.00)",
    ]


def test_join_form_agrees_except_for_null_keys(make_flows):
    flows = C.clean(
        make_flows(
            {"label": "Malicious"}, {"label": "Benign"}, {"label": None},
            {"label": "Malicious", "proto": None}, {"label": "Benign", "proto": None},
            {"label": "Malicious", "resp_p": None}, {"label": "Benign", "resp_p": None},
        )
    )
    one = {(r.resp_port, r.proto): r.benign_count for r in S.port_signatures(flows).collect()}
    two = {(r.resp_port, r.proto): r.benign_count for r in S.port_signatures_joined(flows).collect()}
    assert one == {(22, "tcp"): 1, (22, None): 1, (None, "tcp"): 1}
    assert two == {(22, "tcp"): 1, (22, None): 0, (None, "tcp"): 0}


@pytest.mark.parametrize("value", [0.125, 0.375, 2.675, 1234567.005, 0.005, 8.0, 1e9 + 0.5, 1 / 3])
def test_two_decimals_as_python_prints_them(spark, value):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(S.two_decimals(F.col("x"))).first()[0] == f"{value:.2f}"


def test_rule_of_a_missing_key(spark):
    df = spark.createDataFrame([(None, None, 2.0)], "resp_port int, proto string, risk_ratio double")
    assert S.rule_texts(df).first().rule == (
        "IF dest_port == None AND proto == 'None' THEN POTENTIAL MALWARE (Risk Ratio: 2.00)"
    )


def test_flags_are_the_same_broadcast_or_salted(spark):
    flows = counted(
        spark, (22, "tcp", "Malicious", 900), (22, "tcp", "Benign", 100),
        (53, "udp", "Malicious", 3), (80, None, "Malicious", 5), (81, "tcp", "Benign", 7),
    )
    signatures = S.port_signatures(flows)
    small = S.apply_signatures(flows, signatures, threshold=3.0)
    large = S.apply_signatures(flows, signatures, threshold=3.0, broadcast_bytes=0, salts=5)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
    rows = sorted(small.select("uid", "flagged", "risk_ratio").collect(), key=str)
    assert rows == sorted(large.select("uid", "flagged", "risk_ratio").collect(), key=str)
    assert len(rows) == 1015
    flagged = {r.uid.rsplit("-", 2)[0] for r in rows if r.flagged}
    assert flagged == {"22", "53"}


def test_salted_join_spreads_a_hot_key(spark):
    flows = counted(spark, (22, "tcp", "Malicious", 4000))
    lookup = spark.createDataFrame([(22, "tcp", 1.0)], "resp_port int, proto string, ratio double")
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in off}
    try:
        for key, value in off.items():
            spark.conf.set(key, value)
        salted = lookup_join(flows, lookup, S.KEYS, ["uid"], broadcast_bytes=0, salts=16)
        per_task = salted.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(r["count"] for r in per_task) == 4000
    assert len(per_task) > 2
    assert max(r["count"] for r in per_task) < 2500


def test_one_pass_scans_once(spark, tmp_path):
    path = str(tmp_path / "flows")
    counted(spark, (22, "tcp", "Malicious", 3)).write.parquet(path)
    plan = S.port_signatures(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<resp_port:int,proto:string,label:string>" in plan
