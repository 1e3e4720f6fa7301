from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from flowlens.operators import arrivals, dedup, quantiles, ranges

FRACTIONS = (0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.9, 1.0)


def measured(spark, n=4000, seed=2):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        group = r.choice(["hot"] * 6 + ["a", None, "none"])
        x = None if group == "none" or r.random() < 0.1 else r.choice([7.0, 7.0, r.random() * 100, -r.random()])
        rows.append((group, x, r.randrange(5) if r.random() < 0.9 else None))
    return spark.createDataFrame(rows, "g string, x double, k long").repartition(6)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_quantiles_by_rank_equal_percentile(spark, coalesce):
    df = measured(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        found = quantiles.exact_quantiles(df, ["x", "k"], FRACTIONS, by=["g"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = {(r.column, r.g, r.fraction): r.value for r in found}
    array = F.array(*map(F.lit, FRACTIONS))
    want = {}
    for c in ("x", "k"):
        for r in df.groupBy("g").agg(F.percentile(c, array).alias("q")).collect():
            want |= {(c, r.g, f): v for f, v in zip(FRACTIONS, r.q or ())}
    assert got == want and len(got) == 2 * 3 * len(FRACTIONS) + len(FRACTIONS)


def test_quantiles_of_odd_values(spark):
    df = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (0.0,), (-0.0,), (None,)], "x double")
    found = {r.fraction: r.value for r in quantiles.exact_quantiles(df, ["x"], (0.0, 0.25, 0.5, 0.75)).collect()}
    assert found == {0.0: -math.inf, 0.25: 0.0, 0.5: 0.0, 0.75: math.inf}
    assert quantiles.exact_quantiles(df.limit(0), ["x"]).count() == 0
    assert quantiles.exact_quantiles(df.where("x is null"), ["x"]).count() == 0


def test_windows_run_inside_ranges(spark):
    """Values are summed up by range; only the totals of ranges are summed up by group."""
    df = measured(spark, 300)
    plan = quantiles.exact_quantiles(df, ["x"])._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window " in line:
            assert "sum(rows" in line or "part#" in line


def test_merged_sketches_are_near(spark):
    """The rank of each quantile, over the merged parts, is off by no more than the stated share."""
    r = random.Random(4)
    rows = [(["hot", "cold"][r.random() < 0.1], r.gauss(0, 1) ** 3, r.randrange(5)) for _ in range(30_000)]
    df = spark.createDataFrame(rows, "g string, x double, part int").repartition(5)
    parts = [quantiles.sketches(df.where(F.col("part") == k), ["x"], ["g"]) for k in range(5)]
    stored = parts[0]
    for p in parts[1:]:
        stored = stored.unionByName(p)
    merged = quantiles.merge_sketches(stored, ["g"])
    found = quantiles.sketch_quantiles(merged, FRACTIONS).collect()
    assert len(found) == 2 * len(FRACTIONS)
    for row in found:
        own = sorted(x for g, x, _ in rows if g == row.g)
        assert row.n == len(own)
        below, through = sum(x < row.value for x in own), sum(x <= row.value for x in own)
        assert below / len(own) - 0.025 <= row.fraction <= through / len(own) + 0.025


def test_gaps_across_slices(spark):
    r = random.Random(6)
    rows = [("hot", r.choice([0.0, 5.0, r.random() * 50_000]), k) for k in range(2000)]
    rows += [(s, r.random() * 90_000, 5000 + k) for k, s in enumerate(["a", "b", "c"] * 20)]
    rows += [(None, 5.0, 9000), (None, 6.0, 9001), ("a", None, 9002), ("one", 3.0, 9003)]
    df = spark.createDataFrame(rows, "orig_h string, ts double, uid long").repartition(7)
    for seconds in (3600, 1, 1e9):
        found = {x.uid: x.gap for x in arrivals.with_gap(df, slice_seconds=seconds).collect()}
        want, last = {}, {}
        for s, t, u in sorted((x for x in rows if x[0] and x[1] is not None), key=lambda x: (x[0], x[1], x[2])):
            want[u] = t - last[s] if s in last else None
            last[s] = t
        want |= {9000: None, 9001: None, 9002: None}
        assert found == want


def test_gaps_move_flows_once(spark):
    df = spark.createDataFrame([("a", 1.0, 1)], "orig_h string, ts double, uid long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = arrivals.with_gap(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning(orig_h" in x and "slice_" in x]
    assert len(moved) <= 3  # flows, slice ends, and the ends with those before them


def port_rows(make_flows, ports):
    return [
        {"resp_p": None if p is None else float(p), "label": label, "proto": proto}
        for p, label, proto in ports
    ]


def test_port_ranges(spark, make_flows):
    from flowlens.operators.cleaning import clean

    bad, good = "Malicious", "Benign"
    rows = [(p, bad, "tcp") for p in (20, 21, 22, 22, 25, 80, 65535)] + [
        (23, good, "tcp"), (21, good, "tcp"), (None, bad, "tcp"), (21, bad, "udp"), (22, None, "udp"),
        (30, bad, None), (31, bad, None), (24, good, "tcp"),
    ]
    flows = clean(make_flows(*port_rows(make_flows, rows)))
    found = [
        (r.proto, r.first_port, r.last_port, r.ports, r.malicious_count, r.benign_count)
        for r in ranges.port_ranges(flows).collect()
    ]
    assert found == [
        ("tcp", 20, 22, 3, 4, 1), (None, 30, 31, 2, 2, 0), ("tcp", 25, 25, 1, 1, 0),
        ("tcp", 80, 80, 1, 1, 0), ("tcp", 65535, 65535, 1, 1, 0), ("udp", 21, 21, 1, 1, 0),
    ]
    wide = {(r.proto, r.first_port, r.last_port) for r in ranges.port_ranges(flows, gap=3).collect()}
    assert ("tcp", 20, 25) in wide
    strict = ranges.port_ranges(flows, min_malicious=2).collect()
    assert [(r.first_port, r.last_port) for r in strict] == [(22, 22)]
    assert ranges.port_ranges(flows.limit(0)).count() == 0


def test_windows_over_ports_run_on_counts(make_flows):
    from flowlens.operators.cleaning import clean

    plan = ranges.port_ranges(clean(make_flows({})))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    windows = [i for i, x in enumerate(lines) if "Window " in x]
    assert windows and max(windows) < max(i for i, x in enumerate(lines) if "Aggregate [" in x)


def test_newest_of_each_record(spark):
    rows = [
        ("a", 1.0, "x"), ("a", 3.0, "y"), ("a", None, "z"), ("b", None, "p"), ("b", None, "q"),
        (None, 1.0, "s"), (None, 1.0, "s"), (None, 1.0, "t"), ("", 1.0, "s"), ("-", 2.0, "u"),
    ]
    df = spark.createDataFrame(rows, "uid string, ts double, text string").repartition(3)
    found = sorted((r.uid or "", r.ts or 0.0, r.text) for r in dedup.newest_per_key(df).collect())
    assert found == [
        ("", 1.0, "s"), ("", 1.0, "s"), ("", 1.0, "t"), ("-", 2.0, "u"), ("a", 3.0, "y"), ("b", 0.0, "q"),
    ]
    assert dedup.newest_per_key(df.limit(0)).count() == 0
