"""Operators against plain Python on random flows, with one hot key and many odd values."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from flowlens.operators import cleaning as C
from flowlens.operators import distributions as D
from flowlens.operators import signatures as S
from flowlens.operators import timeline as L
from flowlens.sources.predictions import newest

TEXTS = ["-", "0", "7", "12.7", "1e3", "", " 5", "x", None, "NaN", "9999999999999999999", "-3", '"NaN"']


def as_float(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def as_long(text):
    number = as_float(text)
    if number is None or math.isnan(number) or abs(number) >= 2**63:
        return None
    return int(text) if text.strip().lstrip("-").isdigit() else int(number)


def random_records(seed: int, n: int = 600):
    rng = random.Random(seed)
    for i in range(n):
        hot = rng.random() < 0.4
        yield {
            "uid": f"C{i:04d}",
            "ts": 1.5e9 + rng.random() * 7200 if rng.random() > 0.02 else None,
            "resp_p": 22.0 if hot else rng.choice([53.0, 80.0, 443.0, None, math.nan, 65535.0]),
            "proto": "tcp" if hot else rng.choice(["tcp", "udp", "icmp", None]),
            "duration": rng.choice(TEXTS),
            "orig_bytes": rng.choice(TEXTS),
            "resp_bytes": rng.choice(TEXTS),
            "label": rng.choice(["Malicious", "Benign", None, "Malicious DDoS"]),
        }


@pytest.fixture(scope="module", params=[1, 2])
def case(request, make_flows):
    records = list(random_records(request.param))
    return records, C.clean(make_flows(*records)).cache()


def port(record):
    value = record["resp_p"]
    return None if value is None or math.isnan(value) else int(value)


def test_cleaning(case):
    records, flows = case
    rows = {r.uid: r for r in flows.collect()}
    for record in records:
        row = rows[record["uid"]]
        duration = as_float(record["duration"])
        assert row.duration == (0.0 if duration is None or math.isnan(duration) else duration)
        assert row.orig_bytes == (as_long(record["orig_bytes"]) or 0)
        assert row.resp_bytes == (as_long(record["resp_bytes"]) or 0)
        assert row.resp_port == port(record)


def test_features(case):
    records, flows = case
    rows = {r.uid: r for r in C.add_features(flows).withColumn("sec", F.unix_seconds("timestamp")).collect()}
    for record in records:
        row = rows[record["uid"]]
        total = row.orig_bytes + row.resp_bytes
        assert row.total_bytes == total
        assert row.bytes_per_sec == total / (row.duration + 0.001)
        if record["ts"] is None:
            assert row.sec is None and row.hour_of_day is None
            continue
        moment = datetime.fromtimestamp(int(record["ts"]), timezone.utc)
        assert row.sec == int(record["ts"])
        assert row.hour_of_day == moment.hour
        assert row.day_of_week == moment.isoweekday() % 7 + 1


def test_counts(case):
    records, flows = case
    for key in ("label", "proto"):
        found = {r[key]: r["count"] for r in D.count_by(flows, key).collect()}
        assert found == Counter(r[key] for r in records)


@pytest.mark.parametrize("broadcast_bytes", [10**6, 0])
def test_signatures_and_flags(case, broadcast_bytes):
    records, flows = case
    bad = Counter((port(r), r["proto"]) for r in records if "Malicious" in (r["label"] or ""))
    good = Counter((port(r), r["proto"]) for r in records if r["label"] == "Benign")
    expected = {k: (n, good[k], n / (good[k] + 1)) for k, n in bad.items()}
    signatures = S.port_signatures(flows)
    assert {tuple(r)[:2]: tuple(r)[2:] for r in signatures.collect()} == expected
    ratios = [r.risk_ratio for r in signatures.collect()]
    assert ratios == sorted(ratios, reverse=True)
    flagged = S.apply_signatures(flows, signatures, 1.5, broadcast_bytes=broadcast_bytes, salts=7)
    rows = flagged.collect()
    assert len(rows) == len(records)
    for row in rows:
        key = (row.resp_port, row.proto)
        risky = None not in key and key in expected and expected[key][2] >= 1.5
        assert row.flagged == risky


def random_predictions(seed: int, n: int = 400):
    rng = random.Random(seed)
    start = datetime(2024, 2, 28, 23, 30)
    for i in range(n):
        burst = rng.random() < 0.35
        moment = start + timedelta(seconds=3000 if burst else rng.randrange(0, 5400))
        label = rng.choice(["Malicious", "Benign", None])
        yield f"u{i:03d}", None if rng.random() < 0.03 else str(moment), "Benign", label


@pytest.mark.parametrize("seed", [3, 4])
def test_timeline_alert_and_newest(make_predictions, seed):
    rows = list(random_predictions(seed))
    df = make_predictions(*rows).cache()
    timed = [(u, datetime.fromisoformat(t), p) for u, t, _, p in rows if t]
    for seconds in (60, 17):
        size = timedelta(seconds=seconds)
        origin = datetime(1970, 1, 1)
        number = Counter((t - origin) // size for _, t, _ in timed)
        expected = {origin + b * size: number[b] for b in range(min(number), max(number) + 1)}
        found = {r.processing_time: r["count"] for r in L.per_bucket(df, seconds=seconds).collect()}
        assert found == expected
    last = max(t for _, t, _ in timed)
    for seconds in (60, 2400):
        window = [x for x in timed if x[1] >= last - timedelta(seconds=seconds)]
        bad = sorted((t, u) for u, t, p in window if p == "Malicious")
        row = L.alert(df, seconds=seconds).first()
        assert (row.total, row.malicious) == (len(window), len(bad))
        assert row.rate == len(bad) / len(window)
        assert row.alert == (len(window) >= 10 and row.rate > 0.2)
        shown = [(r.processing_time, r.uid) for r in L.alert_rows(df, seconds=seconds).collect()]
        assert shown == bad[:20]
    order = sorted(timed, key=lambda x: x[0])
    order = [u for u, _, _ in sorted(order, key=lambda x: x[1], reverse=True)]
    for n in (1, 50, 150, len(order)):
        assert [r.uid for r in newest(df, n).collect()] == order[:n]
    assert newest(df, len(rows)).count() == len(rows)


def test_newest_when_one_minute_holds_most_rows(spark):
    df = spark.range(0, 5000, numPartitions=8).select(
        F.format_string("u%05d", "id").alias("uid"),
        F.timestamp_seconds(F.when(F.col("id") % 5 > 0, 1.7e9).otherwise(1.6e9 + F.col("id"))).alias("timestamp"),
    )
    times = {f"u{i:05d}": 1_700_000_000 if i % 5 else 1_600_000_000 + i for i in range(5000)}
    expected = sorted(times, key=lambda u: (-times[u], u))
    for n in (3, 40, 3990, 4010):
        assert [r.uid for r in newest(df, n).collect()] == expected[:n]
        epoch = df.select("uid", F.unix_seconds("timestamp").cast("double").alias("original_ts"))
        assert [r.uid for r in newest(epoch, n).collect()] == expected[:n]
    assert newest(df).count() == 5000
