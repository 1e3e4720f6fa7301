from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowlens.operators import timeline as L
from flowlens.sources import predictions as P


def test_empty_minutes_count_zero(make_predictions):
    df = make_predictions(
        ("a", "2024-01-01 23:58:10", None, None),
        ("b", "2024-01-01 23:58:50", None, None),
        ("c", "2024-01-02 00:01:00", None, None),
        ("d", None, None, None),
    )
    rows = L.per_bucket(df).orderBy("processing_time").collect()
    assert [(str(r.processing_time)[11:16], r["count"]) for r in rows] == [
        ("23:58", 2), ("23:59", 0), ("00:00", 0), ("00:01", 1),
    ]


def test_one_minute_and_no_rows(make_predictions):
    df = make_predictions(("a", "2024-01-01 00:00:10", None, None))
    assert L.per_bucket(df).count() == 1
    assert L.per_bucket(df.where("false")).count() == 0


@pytest.mark.parametrize("seconds", [1, 7, 3600, 200_000])
def test_other_bucket_widths_against_brute_force(spark, seconds):
    start = datetime(1969, 12, 31, 23, 0)
    offsets = [0, 3, 3, 500, 7200, 7201, 90_000]
    df = spark.createDataFrame([(o,) for o in offsets], "o long").select(
        F.timestamp_seconds(F.col("o") - 3600).alias("t")
    )
    rows = {r.t: r["count"] for r in L.per_bucket(df, "t", seconds).collect()}
    epoch = datetime(1970, 1, 1)
    numbers = [int((start + timedelta(seconds=o) - epoch).total_seconds() // seconds) for o in offsets]
    expected = {
        epoch + timedelta(seconds=b * seconds): numbers.count(b)
        for b in range(min(numbers), max(numbers) + 1)
    }
    assert rows == expected


def test_counts_are_shuffled_once(make_predictions):
    df = L.per_bucket(make_predictions(("a", "2024-01-01 00:00:10", None, None)))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    assert "CartesianProduct" not in plan


def batch(make_predictions, malicious: int, total: int):
    label = ["Malicious"] * malicious + ["Benign"] * (total - malicious)
    return make_predictions(
        *[(f"u{i:02d}", f"2024-01-01 00:00:{i:02d}", None, x) for i, x in enumerate(label)]
    )


@pytest.mark.parametrize(
    ("malicious", "total", "fires"), [(3, 9, False), (3, 10, True), (2, 10, False), (0, 10, False)]
)
def test_alert_limits(make_predictions, malicious, total, fires):
    row = L.alert(batch(make_predictions, malicious, total)).first()
    assert (row.total, row.malicious, row.alert) == (total, malicious, fires)
    assert row.rate == malicious / total


def test_window_includes_its_first_instant(make_predictions):
    df = make_predictions(
        ("old", "2024-01-01 00:00:59", None, "Malicious"),
        ("edge", "2024-01-01 00:01:00", None, "Malicious"),
        ("new", "2024-01-01 00:02:00", None, "Benign"),
    )
    assert L.alert(df).first().total == 2
    assert [r.uid for r in L.alert_rows(df).collect()] == ["edge"]


def test_no_rows_no_alert(make_predictions):
    row = L.alert(batch(make_predictions, 0, 1).where("false")).first()
    assert (row.total, row.malicious, row.rate, row.alert) == (0, 0, 0.0, False)


def test_alert_rows_oldest_first(make_predictions):
    df = batch(make_predictions, 30, 40)
    assert [r.uid for r in L.alert_rows(df).collect()] == [f"u{i:02d}" for i in range(20)]


def test_alert_limit_reaches_the_scan(spark, make_predictions, tmp_path):
    path = str(tmp_path / "p")
    batch(make_predictions, 3, 10).write.parquet(path)
    df = L.alert(spark.read.parquet(path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line and "predicted_label" in line]
    assert "processing_time" in scan[0].split("DataFilters")[1].split("Format")[0]


def test_newest(make_predictions):
    rows = [(f"u{i:02d}", f"2024-01-01 00:{i // 4:02d}:00", None, None) for i in range(40)]
    df = make_predictions(*rows, ("x", None, None, None))
    expected = sorted(rows, key=lambda r: (r[1], [-ord(c) for c in r[0]]), reverse=True)
    for n in (1, 6, 39):
        assert [r.uid for r in P.newest(df, n).collect()] == [r[0] for r in expected[:n]]
    assert P.newest(df, 41).count() == 41
    assert P.newest(df, 100).collect()[-1].uid == "x"


def test_newest_sorts_by_the_first_field_present(spark):
    df = spark.createDataFrame([("a", 1.0, 9.0), ("b", 2.0, 5.0)], "uid string, original_ts double, z double")
    assert P.newest(df, 1).first().uid == "b"
    df = df.withColumn("timestamp", F.timestamp_seconds("z"))
    assert P.newest(df, 1).first().uid == "a"
    assert P.newest(df.select("uid"), 1).count() == 1


def test_newest_limit_reaches_the_scan(spark, make_predictions, tmp_path):
    path = str(tmp_path / "p")
    batch(make_predictions, 3, 10).write.parquet(path)
    plan = P.newest(spark.read.parquet(path), 3)._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line and "predicted_label" in line]
    assert "processing_time" in scan[0].split("DataFilters")[1].split("Format")[0]


def test_time_normalisation(spark):
    texts = spark.createDataFrame([("2024-01-01 10:00:00",), ("soon",)], "processing_time string")
    rows = [r[0] for r in P.normalise_time(texts).select("processing_time").collect()]
    assert rows == [datetime(2024, 1, 1, 10), None]
    both = spark.createDataFrame(
        [("2024-01-01 10:00:00", 1526756261.8665)], "timestamp string, original_ts double"
    )
    assert P.normalise_time(both).first().processing_time == datetime(2018, 5, 19, 18, 57, 41, 866500)
    assert P.normalise_time(both.drop("original_ts")).first().processing_time.hour == 10
    none = spark.createDataFrame([(1,)], "x int")
    assert P.normalise_time(none).columns == ["x"]


def test_missing_label_is_derived(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (3.0,)], "prediction double")
    named = P.with_predicted_label(df, ["Malicious", "Benign"])
    assert [r.predicted_label for r in named.collect()] == ["Malicious", "Benign", "Unknown"]
    assert P.with_predicted_label(named, ["x"]) is named
