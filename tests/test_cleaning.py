from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from flowlens.functions.values import label_of, to_long, to_port
from flowlens.operators import cleaning as C


def test_missing_and_decimal_measures(make_flows):
    df = make_flows(
        {"duration": "-", "orig_bytes": "-", "resp_bytes": "-"},
        {"duration": "0.25", "orig_bytes": "12.7", "resp_bytes": "12"},
        {"duration": "NaN", "orig_bytes": "x", "resp_bytes": None},
    )
    raw = C.cast_measures(df).orderBy("uid").collect()
    assert (raw[0].duration, raw[0].orig_bytes, raw[0].resp_bytes) == (None, None, None)
    assert (raw[1].duration, raw[1].orig_bytes, raw[1].resp_bytes) == (0.25, 12, 12)
    rows = C.clean(df).orderBy("uid").collect()
    assert [r.duration for r in rows] == [0.0, 0.25, 0.0]
    assert [r.orig_bytes for r in rows] == [0, 12, 0]
    assert [r.resp_bytes for r in rows] == [0, 12, 0]


def test_ports(make_flows):
    df = make_flows(
        {"resp_p": 22.0}, {"resp_p": math.nan}, {"resp_p": None}, {"resp_p": 1e12}
    )
    assert [r.resp_port for r in C.add_ports(df).orderBy("uid").collect()] == [22, None, None, None]


def test_types_after_cleaning(make_flows):
    types = dict(C.add_features(C.clean(make_flows({}))).dtypes)
    assert types["duration"] == types["bytes_per_sec"] == "double"
    assert types["orig_bytes"] == types["resp_bytes"] == types["total_bytes"] == "bigint"
    assert types["orig_port"] == types["hour_of_day"] == types["day_of_week"] == "int"
    assert types["timestamp"] == "timestamp"


def test_label_filters(make_flows):
    df = make_flows(
        {"label": "Malicious"}, {"label": "Benign"}, {"label": None}, {"label": "Malicious C&C"}
    )
    assert C.labelled(df).count() == 3
    assert C.malicious(df).count() == 2
    assert C.not_malicious(df).count() == 1


def test_time_features(make_flows):
    df = C.add_features(C.clean(make_flows({}, {"ts": 1526774400.0}, {"ts": None}, {"ts": 1e300})))
    rows = df.select(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS").alias("t"), "hour_of_day", "day_of_week", "uid"
    ).orderBy("uid").collect()
    assert rows[0][:3] == ("2018-05-19 18:57:41.000", 18, 7)
    assert rows[1][:3] == ("2018-05-20 00:00:00.000", 0, 1)
    assert rows[2][:3] == rows[3][:3] == (None, None, None)


def test_traffic_features(make_flows):
    df = C.clean(
        make_flows(
            {"duration": "0", "orig_bytes": "0", "resp_bytes": "0"},
            {"duration": "2", "orig_bytes": "30", "resp_bytes": "10"},
            {"duration": "-0.001"},
            {"orig_bytes": str(2**63 - 1), "resp_bytes": "1"},
        )
    )
    rows = C.add_bytes_ratio(C.add_features(df)).orderBy("uid").collect()
    assert (rows[0].bytes_per_sec, rows[0].orig_bytes_ratio) == (0.0, 0.0)
    assert rows[1].total_bytes == 40
    assert rows[1].bytes_per_sec == 40 / 2.001
    assert rows[1].orig_bytes_ratio == 30 / 40.000001
    assert rows[2].bytes_per_sec is None
    assert rows[3].total_bytes is None
    small = C.add_features(df, epsilon=0.000001).orderBy("uid").collect()
    assert small[1].bytes_per_sec == 40 / 2.000001


def test_ip_aliases_and_names(make_flows):
    df = make_flows({}).withColumnsRenamed({"orig_h": "id.orig_h", "detailed_label": "detailed-label"})
    row = C.add_ip_aliases(C.rename_fields(df)).first()
    assert (row.orig_ip, row.resp_ip, row.detailed_label) == ("10.0.0.1", "10.1.0.1", "-")


@pytest.mark.parametrize(
    ("prediction", "expected"),
    [(0.0, "Malicious"), (1.0, "Benign"), (2.0, "Unknown"), (0.5, "Unknown"), (-1.0, "Unknown"),
     (None, "Unknown"), (math.nan, "Unknown")],
)
def test_label_follows_the_fitted_order(spark, prediction, expected):
    df = spark.createDataFrame([(prediction,)], "prediction double")
    assert df.select(label_of("prediction", ["Malicious", "Benign"])).first()[0] == expected


def test_no_error_under_either_cast_mode(spark):
    df = spark.createDataFrame([("-",), ("9" * 30,), ("1e3",)], "x string")
    assert [r[0] for r in df.select(to_long("x")).collect()] == [None, None, 1000]
    assert [r[0] for r in df.select(to_port("x")).collect()] == [None, None, None]
