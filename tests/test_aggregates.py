from __future__ import annotations

import statistics

import pytest

from flowlens.operators import cleaning as C
from flowlens.operators import distributions as D
from flowlens.plans.explore import cached, explore


@pytest.fixture
def flows(make_flows):
    return C.clean(
        make_flows(
            {"proto": "udp", "label": "Malicious", "resp_p": 53.0, "duration": "2"},
            {"proto": "udp", "label": "Malicious", "resp_p": 53.0, "duration": "-"},
            {"proto": "tcp", "label": "Malicious", "resp_p": 22.0, "duration": "7"},
            {"proto": "tcp", "label": "Benign", "resp_p": 22.0, "duration": "3"},
            {"proto": None, "label": None, "conn_state": "S0"},
        )
    )


def test_counts_are_ordered_with_ties_by_key(flows):
    assert D.count_by(flows, "proto").collect() == [("tcp", 2), ("udp", 2), (None, 1)]
    assert D.count_by_key_order(flows, "proto", "label").collect() == [
        (None, None, 1), ("tcp", "Benign", 1), ("tcp", "Malicious", 1), ("udp", "Malicious", 2),
    ]
    assert D.row_count(flows).first() == (5,)


def test_label_statistics(flows):
    rows = {r.label: r for r in D.label_statistics(flows).collect()}
    assert rows["Malicious"].avg_duration == 3.0
    assert rows["Malicious"].std_duration == pytest.approx(statistics.stdev([2, 0, 7]))
    assert rows["Benign"].std_duration is None


def test_top_ports(flows):
    assert D.top_malicious_ports(flows, 1).collect() == [(53, "udp", 2)]


def test_one_scan_equals_single_counts(flows):
    rows = D.category_counts(flows).collect()
    for name in ("label", "detailed_label", "proto", "conn_state"):
        one = {(r.value, r["count"]) for r in rows if r.dimension == name}
        assert one == set(map(tuple, D.count_by(flows, name).collect()))
    both = {(r.value, r.label, r["count"]) for r in rows if r.dimension == "proto_label"}
    assert both == set(map(tuple, D.count_by(flows, "proto", "label").collect()))


def test_value_counts(flows):
    rows = {tuple(r) for r in D.value_counts(flows, ["proto", "label"]).collect()}
    assert rows == {
        ("proto", "tcp", 2), ("proto", "udp", 2), ("proto", None, 1),
        ("label", "Malicious", 3), ("label", "Benign", 1), ("label", None, 1),
    }


def test_describe_matches_pandas(spark):
    pandas = pytest.importorskip("pandas")
    frame = pandas.DataFrame({"a": [1.0, 2.0, 4.0, 8.0, None], "b": [5.0, 5.0, 5.0, 6.0, 9.0]})
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0), (8.0, 6.0), (None, 9.0)], "a double, b double")
    ours = {r.statistic: (r.a, r.b) for r in D.describe(df, ["a", "b"]).collect()}
    for name, row in frame.describe().iterrows():
        assert ours[name] == pytest.approx((row.a, row.b))


def test_exploration(flows, spark):
    reports = explore(flows)
    assert {tuple(r) for r in reports["proto"].collect()} == {("tcp", 2), ("udp", 2), (None, 1)}
    assert reports["rules"].count() == 2
    with cached(flows) as kept:
        assert kept.is_cached
        assert kept.count() == 5
    assert not kept.is_cached
