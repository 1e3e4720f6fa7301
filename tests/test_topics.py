from __future__ import annotations

import json
import re

import pytest

from flowlens.models.features import split_assemblable
from flowlens.operators.cleaning import add_features, clean, labelled
from flowlens.operators.distributions import count_by
from flowlens.plans.messages import columns_used, consumed
from flowlens.sources.files import read_delimited, write_delimited
from flowlens.sources.topics import decode, encode, read_topic, split_corrupt, stream_topic, write_topic

RECORD = {
    "ts": 1526756261.8665, "uid": "C9", "id.orig_h": "192.168.2.5", "id.orig_p": 38792.0,
    "id.resp_h": "200.168.87.203", "id.resp_p": 59353.0, "proto": "tcp", "service": "-",
    "duration": "2.998333", "orig_bytes": "0", "resp_bytes": "0", "conn_state": "S0",
    "label": "Malicious", "detailed-label": "PartOfAHorizontalPortScan", "history": "S",
    "timestamp_simulated": 1764778995.5,
}


def messages(spark, *texts: str):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_decode_takes_known_fields_and_renames(spark):
    row = decode(messages(spark, json.dumps(RECORD))).first().asDict()
    assert row == {
        "uid": "C9", "ts": 1526756261.8665, "orig_h": "192.168.2.5", "orig_p": 38792.0,
        "resp_h": "200.168.87.203", "resp_p": 59353.0, "proto": "tcp", "duration": "2.998333",
        "orig_bytes": "0", "resp_bytes": "0", "conn_state": "S0", "label": "Malicious",
        "detailed_label": "PartOfAHorizontalPortScan",
    }


def test_decode_binary_value_and_some_fields(spark):
    df = messages(spark, json.dumps(RECORD)).selectExpr("cast(value as binary) as value")
    decoded = decode(df, fields=["label", "detailed_label"])
    assert decoded.columns == ["label", "detailed_label"]
    assert decoded.first() == ("Malicious", "PartOfAHorizontalPortScan")
    with pytest.raises(ValueError, match="nope"):
        decode(df, fields=["nope"])


def test_not_a_number_tokens_and_plain_numbers(spark):
    text = json.dumps({"label": float("nan"), "id.resp_p": float("nan"), "orig_bytes": 12, "resp_bytes": 3.5})
    row = decode(messages(spark, text)).first()
    assert row.label is None
    assert row.resp_p != row.resp_p
    assert (row.orig_bytes, row.resp_bytes) == ("12", "3.5")


def test_malformed_message(spark):
    df = messages(spark, "{bad", json.dumps(RECORD))
    rows = decode(df).orderBy("uid").collect()
    assert all(v is None for v in rows[0])
    good, bad = split_corrupt(df)
    assert [r.uid for r in good.collect()] == ["C9"]
    assert [r.value for r in bad.collect()] == ["{bad"]


def test_encode_round_trip(spark, make_flows):
    df = make_flows({}, {"label": None, "resp_p": None}, {"duration": "-"})
    sent = encode(df)
    first = json.loads(sent.first().value)
    assert first["id.orig_h"] == "10.0.0.1" and first["detailed-label"] == "-"
    assert first["timestamp_simulated"] > 1.6e9
    assert "timestamp_simulated" not in encode(df, clock=False).first().value
    assert sorted(decode(sent).select(df.columns).collect()) == sorted(df.collect())


def test_topic_of_files(spark, make_flows, tmp_path):
    path = str(tmp_path / "topic")
    write_topic(encode(make_flows({}, {})), path=path)
    write_topic(encode(make_flows({})), path=path)
    assert read_topic(spark, path=path).count() == 3
    assert stream_topic(spark, path=path, per_trigger=2, partitions=3).isStreaming


def test_topic_needs_an_address(spark):
    for read in (read_topic, stream_topic):
        with pytest.raises(ValueError, match="path"):
            read(spark, servers="host:9092")


def test_delimited_files(spark, make_flows, tmp_path):
    df = make_flows({}, {"duration": "-"})
    path = str(tmp_path / "flows")
    write_delimited(df, path)
    back = read_delimited(spark, path)
    assert len(back.columns) == 23
    assert sorted(back.select(df.columns).collect()) == sorted(df.collect())


def test_delimited_file_with_other_header_fails(spark, tmp_path):
    file = tmp_path / "flows.csv"
    file.write_text("a|b|c\n1|2|3\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_delimited(spark, str(file)).collect()


def test_message_is_parsed_once_under_filters(spark, tmp_path):
    path = str(tmp_path / "topic")
    messages(spark, json.dumps(RECORD)).write.text(path)
    flows = add_features(clean(decode(read_topic(spark, path=path))))
    fit, _ = split_assemblable(labelled(flows))
    plan = fit.select("label", "bytes_per_sec")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert fit.count() == 1


def test_null_and_empty_messages_stay_rows_of_nulls(spark):
    rows = decode(messages(spark, None, "", "[]", "{}"), keep_value=True).collect()
    assert sorted(str(r.value) for r in rows) == ["", "None", "[]", "{}"]
    assert all(r.uid is None and r.ts is None for r in rows)


def test_only_used_fields_are_parsed(spark, make_flows, tmp_path):
    """Three columns, one of them derived: three fields, and each message parsed once."""
    path = str(tmp_path / "topic")
    write_topic(encode(make_flows({}, {"proto": "udp"}, {"ts": None})), path=path)
    messages = read_topic(spark, path=path)
    report = lambda rows: count_by(rows.where("resp_port < 100"), "proto", "hour_of_day")
    assert columns_used(report, spark) == ["proto", "resp_port", "hour_of_day"]
    found = consumed(messages, report)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    fields = set(re.findall(r"StructField\(([^,]+),", plan))
    assert fields == {"proto", "id.resp_p", "ts"}
    rows = sorted((r.proto, r.hour_of_day or -1, r["count"]) for r in found.collect())
    assert rows == [("tcp", -1, 1), ("tcp", 18, 1), ("udp", 18, 1)]
    everything = columns_used(lambda rows: rows.where("ts > 0"), spark)
    assert len(everything) == 20
