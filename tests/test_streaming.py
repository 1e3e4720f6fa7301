from __future__ import annotations

import json
import shutil

import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowlens.models import training as T
from flowlens.operators import cleaning as C
from flowlens.operators import signatures as S
from flowlens.operators.dedup import first_seen
from flowlens.sources.files import read_event_flows
from flowlens.sources.topics import decode, encode, stream_topic, write_topic
from flowlens.streaming import sinks, windows
from flowlens.streaming.alerts import read_decisions, start_alerts
from flowlens.streaming.archive import compact_day, read_once
from flowlens.streaming.flagging import newest_version, publish_rules, start_flagging
from flowlens.streaming.sketches import compact_sketches, read_sketches, start_sketches
from flowlens.streaming.progress import METRICS, ProgressLog
from flowlens.streaming.scorer import score_messages, start_scoring
from flowlens.streaming.windows import alerts_per_window, counts_per_window
from flowlens.operators.distributions import describe

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def flows(spark):
    return read_event_flows(spark, SMALL)


@pytest.fixture(scope="module")
def bundle(flows):
    return T.train(C.add_features(C.clean(flows)), T.boosted_trees(rounds=3)).bundle


@pytest.fixture
def places(tmp_path):
    return {name: str(tmp_path / name) for name in ("topic", "output", "checkpoint")}


def run(spark, bundle, places, **options):
    query = start_scoring(
        stream_topic(spark, path=places["topic"], per_trigger=options.pop("per_trigger", None)),
        bundle, places["output"], places["checkpoint"], available_now=True, **options,
    )
    query.awaitTermination()
    return query


def test_stream_equals_batch(spark, flows, bundle, places):
    write_topic(encode(flows).repartition(3), path=places["topic"])
    run(spark, bundle, places, per_trigger=1)
    stored = sinks.read_scored(spark, places["output"])
    batch = bundle.score(C.add_features(C.clean(flows)))
    a = stored.select(F.col("uid").cast("long").alias("uid"), "prediction", "predicted_label", "label")
    b = batch.select("uid", "prediction", "predicted_label", "label")
    assert a.count() == 1000
    assert a.exceptAll(b).count() == 0
    assert stored.select("batch_id").distinct().count() == 3
    assert {"id_orig_h", "id_resp_p", "processing_time", "detailed_label"} <= set(stored.columns)
    assert dict(stored.dtypes)["probability"] == "array<double>"


def test_bad_messages_are_kept_apart(spark, bundle, places, make_flows):
    good = make_flows({}, {"label": None}, {"ts": None}, {"resp_p": None})
    broken = spark.createDataFrame([("{bad",), ("",)], "value string")
    write_topic(encode(good).unionByName(broken), path=places["topic"])
    told = []
    run(spark, bundle, places, report=lambda batch, counts: told.append((batch.batch_id, counts)))
    stored = sinks.read_scored(spark, places["output"])
    assert sorted(r.uid for r in stored.collect()) == ["C0", "C1"]
    assert all(r.prediction is not None and len(r.probability) == 2 for r in stored.collect())
    kept = [(r.reason, r.value) for r in sinks.read_unfit(spark, places["output"]).collect()]
    assert sorted(k[0] for k in kept) == ["incomplete", "incomplete", "incomplete", "malformed"]
    assert ("malformed", "{bad") in kept
    assert told == [(0, {None: 2, "malformed": 1, "incomplete": 3})]
    # The text of a message that was scored is not kept.
    assert spark.read.parquet(places["output"]).where("kind = 'scored' and value is not null").count() == 0


def test_restart_continues_from_the_checkpoint(spark, flows, bundle, places):
    write_topic(encode(flows.where("uid < 600")).coalesce(1), path=places["topic"])
    run(spark, bundle, places)
    write_topic(encode(flows.where("uid >= 600")).coalesce(1), path=places["topic"])
    run(spark, bundle, places)
    run(spark, bundle, places)
    stored = sinks.read_scored(spark, places["output"])
    assert stored.count() == stored.select("uid").distinct().count() == 1000


def test_batch_run_again_adds_nothing(spark, flows, bundle, places):
    """The commit of the last batch is lost, as after a crash between sink and commit."""
    write_topic(encode(flows).repartition(2), path=places["topic"])
    run(spark, bundle, places, per_trigger=1)
    copy = places["checkpoint"] + "-copy"
    shutil.copytree(
        places["checkpoint"], copy, ignore=lambda d, names: [n for n in names if d.endswith("commits") and n.strip(".crc") == "1"]
    )
    query = run(spark, bundle, {**places, "checkpoint": copy}, per_trigger=1)
    assert [p["batchId"] for p in query.recentProgress if p["numInputRows"]] == [1]
    stored = sinks.read_scored(spark, places["output"])
    assert stored.count() == stored.select("uid").distinct().count() == 1000


SMALL_ROWS = "uid string, timestamp timestamp"


def write_days(spark, path, batch_id, *days):
    rows = [(f"u{batch_id}{k}", f"{d} 10:00:00" if d else None) for k, d in enumerate(days)]
    df = spark.createDataFrame(rows, "uid string, t string")
    df = df.select("uid", F.col("t").cast("timestamp").alias("timestamp"))
    sinks.write_batch(df, path, sinks.Batch("q", batch_id))


def uids(df):
    return sorted(r.uid for r in df.collect())


def test_rows_lie_under_their_own_day(spark, tmp_path):
    """Three days and one wild time in a batch; a replay with other times leaves none behind."""
    path = str(tmp_path / "table")

    def day(d):
        return uids(spark.read.parquet(path).where(F.col("event_day") == d))

    write_days(spark, path, 0, "2024-05-01", "2024-05-02", "2024-05-03", "2199-01-01", "2024-05-02", None)
    assert day("2024-05-02") == ["u01", "u04"] and day("2199-01-01") == ["u03"]
    write_days(spark, path, 0, "2024-05-01", "2024-05-02", "2024-05-03", "2024-05-03", "2024-05-02", None)
    assert day("2199-01-01") == [] and spark.read.parquet(path).count() == 6


def test_archive_and_batches_give_each_row_once(spark, tmp_path):
    path, archive = str(tmp_path / "table"), str(tmp_path / "archive")

    def read():
        return uids(read_once(spark, path, SMALL_ROWS, archive))

    def compact(day="2024-05-02", **options):
        compact_day(spark, path, archive, day, SMALL_ROWS, **options)

    assert read() == []
    write_days(spark, path, 0, "2024-05-01", "2024-05-02", None)
    write_days(spark, path, 1, "2024-05-02", "2024-05-02")
    both = ["u00", "u01", "u02", "u10", "u11"]
    compact()
    assert read() == both
    # The newest batch stays where it is, so that a try that failed half way can be repeated.
    named = spark.read.parquet(f"{archive}/manifest")
    assert [r.write_key for r in named.collect()] == ["q-0"]
    # A batch that was archived is written again: what the archive holds counts.
    write_days(spark, path, 0, "2024-05-01", "2024-05-02", None)
    assert read() == both
    # Compacted again after a third batch: the second one is taken in now.
    write_days(spark, path, 2, "2024-05-02")
    compact()
    assert read() == [*both, "u20"]
    assert spark.read.parquet(f"{archive}/manifest").where("sequence = 2").count() == 2
    compact(ended=True)
    assert read() == [*both, "u20"]
    # Batches that were taken in may be removed by age; a later compaction keeps their rows.
    shutil.rmtree(f"{path}/write_key=q-1")
    compact("2024-05-02", ended=True)
    assert read() == [*both, "u20"]
    compact("2031-01-01", ended=True)
    assert read() == [*both, "u20"]


def test_compaction_that_broke_off(spark, tmp_path, monkeypatch):
    path, archive = str(tmp_path / "table"), str(tmp_path / "archive")
    write_days(spark, path, 0, "2024-05-02", "2024-05-03")

    def compact(day="2024-05-02"):
        compact_day(spark, path, archive, day, SMALL_ROWS, ended=True)

    compact("2024-05-03")
    before = uids(read_once(spark, path, SMALL_ROWS, archive))
    manifest = str(tmp_path / "manifest-before")
    shutil.copytree(f"{archive}/manifest", manifest)
    reader = read_once(spark, path, SMALL_ROWS, archive)  # planned before, used after
    compact()
    shutil.rmtree(f"{archive}/manifest")
    shutil.copytree(manifest, f"{archive}/manifest")
    # Its rows are in the archive, its entry is not.
    assert spark.read.parquet(f"{archive}/rows").count() == 2
    assert uids(read_once(spark, path, SMALL_ROWS, archive)) == before == uids(reader)
    compact()
    assert uids(read_once(spark, path, SMALL_ROWS, archive)) == before


def test_archived_predictions(spark, flows, bundle, places):
    write_topic(encode(flows).repartition(3), path=places["topic"])
    run(spark, bundle, places, per_trigger=1)
    archive = places["output"] + "-archive"
    before = sinks.read_scored(spark, places["output"])
    days = [str(r[0]) for r in before.select(F.to_date("timestamp")).distinct().limit(3).collect()]
    for day in days:
        sinks.compact_scored(spark, places["output"], archive, day)
    after = sinks.read_scored(spark, places["output"], archive)
    assert after.columns == before.columns and after.count() == 1000
    assert after.exceptAll(before).count() == 0
    assert spark.read.parquet(f"{archive}/rows").count() > 0


def test_archived_counts(spark, tmp_path):
    stream = predictions(
        spark, str(tmp_path / "in"), [("2024-05-01 10:00:30", "Malicious")] * 3,
        [("2024-05-01 10:00:40", "Malicious"), ("2024-05-02 00:00:00", "Benign")], [(None, "Benign")],
    )
    path, archive = str(tmp_path / "counts"), str(tmp_path / "archive")
    windows.start_counts(stream, path, str(tmp_path / "offsets")).awaitTermination()
    want = sorted(windows.read_counts(spark, path).collect())
    windows.compact_counts(spark, path, archive, "2024-05-01")
    assert sorted(windows.read_counts(spark, path, archive=archive).collect()) == want
    folded = spark.read.parquet(f"{archive}/rows").collect()
    assert [(r.value, r["count"]) for r in folded] == [("Malicious", 4)]
    assert len(want) == 2


def test_one_file_for_each_task_and_kind(spark, flows, bundle, places, tmp_path):
    """Rows of many days do not make many files."""
    write_topic(encode(flows.where("uid % 5 > 0")).coalesce(1), path=places["topic"])
    write_topic(encode(flows.where("uid % 5 = 0").withColumn("resp_p", F.lit(None))).coalesce(1), path=places["topic"])
    run(spark, bundle, places)
    for kind in ("scored", "unfit"):
        files = list((tmp_path / "output").glob(f"write_key=*/kind={kind}/*.parquet"))
        assert 1 <= len(files) <= 2
    assert sinks.read_scored(spark, places["output"]).select("event_day").distinct().count() > 10


def test_new_checkpoint_does_not_replace_old_batches(spark, make_flows, bundle, places):
    write_topic(encode(make_flows({})), path=places["topic"])
    run(spark, bundle, places)
    run(spark, bundle, {**places, "checkpoint": places["checkpoint"] + "-2"})
    assert sinks.read_scored(spark, places["output"]).count() == 2


def test_sink_error_ends_the_query(spark, make_flows, bundle, places):
    write_topic(encode(make_flows({})), path=places["topic"])

    def fail(*_):
        raise OSError("disk full")

    with pytest.raises(Exception, match="disk full"):
        run(spark, bundle, places, write=fail)
    run(spark, bundle, places)
    assert sinks.read_scored(spark, places["output"]).count() == 1


def test_empty_input_writes_nothing(spark, bundle, places, tmp_path):
    (tmp_path / "topic").mkdir()
    run(spark, bundle, places)
    assert not (tmp_path / "output").exists()


def test_interval_trigger_and_memory_table(spark, flows, bundle, places):
    write_topic(encode(flows), path=places["topic"])
    query = start_scoring(
        stream_topic(spark, path=places["topic"], partitions=4), bundle,
        places["output"], places["checkpoint"], every="1 second",
    )
    query.processAllAvailable()
    query.stop()
    assert sinks.read_scored(spark, places["output"]).count() == 1000
    scored = score_messages(stream_topic(spark, path=places["topic"]), bundle)
    sinks.start_memory(scored.select("uid", "predicted_label"), "kept").awaitTermination()
    assert spark.table("kept").count() == 1000


def test_rules_on_a_stream(spark, make_flows, places):
    rows = make_flows({}, {"resp_p": 53.0}, {"proto": None})
    write_topic(encode(rows), path=places["topic"])
    signatures = spark.createDataFrame([(22, "tcp", 5.0)], "resp_port int, proto string, risk_ratio double")
    stream = C.clean(decode(stream_topic(spark, path=places["topic"])))
    for size in (10**6, 0):
        flagged = S.apply_signatures(stream, signatures, 1.0, broadcast_bytes=size, salts=3)
        name = f"flagged_{size}"
        sinks.start_memory(flagged.select("uid", "flagged"), name).awaitTermination()
        assert sorted(map(tuple, spark.table(name).collect())) == [("C0", True), ("C1", False), ("C2", False)]


def test_progress(spark, flows, bundle, places):
    """Every batch is kept, also when Spark remembers two and the log writes after each."""
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    log = ProgressLog(spark, places["output"] + "-progress", every=1)
    spark.streams.addListener(log)
    try:
        write_topic(encode(flows).repartition(5), path=places["topic"])
        query = run(spark, bundle, places, per_trigger=1)
        log.wait(query)
    finally:
        spark.streams.removeListener(log)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    table = log.table()
    assert table.where("inputRows > 0").count() == 5
    assert table.agg(F.sum("inputRows")).first()[0] == 1000
    assert {r.statistic for r in describe(table, METRICS).collect()} >= {"mean", "50%", "max"}
    assert not log.batches


def test_partial_counts_are_complete(spark, tmp_path):
    """Rows of all batches count, in any order of time, and a batch run again counts once."""
    files = [
        [("2024-05-01 10:00:30", "Malicious")] * 12, [("2024-05-01 08:00:10", "Benign"), (None, "Benign")],
        [("2024-05-01 10:00:59", "Benign")], [("2024-05-01 09:00:00", "Malicious")] * 3,
    ]
    stream = predictions(spark, str(tmp_path / "in"), *files)
    path = str(tmp_path / "counts")
    for _ in range(2):
        windows.start_counts(stream, path, str(tmp_path / "offsets"), seconds=10).awaitTermination()
    found = {(str(r.start), r.predicted_label): r["count"] for r in windows.read_counts(spark, path).collect()}
    assert found == {
        ("2024-05-01 10:00:30", "Malicious"): 12, ("2024-05-01 08:00:10", "Benign"): 1,
        ("2024-05-01 10:00:50", "Benign"): 1, ("2024-05-01 09:00:00", "Malicious"): 3,
    }
    alerts = {str(r.start): (r.total, r.malicious) for r in windows.read_alerts(spark, path).collect()}
    starts = [f"2024-05-01 {t}" for t in ("09:59:40", "09:59:50", "10:00:00", "10:00:10", "10:00:20", "10:00:30")]
    assert alerts == {t: (12 if t < "2024-05-01 10:00:00" else 13, 12) for t in starts}


def predictions(spark, path, *files):
    """A stream of one file per batch, each a list of (time, predicted label)."""
    for number, rows in enumerate(files):
        df = spark.createDataFrame(rows, "t string, predicted_label string")
        df.coalesce(1).select(F.to_json(F.struct("*")).alias("value")).write.text(f"{path}/{number}")
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{path}/*")
    parsed = raw.select(F.from_json("value", "t string, predicted_label string").alias("d"))
    return parsed.select(F.col("d.t").cast("timestamp").alias("timestamp"), "d.predicted_label")


def results(stream, path):
    query = sinks.start_table(stream, path + "-out", path + "-offsets")
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path + "-out").collect()


def decisions(rows):
    """What the alert says after each batch, by its statement."""
    out, seen = [], []
    for number, batch in enumerate(rows):
        seen += [(pd.Timestamp(t), label) for t, label in batch if t]
        newest = max((t for t, _ in seen), default=None)
        own = [label for t, label in seen if t >= newest - pd.Timedelta(seconds=60)]
        bad = own.count("Malicious")
        rate = bad / len(own) if own else 0.0
        out.append((number, len(own), bad, rate, len(own) >= 10 and rate > 0.2))
    return out


def test_alert_after_each_batch(spark, tmp_path):
    """In any order of time; a batch that is run again after a crash decides as before."""
    burst = [(f"2024-05-01 10:00:{s:02d}", "Malicious" if s % 3 == 0 else "Benign") for s in range(12)]
    files = [
        [("2024-05-01 09:59:50", "Benign")] * 5, burst, [("2024-05-01 08:00:00", "Malicious")] * 30,
        [("2024-05-01 10:00:50", "Benign"), (None, "Malicious")],
        [("2024-05-01 09:59:55", "Benign"), ("2024-05-01 10:01:00", "Malicious")],
        [("2024-05-01 10:01:08", "Malicious")], [("2024-05-01 12:00:00", "Malicious")],
    ]
    stream = predictions(spark, str(tmp_path / "in"), *files)
    path, offsets = str(tmp_path / "alerts"), str(tmp_path / "offsets")
    start_alerts(stream, path, offsets).awaitTermination()
    read = lambda: sorted(
        (r.batch_id, r.total, r.malicious, r.rate, r.alert) for r in read_decisions(spark, path).collect()
    )
    assert read() == decisions(files)
    assert any(x[4] for x in read()) and not all(x[4] for x in read())
    copy = offsets + "-copy"
    shutil.copytree(offsets, copy, ignore=lambda d, names: [n for n in names if d.endswith("commits") and n.strip(".crc") == "6"])
    again = start_alerts(stream, path, copy)
    again.awaitTermination()
    assert [p["batchId"] for p in again.recentProgress if p["numInputRows"]] == [6]
    assert read() == decisions(files)


def test_rules_change_while_a_query_runs(spark, make_flows, tmp_path):
    topic, rules, output = (str(tmp_path / n) for n in ("topic", "rules", "flagged"))
    kind = "resp_port int, proto string, risk_ratio double"
    write_topic(encode(make_flows({"uid": "a"}, {"uid": "b", "resp_p": 53.0})), path=topic)
    stream = C.add_features(C.clean(decode(stream_topic(spark, path=topic))))
    assert newest_version(spark, rules) == 0
    query = start_flagging(stream, rules, output, str(tmp_path / "offsets"), every="100 milliseconds")
    try:
        query.processAllAvailable()
        for k, signature in enumerate([(22, "tcp", 5.0), (53, "tcp", 7.0)]):
            publish_rules(spark.createDataFrame([signature, (80, "tcp", 0.5)], kind), rules, 1.0)
            write_topic(encode(make_flows({"uid": f"a{k}"}, {"uid": f"b{k}", "resp_p": 53.0})), path=topic)
            query.processAllAvailable()
        assert publish_rules(spark.createDataFrame([], kind), rules, 1.0) == 3
        write_topic(encode(make_flows({"uid": "c"})), path=topic)
        query.processAllAvailable()
    finally:
        query.stop()
    got = {r.uid: (r.flagged, r.rule_version) for r in spark.read.parquet(output).collect()}
    assert got == {
        "a": (False, 0), "b": (False, 0), "a0": (True, 1), "b0": (False, 1), "a1": (False, 2),
        "b1": (True, 2), "c": (False, 3),
    }


def test_stream_sketches(spark, flows, tmp_path):
    topic, path, archive = (str(tmp_path / n) for n in ("topic", "sketches", "archive"))
    write_topic(encode(flows).repartition(3), path=topic)
    stream = C.add_features(C.clean(decode(stream_topic(spark, path=topic, per_trigger=1))))
    start_sketches(stream, path, str(tmp_path / "offsets"), ["total_bytes"]).awaitTermination()
    rows = read_sketches(spark, path).collect()
    want = {r.label: r["count"] for r in flows.groupBy("label").count().collect()}
    assert {r.label: r.n for r in rows} == want
    compact_sketches(spark, path, archive, "2024-01-02", ended=True)
    assert {r.label: r.n for r in read_sketches(spark, path, archive=archive).collect()} == want


def test_a_replay_after_the_watermark(spark, tmp_path):
    """Copies go while their record is in the state; what is older than the watermark goes anyway."""
    path = str(tmp_path / "p")
    stream = records(
        spark, path,
        [("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-01 00:00:00", 1), (None, "2024-01-01 00:00:05", 2), (None, "2024-01-01 00:00:05", 2), (None, "2024-01-01 00:00:05", 3)],
        [("a", "2024-01-01 00:30:00", 1), ("b", "2024-01-01 00:50:00", 1), ("x", None, 9)],
        [("c", "2024-01-01 05:00:00", 1)],  # the watermark moves to 04:00 after this batch
        [("d", "2024-01-01 05:00:30", 1)],  # and is that of late rows after this one
        [("a", "2024-01-01 00:00:00", 1), ("late", "2024-01-01 03:00:00", 1)],
        [("a", "2024-01-01 05:01:00", 1), ("b", "2024-01-01 04:30:00", 1)],
    )
    query = sinks.start_table(first_seen(stream, within="1 hour"), path + "-out", path + "-offsets")
    query.awaitTermination()
    rows = spark.read.parquet(path + "-out").collect()
    assert sorted((r.uid or "", str(r.timestamp)[11:16], r.n) for r in rows) == [
        ("", "00:00", 2), ("", "00:00", 3), ("a", "00:00", 1), ("a", "05:01", 1), ("b", "00:50", 1),
        ("b", "04:30", 1), ("c", "05:00", 1),
        ("d", "05:00", 1),
    ]
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert dropped == 2


def records(spark, path, *files):
    for number, rows in enumerate(files):
        df = spark.createDataFrame(rows, "uid string, t string, n int")
        df.coalesce(1).select(F.to_json(F.struct("*")).alias("value")).write.text(f"{path}/{number}")
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{path}/*")
    parsed = raw.select(F.from_json("value", "uid string, t string, n int").alias("d"))
    return parsed.select("d.uid", F.col("d.t").cast("timestamp").alias("timestamp"), "d.n")


def test_minute_windows_drop_late_rows(spark, tmp_path):
    path = str(tmp_path / "p")
    stream = predictions(
        spark, path,
        [("2024-01-01 00:00:10", "Benign"), ("2024-01-01 00:00:50", "Benign")],
        [("2024-01-01 00:10:00", "Benign")],
        [("2024-01-01 00:10:10", "Benign")],
        [("2024-01-01 00:00:20", "Benign"), ("2024-01-01 00:11:00", "Malicious")],
        [("2024-01-01 01:00:00", "Benign")],
    )
    rows = {(str(r.start)[11:16], r.predicted_label): r["count"] for r in results(counts_per_window(stream), path)}
    assert rows == {("00:00", "Benign"): 2, ("00:10", "Benign"): 2, ("00:11", "Malicious"): 1}


def test_sliding_alerts(spark, tmp_path):
    path = str(tmp_path / "p")
    burst = [(f"2024-01-01 00:05:{s:02d}", "Malicious" if s < 3 else "Benign") for s in range(10)]
    quiet = [(f"2024-01-01 00:20:{s:02d}", "Benign") for s in range(12)]
    stream = predictions(spark, path, burst, quiet, [("2024-01-01 02:00:00", "Benign")])
    rows = results(alerts_per_window(stream), path)
    assert sorted(str(r.start)[11:] for r in rows) == [
        f"00:04:{s}" for s in ("10", "20", "30", "40", "50")
    ] + ["00:05:00"]
    assert all((r.total, r.malicious, r.rate) == (10, 3, 0.3) for r in rows)


def test_snapshot(spark, tmp_path):
    df = spark.createDataFrame([("a", [0.25, 0.75])], "uid string, probability array<double>")
    path = str(tmp_path / "snapshot")
    sinks.write_snapshot(df, path)
    sinks.write_snapshot(df, path)
    assert spark.read.option("header", True).csv(path).collect() == [("a", "0.25 0.75")]
    assert json.loads(df.toJSON().first())["uid"] == "a"
