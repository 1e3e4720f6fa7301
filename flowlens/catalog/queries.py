"""Every operator as a query over the given tables.

A query takes a session and the folder of the tables. All read the event table as a whole and
view its rows as flows; times appear as text so that any engine prints them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions import features as X
from flowlens.models import features as M
from flowlens.models import training as T
from flowlens.models.bundle import ModelBundle
from flowlens.models.split import split_bucket, train_test_split
from flowlens.operators import arrivals as A
from flowlens.operators import cleaning as C
from flowlens.operators import dedup as U
from flowlens.operators import distributions as D
from flowlens.operators import evaluation as E
from flowlens.operators import quantiles as Z
from flowlens.operators import ranges as R
from flowlens.operators import signatures as S
from flowlens.operators import timeline as L
from flowlens.operators.joins import lookup_join
from flowlens.plans.explore import cached, explore
from flowlens.plans.messages import consumed, message_flows
from flowlens.plans.offline import count_predictions, score_flows
from flowlens.plans.reports import label_distribution
from flowlens.schema import CORRUPT
from flowlens.session import fresh_path, shared_dir, written
from flowlens.sources.files import (
    flows_from_events,
    read_delimited,
    read_event_flows,
    write_delimited,
)
from flowlens.sources.predictions import (
    DASHBOARD_ROWS,
    REPORT_ROWS,
    newest,
    normalise_time,
    with_predicted_label,
)
from flowlens.sources.topics import (
    decode,
    encode,
    read_topic,
    stream_topic,
    write_topic,
)
from flowlens.streaming.alerts import read_decisions, start_alerts
from flowlens.streaming.flagging import publish_rules, start_flagging
from flowlens.streaming.progress import ProgressLog
from flowlens.streaming.scorer import score_messages, start_scoring
from flowlens.streaming.sinks import (
    SCORED,
    Batch,
    compact_scored,
    read_scored,
    start_memory,
    start_table,
    stored_columns,
    write_batch,
    write_snapshot,
)
from flowlens.streaming.sketches import read_sketches, start_sketches
from flowlens.streaming.windows import compact_counts, read_alerts, read_counts, start_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = 86400
FEW_ROWS = 100
#: Share of a class's flows that a fitted model must decode rightly; one that always gives the same
#: answer fails it for the other class.
RIGHT = 0.8


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Inputs


def flows(spark: SparkSession, folder: str) -> DataFrame:
    return read_event_flows(spark, folder)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return C.clean(flows(spark, folder))


def featured(spark: SparkSession, folder: str) -> DataFrame:
    return C.add_features(cleaned(spark, folder))


def sparse_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Flows of which each eleventh lacks a port, so that it cannot be scored."""
    port = F.when(F.col("uid") % 11 != 0, F.col("resp_p"))
    return flows(spark, folder).withColumn("resp_p", port)


def predicted_label() -> Column:
    """The rule that stands in for a model where a query needs fixed predictions."""
    risky = (F.col("resp_p") >= 80) | (F.col("conn_state") == "S0")
    return (
        F.when(F.col("uid") % 50 == 0, "Unknown").when(risky, "Malicious").otherwise("Benign")
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    rows = C.labelled(featured(spark, folder))
    return rows.withColumns(
        {"predicted_label": predicted_label(), "processing_time": F.col("timestamp")}
    )


def text(time: str) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias(time)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def message_topic(spark: SparkSession, folder: str, files: int | None = None) -> str:
    """All flows as messages in a topic of text files; its path."""
    path = fresh_path(spark, "topic")
    messages = encode(flows(spark, folder))
    write_topic(messages.repartition(files) if files else messages, path=path)
    return path


def streamed(stream: DataFrame) -> DataFrame:
    """What a stream writes until its input is used up."""
    spark = stream.sparkSession
    path = fresh_path(spark, "streamed")
    start_table(stream, path, fresh_path(spark, "offsets")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def prediction_stream(spark: SparkSession, folder: str, *measures: str) -> DataFrame:
    """Labelled flows with fixed predictions from four unordered files, one in each batch."""
    path = message_topic(spark, folder, files=4)
    return streamed_predictions(stream_topic(spark, path=path, per_trigger=1), *measures)


def streamed_predictions(messages: DataFrame, *measures: str) -> DataFrame:
    """Labelled flows of a stream with fixed predictions, parsed as far as these need."""
    rows = message_flows(messages, ["uid", "timestamp", "resp_p", "conn_state", "label", *measures])
    rows = C.labelled(rows).withColumn("uid", F.col("uid").cast("long"))
    return rows.withColumn("predicted_label", predicted_label())


def counted(spark: SparkSession, folder: str, seconds: int) -> str:
    """Rows per bucket and label of the prediction stream, by micro-batch; their path."""
    path = fresh_path(spark, "window-counts")
    stream = prediction_stream(spark, folder)
    start_counts(stream, path, fresh_path(spark, "offsets"), seconds=seconds).awaitTermination()
    return path


_trained: dict[tuple[str, str, str], T.Trained] = {}


def trained(spark: SparkSession, folder: str, kind: str = "boosted") -> T.Trained:
    """A model fitted on the training part of the flows; fitted once per session."""
    key = (spark.sparkContext.applicationId, folder, kind)
    if key not in _trained:
        classifier = T.random_forest() if kind == "forest" else T.boosted_trees()
        _trained[key] = T.train(featured(spark, folder), classifier, stage=True)
    return _trained[key]


def forget_trained() -> None:
    _trained.clear()


def checked(
    scored: DataFrame, bundle: ModelBundle, *also: str, at_rest: bool = False
) -> DataFrame:
    """What must hold for every scored flow, whatever the model has learned.

    Flows are scored once for both uses; ``at_rest``: they have been, and come from a table.
    """
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    kept = ["uid", "label", "prediction", "probability", "predicted_label", *also]
    scored = scored.select(*dict.fromkeys(kept))
    if not at_rest:
        scored = written(scored, "scored")
    index = F.array_position(F.array(*map(F.lit, bundle.labels)), F.col("predicted_label")) - 1
    # A label may hold most rows, so flows are not shuffled by it.
    classes = recalled(scored).select("label", "class_recalled")
    return lookup_join(scored, classes, ["label"], spread=["uid"]).select(
        F.col("uid").cast("long").alias("uid"),
        F.col("predicted_label").isin(bundle.labels).alias("label_known"),
        (index == F.col("prediction")).alias("label_matches_index"),
        (F.abs(total - 1) < 1e-9).alias("probability_complete"),
        F.coalesce("class_recalled", F.lit(True)).alias("class_recalled"),
        *also,
    )


def recalled(scored: DataFrame) -> DataFrame:
    """(label, scored, class_recalled): scored flows, and whether enough have the right label."""
    right = F.avg((F.col("predicted_label") == F.col("label")).cast("double"))
    known = scored.where(F.col("predicted_label").isNotNull() & F.col("label").isNotNull())
    return known.groupBy("label").agg(
        F.count("*").alias("scored"), (right >= RIGHT).alias("class_recalled")
    )


# Sources and parsing


@query
def src1_topic_read(spark, folder):
    messages = read_topic(spark, path=message_topic(spark, folder))
    return decode(messages, fields=["uid", "ts", "duration", "label"])


@query
def src2_topic_stream(spark, folder):
    messages = stream_topic(spark, path=message_topic(spark, folder))
    return streamed(decode(messages, fields=["uid", "ts", "duration", "label"]))


@query
def src3_limited_stream(spark, folder):
    path = message_topic(spark, folder, files=4)
    messages = stream_topic(spark, path=path, per_trigger=1)
    return streamed(decode(messages, fields=["uid", "proto", "label"]))


@query
def src4_delimited_read(spark, folder):
    path = fresh_path(spark, "delimited")
    write_delimited(flows(spark, folder), path)
    rows = C.clean(read_delimited(spark, path))
    return rows.select(
        F.col("uid").cast("long").alias("uid"),
        "ts", "orig_h", "orig_port", "resp_port", "duration", "orig_bytes", "resp_bytes",
        "service",
    )


@query
def src5_newest_for_report(spark, folder):
    rows = newest(predictions(spark, folder), REPORT_ROWS)
    return rows.select("uid", text("processing_time"), "predicted_label")


@query
def src5_newest_by_processing_time(spark, folder):
    rows = newest(predictions(spark, folder), FEW_ROWS)
    return rows.select("uid", text("processing_time"), "predicted_label")


@query
def src5_newest_by_timestamp(spark, folder):
    rows = newest(predictions(spark, folder).drop("processing_time"), FEW_ROWS)
    return rows.select("uid", text("timestamp"), "predicted_label")


@query
def src5_newest_by_original_ts(spark, folder):
    rows = predictions(spark, folder).withColumn("original_ts", F.col("ts"))
    rows = newest(rows.drop("processing_time", "timestamp"), FEW_ROWS)
    return rows.select("uid", "original_ts", "predicted_label")


@query
def src5_newest_for_dashboard(spark, folder):
    rows = newest(predictions(spark, folder).drop("processing_time"), DASHBOARD_ROWS)
    return rows.select("uid", text("timestamp"), "predicted_label")


@query
def par1_decode(spark, folder):
    rows = decode(encode(flows(spark, folder)))
    return rows.withColumn("uid", F.col("uid").cast("long"))


@query
def par1_pruned_report(spark, folder):
    """A report over messages whose three columns alone are parsed."""
    messages = read_topic(spark, path=message_topic(spark, folder))
    return consumed(messages, lambda rows: D.count_by(rows, "proto", "conn_state", "hour_of_day"))


@query
def par2_quarantine(spark, folder):
    """Every thirteenth message is cut in half."""
    messages = encode(flows(spark, folder).withColumn("cut", F.col("uid") % 13 == 0))
    half = F.expr("substring(value, 1, length(value) div 2)")
    value = F.when(F.col("value").contains('"cut":true'), half).otherwise(F.col("value"))
    decoded = decode(
        messages.withColumn("value", value), ["uid", "label"], corrupt=True, keep_value=True
    )
    uid = F.regexp_extract("value", r'^\{"uid":([0-9]+)', 1)
    good = F.col(CORRUPT).isNull()
    return decoded.select(
        F.when(good, F.col("uid")).otherwise(uid).cast("long").alias("uid"),
        F.when(good, F.col("label")).alias("label"),
        good.alias("decoded"),
    )


@query
def par3_encode(spark, folder):
    messages = encode(flows(spark, folder))
    field = {"uid": "uid", "orig_h": "id.orig_h", "detailed_label": "detailed-label", "label": "label"}
    names = [F.get_json_object("value", f"$['{wire}']").alias(c) for c, wire in field.items()]
    clock = F.get_json_object("value", "$.timestamp_simulated").isNotNull().alias("has_clock")
    return messages.select(*names, clock)


@query
def par4_text_time(spark, folder):
    """Every seventeenth time is no time."""
    rows = predictions(spark, folder)
    broken = F.when(F.col("uid") % 17 == 0, "n/a").otherwise(text("processing_time"))
    rows = normalise_time(rows.withColumn("processing_time", broken))
    return rows.select("uid", text("processing_time"))


@query
def par4_epoch_time(spark, folder):
    rows = predictions(spark, folder).drop("processing_time")
    rows = normalise_time(rows.withColumn("original_ts", F.col("ts")))
    return rows.select("uid", F.unix_micros("processing_time").alias("micros"))


@query
def par5_derived_label(spark, folder):
    rows = predictions(spark, folder)
    labels = M.vocabularies(rows, ["label"])["label"]
    number = F.when(F.col("predicted_label") == "Benign", 0.0)
    number = number.when(F.col("predicted_label") == "Malicious", 1.0).otherwise(2.0)
    rows = rows.withColumn("prediction", number).drop("predicted_label")
    return with_predicted_label(rows, labels).select("uid", "prediction", "predicted_label")


# Projections and cleaning


@query
def prj1_cast_measures(spark, folder):
    return C.cast_measures(flows(spark, folder)).select("uid", *C.MEASURES)


@query
def prj2_ports(spark, folder):
    return C.add_ports(flows(spark, folder)).select("uid", "orig_port", "resp_port")


@query
def prj3_fill_missing(spark, folder):
    return cleaned(spark, folder).select("uid", *C.MEASURES)


@query
def prj4_labelled(spark, folder):
    return C.labelled(cleaned(spark, folder)).select("uid", "label")


@query
def prj5_rename(spark, folder):
    rows = flows(spark, folder).withColumnsRenamed({"orig_h": "id.orig_h", "resp_h": "id.resp_h"})
    return C.add_ip_aliases(C.rename_fields(rows)).select("uid", "orig_h", "orig_ip", "resp_ip")


@query
def prj6_malicious(spark, folder):
    return C.malicious(cleaned(spark, folder)).select("uid", "label", "resp_port")


@query
def prj6_not_malicious(spark, folder):
    return C.not_malicious(cleaned(spark, folder)).select("uid", "label", "resp_port")


@query
def prj7_stored_columns(spark, folder):
    rows = predictions(spark, folder).withColumns(
        {"prediction": F.lit(0.0), "probability": F.array(F.lit(1.0), F.lit(0.0))}
    )
    stored = stored_columns(rows, batch_id=7).drop("probability", "processing_time")
    return stored.withColumn("timestamp", text("timestamp"))


@query
def prj8_evaluable(spark, folder):
    seen = F.nullif(F.col("predicted_label"), F.lit("Unknown"))
    rows = featured(spark, folder).withColumn("predicted_label", predicted_label())
    rows = rows.withColumn("predicted_label", seen)
    return C.evaluable(rows).select("uid", "label", "predicted_label")


# Features


@query
def fea1_timestamp(spark, folder):
    return featured(spark, folder).select("uid", text("timestamp"))


@query
def fea2_hour_of_day(spark, folder):
    return featured(spark, folder).select("uid", "hour_of_day")


@query
def fea3_day_of_week(spark, folder):
    return featured(spark, folder).select("uid", "day_of_week")


@query
def fea4_total_bytes(spark, folder):
    return featured(spark, folder).select("uid", "total_bytes")


@query
def fea5_bytes_per_sec(spark, folder):
    return featured(spark, folder).select("uid", "bytes_per_sec")


@query
def fea6_bytes_per_sec_small_epsilon(spark, folder):
    rows = C.add_features(cleaned(spark, folder), epsilon=X.SMALL_EPSILON)
    return rows.select("uid", "bytes_per_sec")


@query
def fea7_orig_bytes_ratio(spark, folder):
    return C.add_bytes_ratio(featured(spark, folder)).select("uid", "orig_bytes_ratio")


# Aggregations


@query
def agg0_row_count(spark, folder):
    return D.row_count(cleaned(spark, folder))


@query
def agg1_label_counts(spark, folder):
    return D.count_by(cleaned(spark, folder), "label")


@query
def agg2_detailed_label_counts(spark, folder):
    return D.count_by(cleaned(spark, folder), "detailed_label")


@query
def agg3_proto_counts(spark, folder):
    return D.count_by(cleaned(spark, folder), "proto")


@query
def agg4_proto_label_counts(spark, folder):
    return D.count_by_key_order(cleaned(spark, folder), "proto", "label")


@query
def agg5_conn_state_counts(spark, folder):
    return D.count_by(cleaned(spark, folder), "conn_state")


@query
def agg1_to_5_in_one_scan(spark, folder):
    return D.category_counts(cleaned(spark, folder))


@query
def agg6_label_statistics(spark, folder):
    rows = D.label_statistics(cleaned(spark, folder))
    return rounded(rows, "avg_duration", "std_duration", "avg_orig_bytes", "avg_resp_bytes")


@query
def agg7_top_malicious_ports(spark, folder):
    return D.top_malicious_ports(cleaned(spark, folder))


@query
def agg8_recall(spark, folder):
    return E.recall_by_label(predictions(spark, folder))


@query
def agg9_precision(spark, folder):
    return E.precision_by_prediction(predictions(spark, folder))


@query
def agg10_confusion_counts(spark, folder):
    return E.confusion_counts(predictions(spark, folder))


@query
def agg11_confusion_matrix(spark, folder):
    return E.confusion_matrix(predictions(spark, folder))


@query
def agg12_classification_report(spark, folder):
    return rounded(
        E.classification_report(predictions(spark, folder)), "precision", "recall", "f1"
    )


def by_class(spark: SparkSession, folder: str, flows_: DataFrame) -> DataFrame:
    """Flows per predicted class (NULL: not scored), with its label, and whether their number is
    that of the flows with this label, give or take what the model may get wrong."""
    model = trained(spark, folder).bundle
    scored = score_flows(flows_, model)
    counts = count_predictions(scored).withColumnRenamed("count", "found")
    names = spark.createDataFrame(list(enumerate(model.labels)), "class int, label string")
    expected = scored.where("label is not null").groupBy(
        F.when(F.col("reason").isNull(), F.col("label")).alias("of")
    ).agg(F.count("*").alias("flows"))
    unlabelled = scored.where("label is null").agg(F.count("*").alias("n")).scalar()
    named = counts.join(F.broadcast(names), F.col("prediction") == F.col("class"), "left")
    both = named.join(expected, F.col("label").eqNullSafe(F.col("of")))
    near = F.abs(F.col("found") - F.col("flows")) <= (1 - RIGHT) * F.col("flows") + unlabelled
    return both.select("label", "flows", near.alias("counts_agree"))


@query
def agg13_prediction_total(spark, folder):
    """Flows per predicted class of flows that all can be scored."""
    return by_class(spark, folder, flows(spark, folder))


@query
def agg14_predicted_label_counts(spark, folder):
    seen = F.nullif(F.col("predicted_label"), F.lit("Unknown"))
    return label_distribution(predictions(spark, folder).withColumn("predicted_label", seen))


@query
def agg15_label_index_pairs(spark, folder):
    rows = C.labelled(cleaned(spark, folder))
    model = M.label_indexer(M.vocabularies(rows, ["label"])["label"])
    return D.distinct_pairs(model.transform(rows), "label", "label_index")


@query
def agg16_metric_summary(spark, folder):
    """Summary of one metrics row per hour of flows, taken as a batch."""
    hours = featured(spark, folder).groupBy(F.floor(F.unix_seconds("timestamp") / 3600).alias("b"))
    batches = hours.agg(
        F.count("*").alias("input_rows"),
        F.sum("duration").cast("long").alias("proc_time"),
        (F.count("*") / 3600).alias("rows_per_second"),
    )
    columns = ["input_rows", "proc_time", "rows_per_second"]
    return rounded(D.describe(batches, columns), *columns)


# Joins and signatures


@query
def joi1_signatures_by_join(spark, folder):
    return S.port_signatures_joined(cleaned(spark, folder))


@query
def joi2_null_keys(spark, folder):
    """Every third protocol is NULL; such a group finds no benign partner."""
    rows = cleaned(spark, folder)
    proto = F.when(F.col("uid") % 3 != 0, F.col("proto"))
    return S.port_signatures_joined(rows.withColumn("proto", proto))


@query
def sig1_port_signatures(spark, folder):
    return S.port_signatures(cleaned(spark, folder))


@query
def sig2_rules(spark, folder):
    return S.rule_texts(S.port_signatures(cleaned(spark, folder)))


@query
def sig3_flagged_flows(spark, folder):
    rows = cleaned(spark, folder)
    flagged = S.apply_signatures(rows, S.port_signatures(rows), threshold=3.0)
    return flagged.select("uid", "resp_port", "proto", "risk_ratio", "flagged")


@query
def sig4_refreshed_rules(spark, folder):
    """The first half of the flows meets rules from a ratio of 3 on, the second those below it."""
    rows = cleaned(spark, folder)
    topic, rules = fresh_path(spark, "topic"), fresh_path(spark, "rules")
    output, offsets = fresh_path(spark, "flagged"), fresh_path(spark, "offsets")
    signatures = written(S.port_signatures(rows), "signatures")
    for half, ratio in ((0, F.col("risk_ratio") >= 3.0), (1, F.col("risk_ratio") < 3.0)):
        publish_rules(signatures.where(ratio), rules, threshold=0.0)
        write_topic(encode(flows(spark, folder).where(F.col("uid") % 2 == half)), path=topic)
        stream = C.add_features(C.clean(decode(stream_topic(spark, path=topic))))
        start_flagging(stream, rules, output, offsets).awaitTermination()
    flagged = spark.read.parquet(output)
    uid = F.col("uid").cast("long").alias("uid")
    return flagged.select(uid, "resp_port", "proto", "risk_ratio", "flagged", "rule_version")


@query
def rng1_port_ranges(spark, folder):
    return R.port_ranges(cleaned(spark, folder))


@query
def rng2_risky_port_ranges(spark, folder):
    """Ports at most two apart, hit twice or more and more often than benign flows hit them."""
    return R.port_ranges(cleaned(spark, folder), gap=2, min_malicious=2, min_ratio=0.5)


# Distributions


MEASURED = ["duration", "total_bytes", "bytes_per_sec"]
SHARES = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)


@query
def dis1_size_and_time_by_label(spark, folder):
    """Exact quantiles of the measures of each class, unlabelled flows among them."""
    found = Z.exact_quantiles(featured(spark, folder), MEASURED, SHARES, by=["label"])
    return rounded(found, "value")


@query
def dis2_gaps_by_label(spark, folder):
    """Exact quantiles of the time between the flows of a source, by class."""
    gaps = A.with_gap(flows(spark, folder))
    return rounded(Z.exact_quantiles(gaps, ["gap"], SHARES, by=["label"]), "value")


@query
def dis3_gap_of_each_flow(spark, folder):
    return rounded(A.with_gap(flows(spark, folder)).select("uid", "orig_h", "gap"), "gap")


@query
def dis4_stream_sketches(spark, folder):
    """Quantiles from sketches of four micro-batches, merged: whether their rank is near enough."""
    path = fresh_path(spark, "sketches")
    start_sketches(
        prediction_stream(spark, folder, *MEASURED), path, fresh_path(spark, "offsets"), MEASURED
    ).awaitTermination()
    found = Z.sketch_quantiles(read_sketches(spark, path), SHARES)
    rows = Z._values(C.labelled(featured(spark, folder)), MEASURED, ["label"])
    ranks = rows.withColumnRenamed("value", "x").join(F.broadcast(found), ["column", "label"])
    share = lambda c: F.avg(c.cast("double"))
    near = ranks.groupBy("column", "label", "n", "fraction").agg(
        (share(F.col("x") < F.col("value")) - 0.03 <= F.col("fraction")).alias("not_above"),
        (share(F.col("x") <= F.col("value")) + 0.03 >= F.col("fraction")).alias("not_below"),
    )
    return near


# Records sent again


@query
def ded1_replayed_topic(spark, folder):
    """A topic that was sent twice, in six micro-batches: each record once."""
    path = message_topic(spark, folder, files=3)
    write_topic(encode(flows(spark, folder)).repartition(3), path=path)
    rows = C.add_features(C.clean(decode(stream_topic(spark, path=path, per_trigger=1))))
    once = streamed(U.first_seen(rows, within="60 days"))
    return once.select(F.col("uid").cast("long").alias("uid"), "conn_state", "label", "total_bytes")


@query
def ded2_newest_of_each_record(spark, folder):
    """Every third record was sent again a minute later with another state, every fifth as it was."""
    rows = flows(spark, folder)
    later = rows.where("uid % 3 = 0").withColumns(
        {"ts": F.col("ts") + 60, "conn_state": F.lit("RSTO")}
    )
    sent = rows.unionByName(later).unionByName(rows.where("uid % 5 = 0"))
    return rounded(U.newest_per_key(sent).select("uid", "ts", "conn_state", "label"), "ts")


# Time buckets and alerts


@query
def tim1_per_minute(spark, folder):
    rows = L.per_bucket(predictions(spark, folder))
    return rows.select(text("processing_time"), "count")


@query
def tim2_stream_per_minute(spark, folder):
    rows = read_counts(spark, counted(spark, folder, 60))
    return rows.select(text("start"), "predicted_label", "count")


@query
def alr1_alert(spark, folder):
    """The newest day, since the test events are sparse."""
    return L.alert(predictions(spark, folder), seconds=DAY)


@query
def alr2_alert_rows(spark, folder):
    rows = L.alert_rows(predictions(spark, folder), seconds=DAY)
    return rows.select("uid", text("processing_time"), "predicted_label")


@query
def alr3_stream_alerts(spark, folder):
    path = counted(spark, folder, DAY // 4)
    alerts = read_alerts(spark, path, seconds=DAY, slide=DAY // 4, threshold=0.35)
    return alerts.select(text("start"), text("end"), "total", "malicious", "rate")


@query
def alr4_alert_after_each_batch(spark, folder):
    """The newest day's decision after each of four unordered micro-batches."""
    topic, path = fresh_path(spark, "topic"), fresh_path(spark, "alerts")
    offsets = fresh_path(spark, "offsets")
    for part in (2, 0, 3, 1):
        write_topic(encode(flows(spark, folder).where(F.col("uid") % 4 == part)), path=topic)
        rows = streamed_predictions(stream_topic(spark, path=topic))
        start_alerts(rows, path, offsets, seconds=DAY, threshold=0.35).awaitTermination()
    found = read_decisions(spark, path)
    return found.select("batch_id", text("newest"), "total", "malicious", "rate", "alert")


@query
def tim3_archived_counts(spark, folder):
    """Counts per hour with three days archived; one of them got a batch later."""
    path, archive = fresh_path(spark, "window-counts"), fresh_path(spark, "archive")
    offsets, topic = fresh_path(spark, "offsets"), fresh_path(spark, "topic")
    for part in range(2):
        write_topic(encode(flows(spark, folder).where(F.col("uid") % 2 == part)), path=topic)
        rows = streamed_predictions(stream_topic(spark, path=topic))
        start_counts(rows, path, offsets, seconds=3600).awaitTermination()
        for day in ("2024-01-02", "2024-01-03", "2024-01-04")[part:]:
            compact_counts(spark, path, archive, day, ended=part == 0)
    found = read_counts(spark, path, archive=archive)
    return found.select(text("start"), "predicted_label", "count")


# Features and models


@query
def mlf1_category_index(spark, folder):
    """Fitted on labelled flows, applied to all; state of every ninth flow is unseen or NULL."""
    rows = featured(spark, folder)
    words = M.vocabularies(C.labelled(rows), M.CATEGORIES)
    state = F.when(F.col("uid") % 18 == 0, None).when(F.col("uid") % 9 == 0, "new")
    rows = rows.withColumn("conn_state", state.otherwise(F.col("conn_state")))
    indexed = PipelineModel(stages=M.category_indexers(words)).transform(rows)
    return indexed.select("uid", *M.INDEXES)


@query
def mlf2_label_index(spark, folder):
    rows = C.labelled(cleaned(spark, folder))
    model = M.label_indexer(M.vocabularies(rows, ["label"])["label"])
    return model.transform(rows).select("uid", "label_index")


def _slots(vector: str, n: int) -> list[Column]:
    array = vector_to_array(vector)
    return [F.get(array, F.lit(i)).alias(f"{vector}_{i}") for i in range(n)]


@query
def mlf3_one_hot(spark, folder):
    rows = C.labelled(featured(spark, folder))
    encoded = M.fit_encoding(rows).transform(rows)
    return encoded.select("uid", *_slots("proto_vec", 3), *_slots("conn_state_vec", 3))


@query
def mlf4_assembled(spark, folder):
    rows = C.labelled(featured(spark, folder))
    assembled = M.assembler().transform(M.fit_encoding(rows).transform(rows))
    return assembled.select("uid", *_slots("features_raw", 15))


@query
def mlf5_scaled(spark, folder):
    rows = C.labelled(featured(spark, folder))
    scaled = M.fit_features(rows).transform(rows).select("uid", *_slots("features", 15))
    return rounded(scaled, *scaled.columns[1:])


@query
def mlf6_stages_equal_steps(spark, folder):
    """One pipeline, and encoding followed by assembly and scaling, give the same vectors."""
    rows = C.labelled(featured(spark, folder))
    whole = M.fit_features(rows).transform(rows)
    assembled = M.assembler().transform(M.fit_encoding(rows).transform(rows))
    steps = M.scaler().fit(assembled).transform(assembled)
    a = whole.select("uid", vector_to_array("features").alias("a"))
    b = steps.select("uid", vector_to_array("features").alias("b"))
    near = F.forall(F.zip_with("a", "b", lambda x, y: F.abs(x - y) < 1e-9), lambda x: x)
    return a.join(b, "uid").select("uid", near.alias("same"))


@query
def mlm1_split(spark, folder):
    train, test = train_test_split(C.labelled(cleaned(spark, folder)))
    parts = train.withColumn("part", F.lit("train")).union(
        test.withColumn("part", F.lit("test"))
    )
    return parts.select("uid", "part", split_bucket().alias("bucket"))


@query
def mlm2_random_forest(spark, folder):
    model = trained(spark, folder, "forest")
    return checked(model.bundle.score(model.test), model.bundle)


@query
def mlm3_boosted_trees(spark, folder):
    model = trained(spark, folder)
    return checked(model.bundle.score(model.test), model.bundle)


@query
def mlm4_accuracy_and_f1(spark, folder):
    return rounded(E.accuracy_and_f1(predictions(spark, folder)), "accuracy", "f1")


@query
def mlm5_evaluators(spark, folder):
    """The evaluators over fixed predictions, with the byte count modulo 997 as the score."""
    rows = predictions(spark, folder).where("predicted_label <> 'Unknown'")
    score = F.pmod(F.col("total_bytes"), F.lit(997)).cast("double")
    index = lambda c: (F.col(c) == "Malicious").cast("double")
    scored = rows.select(
        index("label").alias(M.LABEL_INDEX), index("predicted_label").alias("prediction"),
        array_to_vector(F.array(-score, score)).alias("rawPrediction"),
    )
    values = T.judged(scored, binary=True)
    rows = [(k, round(v, 6)) for k, v in sorted(values.items())]
    return spark.createDataFrame(rows, "metric string, value double")


@query
def mlm6_saved_model(spark, folder):
    """Flows that a saved and loaded model scores as the fitted one does."""
    model = trained(spark, folder)
    path = fresh_path(spark, "model")
    model.bundle.save(path)
    again = ModelBundle.load(path)
    a = model.bundle.score(model.test).select("uid", "probability", "predicted_label")
    b = again.score(model.test).select(
        "uid", F.col("probability").alias("p"), F.col("predicted_label").alias("l")
    )
    same = (F.col("probability") == F.col("p")) & (F.col("predicted_label") == F.col("l"))
    return a.join(b, "uid").select("uid", same.alias("same"))


@query
def mlm7_class_weights(spark, folder):
    return rounded(E.class_weights(cleaned(spark, folder)), "weight")


@query
def mlm8_importances(spark, folder):
    """Names of the features; no importance is negative, their sum is 1, and the connection state
    or the port, from which labels follow, has the largest."""
    rows = T.importance_table(trained(spark, folder, "forest").bundle, spark)
    facts = rows.agg(
        (F.min("importance") >= 0).alias("none_negative"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("sum_is_one"),
        F.max_by("feature", "importance").rlike("^(conn_state=|resp_port)").alias("top_explains"),
    )
    return rows.select("feature").join(F.broadcast(facts))


# Scoring, streams and sinks


@query
def sco1_features_on_stream(spark, folder):
    """The feature pipeline, fitted on the training part, on a stream: its first scaled slots."""
    features = trained(spark, folder).bundle.features
    messages = stream_topic(spark, path=message_topic(spark, folder))
    rows = features.transform(C.add_features(C.clean(decode(messages))))
    slots = streamed(rows.select(F.col("uid").cast("long").alias("uid"), *_slots("features", 15)))
    return rounded(slots, *slots.columns[1:])


@query
def sco2_scored_flows(spark, folder):
    """Flows that lack a port are given too, without a prediction and with the reason."""
    model = trained(spark, folder).bundle
    return checked(score_flows(sparse_flows(spark, folder), model), model, "reason")


@query
def sco3_decoded_labels(spark, folder):
    """The learned order of labels is by frequency, so the decoding follows the data."""
    model = trained(spark, folder).bundle
    scored = score_flows(flows(spark, folder), model)
    pairs = D.distinct_pairs(scored, "prediction", "predicted_label")
    return pairs.withColumnRenamed("predicted_label", "label")


def _scoring(spark: SparkSession, folder: str, files: int | None = None):
    model = trained(spark, folder).bundle
    path = message_topic(spark, folder, files)
    messages = stream_topic(spark, path=path, per_trigger=1 if files else None)
    output = fresh_path(spark, "scored")
    run = start_scoring(messages, model, output, fresh_path(spark, "offsets"), available_now=True)
    run.awaitTermination()
    return model, output, run


@query
def str1_stream_scoring(spark, folder):
    model, output, _ = _scoring(spark, folder)
    scored = read_scored(spark, output)
    return checked(scored, model, "label", "detailed_label", "id_orig_h", at_rest=True)


@query
def str2_str6_batch_progress(spark, folder):
    """Rows over all micro-batches of a rate-limited scoring stream."""
    log = ProgressLog(spark, fresh_path(spark, "progress"), every=2)
    spark.streams.addListener(log)
    try:
        _, _, run = _scoring(spark, folder, files=3)
        log.wait(run)
    finally:
        spark.streams.removeListener(log)
    return log.table().where("inputRows > 0").agg(
        F.sum("inputRows").alias("rows"), F.count("*").alias("batches")
    )


@query
def str3_repartitioned_stream(spark, folder):
    messages = stream_topic(spark, path=message_topic(spark, folder), partitions=4)
    return streamed(decode(messages, fields=["uid", "conn_state"]))


@query
def str4_empty_batch(spark, folder):
    """A stream whose second file has no message: that batch writes nothing, the others all."""
    model = trained(spark, folder).bundle
    path = message_topic(spark, folder)
    write_topic(spark.createDataFrame([], "value string"), path=path)
    output, offsets = fresh_path(spark, "scored"), fresh_path(spark, "offsets")
    for _ in range(2):
        start_scoring(
            stream_topic(spark, path=path, per_trigger=1), model, output, offsets,
            available_now=True,
        ).awaitTermination()
    return read_scored(spark, output).select(F.col("uid").cast("long").alias("uid"), "label")


@query
def str5_batch_written_twice(spark, folder):
    rows = predictions(spark, folder).withColumns(
        {"prediction": F.lit(0.0), "probability": F.array(F.lit(1.0), F.lit(0.0))}
    )
    path = fresh_path(spark, "scored")
    for batch_id in (0, 1, 0):
        part = stored_columns(rows.where(F.col("uid") % 2 == batch_id), batch_id)
        write_batch(part, path, Batch("query", batch_id))
    return spark.read.parquet(path).select("uid", "batch_id", "predicted_label")


@query
def snk1_archive_and_batches(spark, folder):
    """Predictions of three batches, a day of which is archived before one is written again."""
    rows = predictions(spark, folder).withColumns(
        {"prediction": F.lit(0.0), "probability": F.array(F.lit(1.0), F.lit(0.0)), "kind": F.lit(SCORED)}
    )
    rows = rows.withColumn("uid", F.col("uid").cast("string"))
    path, archive = fresh_path(spark, "scored"), fresh_path(spark, "archive")

    def write(batch_id: int) -> None:
        part = stored_columns(rows.where(F.col("uid").cast("long") % 3 == batch_id), batch_id, "kind")
        write_batch(part, path, Batch("query", batch_id))

    write(0)
    write(1)
    days = [r.d for r in rows.select(F.to_date("timestamp").cast("string").alias("d")).distinct().orderBy("d").limit(2).collect()]
    compact_scored(spark, path, archive, days[0])
    write(2)
    for day in days:
        compact_scored(spark, path, archive, day, ended=True)
    write(1)
    found = read_scored(spark, path, archive)
    return found.select(F.col("uid").cast("long").alias("uid"), "batch_id", "predicted_label")


@query
def snk2_memory_table(spark, folder):
    model = trained(spark, folder).bundle
    path = fresh_path(spark, "topic")
    write_topic(encode(sparse_flows(spark, folder)), path=path)
    scored = score_messages(stream_topic(spark, path=path), model)
    counts = scored.groupBy("label", "reason", "predicted_label").count()
    start_memory(counts, "scored_counts", "complete").awaitTermination()
    right = F.sum(F.when(F.col("predicted_label") == F.col("label"), F.col("count")))
    good = F.coalesce(F.col("reason").isNotNull() | F.col("label").isNull() | (right >= RIGHT * F.sum("count")), F.lit(False))
    return spark.table("scored_counts").groupBy("label", "reason").agg(
        F.sum("count").alias("rows"), good.alias("class_recalled")
    )


@query
def snk3_snapshot(spark, folder):
    path = fresh_path(spark, "snapshot")
    rows = predictions(spark, folder)
    rows = rows.withColumn("probability", F.array(F.lit(0.25), F.lit(0.75)))
    columns = ["uid", "probability", "predicted_label"]
    write_snapshot(rows.select(*columns), path)
    return spark.read.option("header", True).schema(
        "uid long, probability string, predicted_label string"
    ).csv(path)


@query
def snk4_offline_scoring(spark, folder):
    """Delimited text to flows per predicted class; those that lack a port have none."""
    path = fresh_path(spark, "delimited")
    write_delimited(sparse_flows(spark, folder), path)
    return by_class(spark, folder, read_delimited(spark, path))


@query
def snk5_cached_exploration(spark, folder):
    path = fresh_path(spark, "exploration")
    with cached(cleaned(spark, folder)) as rows:
        for name in ("proto", "conn_state"):
            counts = D.count_by(rows, name).select(
                F.lit(name).alias("dimension"), F.col(name).alias("value"), "count"
            )
            counts.write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query
def explored_without_cache(spark, folder):
    reports = explore(cleaned(spark, folder))
    return reports["proto_label"].withColumnRenamed("value", "proto")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    shared_dir(spark)
    return sig1_port_signatures(spark, folder)
