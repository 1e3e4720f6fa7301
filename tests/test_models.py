from __future__ import annotations

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowlens.models import features as M
from flowlens.models import training as T
from flowlens.models.bundle import ModelBundle
from flowlens.models.split import random_split, split_bucket, train_test_split
from flowlens.operators import cleaning as C
from flowlens.plans.offline import score_flows
from flowlens.operators.evaluation import accuracy_and_f1
from flowlens.plans.offline import timed_scoring
from flowlens.sources.files import read_event_flows

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parsed(spark):
    return read_event_flows(spark, SMALL)


@pytest.fixture(scope="module")
def flows(parsed):
    return C.add_features(C.clean(parsed))


@pytest.fixture(scope="module")
def boosted(flows):
    return T.train(flows)


def test_vocabulary_is_the_indexers_order(flows):
    rows = C.labelled(flows)
    words = M.vocabularies(rows, ["proto", "conn_state", "label"])
    for column, values in words.items():
        model = StringIndexer(inputCol=column, outputCol="i").fit(rows)
        assert values == list(model.labels)


def test_vocabulary_ties_nulls_and_size(spark):
    rows = [("b", ""), ("a", "x"), (None, ""), ("", None), ("c", "x"), ("c", "")]
    df = spark.createDataFrame(rows, "proto string, label string")
    # Empty text is a label, but no slot of a vector.
    assert M.vocabularies(df, ["proto", "label"]) == {"proto": ["c", "a", "b"], "label": ["", "x"]}
    many = spark.range(20_000).select(F.format_string("%05d", "id").alias("x"))
    assert len(M.vocabularies(many, ["x"])["x"]) == 20_000


def test_empty_label_is_learned(spark, parsed):
    rows = C.add_features(C.clean(parsed))
    rows = rows.withColumn("label", F.when(F.col("label") == "Benign", "").otherwise(F.col("label")))
    model = T.train(rows, T.random_forest(trees=2))
    assert "" in model.bundle.labels
    assert T.evaluate(model.bundle, model.test)["left_out"] == 0


class Constant:
    """A model that always gives the first label."""

    def __init__(self, bundle):
        self.bundle, self.labels = bundle, bundle.labels

    def score(self, df):
        scored = self.bundle.score(df)
        return scored.withColumns({"prediction": F.lit(0.0), "predicted_label": F.lit(self.labels[0])})


def test_a_constant_model_is_found_out(flows, boosted):
    from flowlens.catalog.queries import checked

    rows = boosted.test.where("label is not null")
    assert checked(boosted.bundle.score(rows), boosted.bundle).where("not class_recalled").isEmpty()
    constant = Constant(boosted.bundle)
    assert not checked(constant.score(rows), constant).where("not class_recalled").isEmpty()


def test_scoring_keeps_every_row(parsed, boosted):
    sparse = parsed.withColumn("resp_p", F.when(F.rand(1) < 0.8, F.col("resp_p")))
    sparse = sparse.cache()
    scored = score_flows(sparse, boosted.bundle)
    missing = sparse.where("resp_p is null").count()
    assert missing and scored.count() == sparse.count()
    unfit = scored.where("reason = 'incomplete'")
    assert unfit.count() == missing
    assert unfit.where("prediction is not null or resp_port is not null").isEmpty()
    assert scored.where("reason is null and (prediction is null or resp_port is null)").isEmpty()


def test_unseen_and_null_category(make_flows):
    seen = C.add_features(C.clean(make_flows({"proto": "tcp"}, {"proto": "udp"}, {"proto": "tcp"})))
    model = M.fit_encoding(seen)
    new = C.add_features(C.clean(make_flows({"proto": "icmp"}, {"proto": None}, {"proto": "udp"})))
    rows = model.transform(new).select(
        "proto_index", vector_to_array("proto_vec").alias("v")
    ).collect()
    assert rows == [(2.0, [0.0, 0.0]), (2.0, [0.0, 0.0]), (1.0, [0.0, 1.0])]


def test_unlabelled_flow_fails_only_the_label_index(make_flows):
    rows = C.clean(make_flows({"label": None}))
    with pytest.raises(Exception, match="(?i)null|label"):
        M.label_indexer(["a", "b"]).transform(rows).collect()


def test_incomplete_rows_go_to_quarantine(make_flows):
    rows = C.add_features(C.clean(make_flows({}, {"ts": None}, {"resp_p": None}, {"orig_p": float("nan")})))
    fit, unfit = M.split_assemblable(rows)
    assert [r.uid for r in fit.collect()] == ["C0"]
    assert sorted(r.uid for r in unfit.collect()) == ["C1", "C2", "C3"]


def test_split_is_stable_and_complete(flows):
    train, test = train_test_split(flows)
    assert train.count() + test.count() == flows.count()
    assert train.join(test, "uid").count() == 0
    again, _ = train_test_split(flows.repartition(7))
    assert {r.uid for r in again.select("uid").collect()} == {r.uid for r in train.select("uid").collect()}
    share = train.count() / flows.count()
    assert 0.75 < share < 0.85
    assert sum(part.count() for part in random_split(flows)) == flows.count()


def test_split_without_id(flows):
    train, test = train_test_split(flows.drop("uid"))
    assert train.count() + test.count() == flows.count()
    assert 0.7 < train.count() / flows.count() < 0.9
    empty = flows.withColumn("uid", F.lit(None).cast("string"))
    assert 0.7 < train_test_split(empty)[0].count() / flows.count() < 0.9
    assert flows.where(split_bucket().isNull()).count() == 0


def test_features_are_fitted_on_the_training_part(flows, boosted):
    model = boosted.bundle.features
    expected = M.fit_features(boosted.train)
    assert list(model.stages[-1].mean) == pytest.approx(list(expected.stages[-1].mean))
    whole = M.fit_features(C.labelled(flows))
    assert list(model.stages[-1].mean) != pytest.approx(list(whole.stages[-1].mean))


def test_predictions_are_labels_with_probabilities(boosted, flows):
    scored = boosted.bundle.score(flows)
    assert scored.count() == flows.count()
    bad = ~F.col("predicted_label").isin(boosted.bundle.labels)
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    assert scored.where(bad | (F.abs(total - 1) > 1e-9)).count() == 0


def test_label_zero_is_the_most_frequent(boosted):
    assert boosted.bundle.labels == ["Benign", "Malicious"]
    row = boosted.bundle.score(boosted.test).where("prediction = 0").first()
    assert row.predicted_label == "Benign"


def test_model_learns_and_measures_agree(boosted):
    values = T.evaluate(boosted.bundle, boosted.test)
    assert values["accuracy"] > 0.95 and values["auc"] > 0.95
    row = accuracy_and_f1(boosted.bundle.score(boosted.test)).first()
    assert values["accuracy"] == pytest.approx(row.accuracy)
    assert values["f1"] == pytest.approx(row.f1)


def test_same_seed_same_model(flows, boosted):
    again = T.train(flows).bundle.score(boosted.test).select("uid", "probability")
    first = boosted.bundle.score(boosted.test).select("uid", "probability")
    assert first.exceptAll(again).count() == 0


def test_staged_training_gives_the_same_labels(flows, boosted):
    staged = T.train(flows, stage=True)
    assert staged.bundle.labels == boosted.bundle.labels
    assert staged.train.count() == boosted.train.count()


def test_saved_model_scores_alike(boosted, tmp_path):
    path = str(tmp_path / "model")
    boosted.bundle.save(path)
    boosted.bundle.save(path)
    loaded = ModelBundle.load(path)
    assert loaded.labels == boosted.bundle.labels
    a = boosted.bundle.score(boosted.test).select("uid", "prediction", "probability", "predicted_label")
    b = loaded.score(boosted.test).select("uid", "prediction", "probability", "predicted_label")
    assert a.exceptAll(b).count() == 0


def test_unlabelled_and_newly_labelled_flows_are_scored(boosted, make_flows):
    rows = C.add_features(C.clean(make_flows({"label": None}, {"label": "New", "proto": "sctp"})))
    assert boosted.bundle.score(rows).count() == 2


def test_forest_importances_and_weights(flows):
    model = T.train(flows, T.random_forest(trees=5), weighted=True).bundle
    values = dict(model.importances())
    assert sum(values.values()) == pytest.approx(1.0)
    assert list(values)[:9] == M.NUMERIC
    assert set(list(values)[9:]) == {
        "proto=tcp", "proto=udp", "proto=icmp",
        "conn_state=SF", "conn_state=S0", "conn_state=REJ",
    }
    assert max(values, key=values.get) in ("conn_state=S0", "resp_port", "conn_state=SF")
    assert model.classifier.getNumTrees == 5


def test_timed_scoring_counts_every_flow(boosted, parsed):
    counts, seconds = timed_scoring(parsed, boosted.bundle)
    assert sum(r["count"] for r in counts) == parsed.count()
    assert seconds > 0


def test_staged_rows_are_derived_once(flows, monkeypatch):
    """The filter of usable rows stays above what its columns are made of."""
    staged = {}

    def stop(df, name):
        staged[name] = df
        raise StopIteration

    monkeypatch.setattr(T, "written", stop)
    with pytest.raises(StopIteration):
        T.train(flows, stage=True)
    plan = staged["training"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object(") == 1
    usable = C.labelled(flows).where(M.assemblable())
    assert staged["training"].schema.names == usable.schema.names
    assert staged["training"].exceptAll(usable).isEmpty() and usable.exceptAll(staged["training"]).isEmpty()


def test_checked_flows_are_not_shuffled_by_label(spark, boosted):
    from flowlens.catalog.queries import checked

    rows = [
        ("1", "Benign", 0.0, [0.9, 0.1], "Benign"), ("2", "Malicious", 0.0, [0.9, 0.1], "Benign"),
        ("3", None, 1.0, [0.2, 0.8], "Malicious"), ("3", "Benign", None, None, None),
    ]
    names = "uid string, label string, prediction double, probability array<double>, predicted_label string"
    found = checked(spark.createDataFrame(rows, names), boosted.bundle, "label")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert sorted(((r.uid, r.label or "", r.class_recalled) for r in found.collect())) == [
        (1, "Benign", True), (2, "Malicious", False), (3, "", True), (3, "Benign", True),
    ]
