from __future__ import annotations

import itertools

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from flowlens.operators import evaluation as E
from flowlens.plans.reports import label_distribution, report

PAIRS = {
    ("Benign", "Benign"): 5, ("Benign", "Malicious"): 2, ("Malicious", "Malicious"): 7,
    ("Malicious", "Benign"): 1, ("Malicious", "Unknown"): 3, (None, "Benign"): 4,
    ("Benign", None): 2, ("Odd", "Benign"): 1,
}


@pytest.fixture
def judged(make_predictions):
    rows = itertools.chain.from_iterable([pair] * n for pair, n in PAIRS.items())
    return make_predictions(
        *[(f"u{i}", "2024-01-01 00:00:00", a, p) for i, (a, p) in enumerate(rows)]
    )


def expected_report():
    known = {k: n for k, n in PAIRS.items() if None not in k}
    classes = sorted({c for pair in known for c in pair})
    lines, total = {}, sum(known.values())
    for c in classes:
        tp = known.get((c, c), 0)
        support = sum(n for (a, _), n in known.items() if a == c)
        predicted = sum(n for (_, p), n in known.items() if p == c)
        precision = tp / predicted if predicted else 0.0
        recall = tp / support if support else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        lines[c] = (precision, recall, f1, support)
    own = list(lines.values())
    accuracy = sum(known.get((c, c), 0) for c in classes) / total
    lines["accuracy"] = (accuracy,) * 3 + (total,)
    lines["macro avg"] = tuple(sum(x[i] for x in own) / len(own) for i in range(3)) + (total,)
    lines["weighted avg"] = tuple(sum(x[i] * x[3] for x in own) / total for i in range(3)) + (total,)
    return lines


def test_report_against_brute_force(judged):
    rows = {r["class"]: tuple(r)[1:] for r in E.classification_report(judged).collect()}
    expected = expected_report()
    assert rows.keys() == expected.keys()
    for name, values in expected.items():
        assert rows[name] == pytest.approx(values)
    assert rows["Unknown"] == (0.0, 0.0, 0.0, 0)
    assert rows["Odd"] == (0.0, 0.0, 0.0, 1)


def test_accuracy_and_f1_equal_the_evaluator(judged):
    names = {"Malicious": 0.0, "Benign": 1.0, "Unknown": 2.0, "Odd": 3.0}
    known = judged.dropna(subset=["label", "predicted_label"])
    index = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    numbers = known.select(index[F.col("label")].alias("y"), index[F.col("predicted_label")].alias("p"))
    row = E.accuracy_and_f1(judged).first()
    judge = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p")
    assert row.accuracy == pytest.approx(judge.setMetricName("accuracy").evaluate(numbers))
    assert row.f1 == pytest.approx(judge.setMetricName("f1").evaluate(numbers))


def test_recall_and_precision(judged):
    known = judged.dropna(subset=["label", "predicted_label"])
    assert E.recall_by_label(known).collect() == [
        ("Benign", 5, 7, 5 / 7), ("Malicious", 7, 11, 7 / 11), ("Odd", 0, 1, 0.0),
    ]
    assert E.precision_by_prediction(known).collect() == [
        ("Benign", 5, 7, 5 / 7), ("Malicious", 7, 9, 7 / 9), ("Unknown", 0, 3, 0.0),
    ]


def test_confusion(judged):
    assert E.confusion_matrix(judged).collect() == [("Benign", 5, 2), ("Malicious", 1, 7)]
    assert E.confusion_matrix(judged.where("false")).collect() == [("Benign", 0, 0), ("Malicious", 0, 0)]
    counts = {(r.label, r.predicted_label): r["count"] for r in E.confusion_counts(judged).collect()}
    assert counts == PAIRS


def test_class_weights(judged):
    weights = {r.label: r.weight for r in E.class_weights(judged).collect()}
    assert weights == pytest.approx({"Benign": 21 / (3 * 9), "Malicious": 21 / (3 * 11), "Odd": 7.0})


def test_label_distribution_skips_null(judged):
    assert label_distribution(judged).collect() == [("Benign", 11), ("Malicious", 9), ("Unknown", 3)]


def test_report_tables(judged):
    tables = report(judged, ["Malicious", "Benign"])
    assert set(tables) == {"labels", "per_minute", "alert", "alert_rows", "classification", "confusion"}
    assert tables["per_minute"].collect()[0]["count"] == 25
    assert tables["alert"].first().malicious == 9
    few = report(judged.drop("label", "processing_time"), ["Malicious", "Benign"], rows=3)
    assert set(few) == {"labels"}
    assert few["labels"].agg(F.sum("count")).first()[0] == 3
