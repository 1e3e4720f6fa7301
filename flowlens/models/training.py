"""Fitting and judging of tree classifiers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.models.bundle import ModelBundle
from flowlens.models.features import (
    CATEGORIES,
    LABEL,
    LABEL_INDEX,
    assemblable,
    fit_features,
    label_indexer,
    vocabularies,
)
from flowlens.models.split import flow_key, train_test_split
from flowlens.operators.cleaning import derived_once, labelled
from flowlens.operators.evaluation import class_weights
from flowlens.session import shared_dir, written

SEED = 42
WEIGHT = "class_weight"


def random_forest(trees: int = 20, **params) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=LABEL_INDEX, featuresCol="features", numTrees=trees, seed=SEED, **params
    )


def boosted_trees(rounds: int = 10, **params) -> GBTClassifier:
    """For two labels only."""
    return GBTClassifier(
        labelCol=LABEL_INDEX, featuresCol="features", maxIter=rounds, seed=SEED, **params
    )


@dataclass(frozen=True)
class Trained:
    bundle: ModelBundle
    train: DataFrame
    test: DataFrame


def with_class_weight(df: DataFrame) -> DataFrame:
    """Add a weight inverse to the label's frequency.

    There is one weight for each label, in a map literal.
    """
    pairs = [F.lit(x) for row in class_weights(df, LABEL).collect() for x in row]
    return df.withColumn(WEIGHT, F.create_map(*pairs)[F.col(LABEL)])


def train(
    flows: DataFrame, classifier=None, weighted: bool = False, stage: bool = False
) -> Trained:
    """Split labelled flows, fit features on the training part alone, then the classifier.

    ``flows`` carry the feature columns. Rows that cannot be assembled take no part. Fitting
    reads them several times; ``stage`` writes them to a table first, dealt out by their keys, for
    flows that would be parsed from text each time.
    """
    shared_dir(flows.sparkSession)  # long tree lineages are cut by checkpoints in it
    classifier = classifier or boosted_trees()
    usable = labelled(derived_once(flows) if stage else flows).where(assemblable())
    if stage:
        usable = written(usable.repartition(flow_key(usable)), "training")
    train_rows, test_rows = train_test_split(usable)
    words = vocabularies(train_rows, [*CATEGORIES, LABEL])
    if weighted:
        train_rows = with_class_weight(train_rows)
        classifier = classifier.copy().setWeightCol(WEIGHT)
    features = fit_features(train_rows, words)
    ready = label_indexer(words[LABEL]).transform(features.transform(train_rows))
    columns = [LABEL_INDEX, "features", *([WEIGHT] if weighted else [])]
    # Vectors are written once: the trees keep their own binned copy of them.
    model = classifier.fit(written(ready.select(*columns), "training-vectors"))
    return Trained(ModelBundle.of(features, model, words[LABEL]), train_rows, test_rows)


def evaluate(bundle: ModelBundle, rows: DataFrame) -> dict[str, float]:
    """Accuracy, weighted F1 and, for two labels, the area under the ROC curve.

    Rows whose label the model has not seen are left out; ``left_out`` is their number.
    """
    seen = F.coalesce(F.col(LABEL).isin(bundle.labels), F.lit(False))
    scored = label_indexer(bundle.labels).transform(bundle.pipeline.transform(rows.where(seen)))
    scored = written(scored.select(LABEL_INDEX, "prediction", "rawPrediction"), "evaluated")
    left_out = float(rows.where(~seen).count())
    return judged(scored, len(bundle.labels) == 2) | {"left_out": left_out}


def judged(scored: DataFrame, binary: bool) -> dict[str, float]:
    """Metrics of scored rows (label_index, prediction, rawPrediction); the area is exact."""
    judge = MulticlassClassificationEvaluator(labelCol=LABEL_INDEX)
    result = {name: judge.setMetricName(name).evaluate(scored) for name in ("accuracy", "f1")}
    if binary:
        area = BinaryClassificationEvaluator(labelCol=LABEL_INDEX, numBins=0)
        result["auc"] = area.evaluate(scored)
    return result


def importance_table(bundle: ModelBundle, spark) -> DataFrame:
    return spark.createDataFrame(bundle.importances(), "feature string, importance double")
