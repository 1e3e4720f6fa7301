"""Timed scoring of flow records at rest."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.models.bundle import ModelBundle, score_all
from flowlens.operators.cleaning import add_features, clean


def score_flows(flows: DataFrame, bundle: ModelBundle) -> DataFrame:
    """Parsed flows to predictions, one row for each; labels play no part.

    A flow that lacks an input has no prediction, and ``reason`` says so; for others it is NULL.
    """
    return score_all(add_features(clean(flows)), bundle)


def count_predictions(scored: DataFrame) -> DataFrame:
    """Flows per prediction; those without one are counted under NULL."""
    return scored.groupBy("prediction").agg(F.count("*").alias("count")).orderBy("prediction")


def timed_scoring(flows: DataFrame, bundle: ModelBundle) -> tuple[list, float]:
    """Counts per prediction, and the seconds taken to read, score and count."""
    begin = time.perf_counter()
    counts = count_predictions(score_flows(flows, bundle)).collect()
    return counts, time.perf_counter() - begin
