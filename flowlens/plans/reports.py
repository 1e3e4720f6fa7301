"""Reports over stored predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators import evaluation as E
from flowlens.operators import timeline as L
from flowlens.operators.distributions import count_by
from flowlens.session import written
from flowlens.sources.predictions import newest, normalise_time, with_predicted_label


def label_distribution(predictions: DataFrame) -> DataFrame:
    """Count per predicted label, most frequent first; NULL is no label."""
    return count_by(predictions.where(F.col("predicted_label").isNotNull()), "predicted_label")


def report(
    predictions: DataFrame, labels: list[str], rows: int | None = None
) -> dict[str, DataFrame]:
    """The dashboard's and the report's tables over all predictions, or the newest ``rows``.

    With ``rows``, runs jobs: those few rows serve several tables, so they are looked up once.
    """
    found = predictions if rows is None else written(newest(predictions, rows), "newest")
    df = with_predicted_label(normalise_time(found), labels)
    tables = {"labels": label_distribution(df)}
    if "processing_time" in df.columns:
        tables["per_minute"] = L.per_bucket(df)
        tables["alert"] = L.alert(df)
        tables["alert_rows"] = L.alert_rows(df)
    if "label" in df.columns:
        known = E.evaluable(df)
        tables["classification"] = E.classification_report(known)
        tables["confusion"] = E.confusion_matrix(known)
    return tables
