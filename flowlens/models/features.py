"""Feature vectors for the classifiers."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.session import written

# The order of the parts of a feature vector.
NUMERIC = [
    "duration", "orig_bytes", "resp_bytes", "orig_port", "resp_port", "total_bytes",
    "bytes_per_sec", "hour_of_day", "day_of_week",
]
CATEGORIES = ["proto", "conn_state"]
INDEXES = [f"{c}_index" for c in CATEGORIES]
VECTORS = [f"{c}_vec" for c in CATEGORIES]
LABEL, LABEL_INDEX = "label", "label_index"


def assemblable() -> Column:
    """True if no numeric input of the feature vector is missing.

    Only these columns need a look: cleaning fills the measures, hour and day come from the
    timestamp, and the rate is missing whenever the byte total is.
    """
    needed = ["timestamp", "orig_port", "resp_port", "bytes_per_sec"]
    return reduce(and_, [F.col(name).isNotNull() for name in needed])


def split_assemblable(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows fit for scoring, and the rest for quarantine."""
    return df.where(assemblable()), df.where(~assemblable())


def vocabularies(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Values of each column, most frequent first, ties by value, from one scan. Runs a job.

    NULL has no place in a vocabulary. Empty text is a value of the label, but none of the other
    columns, as a slot of the feature vector needs a name.
    """
    values = [F.col(c) if c == LABEL else F.nullif(F.col(c), F.lit("")).alias(c) for c in columns]
    indexer = StringIndexer(inputCols=columns, outputCols=[f"{c}_value" for c in columns])
    found = indexer.setStringOrderType("frequencyDesc").fit(df.select(*values)).labelsArray
    return {c: list(labels) for c, labels in zip(columns, found)}


def category_indexers(words: dict[str, list[str]]) -> list[StringIndexerModel]:
    """Indexes of protocol and state; an unseen or NULL value gets the last index."""
    return [
        StringIndexerModel.from_labels(
            words[c], inputCol=c, outputCol=f"{c}_index", handleInvalid="keep"
        )
        for c in CATEGORIES
    ]


def label_indexer(labels: list[str]) -> StringIndexerModel:
    """Index of the label, for training and evaluation only; an unseen label is an error."""
    return StringIndexerModel.from_labels(
        labels, inputCol=LABEL, outputCol=LABEL_INDEX, handleInvalid="error"
    )


def encoder() -> OneHotEncoder:
    """One slot per known value; the invalid index has the dropped slot, a zero vector."""
    return OneHotEncoder(inputCols=INDEXES, outputCols=VECTORS)


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=NUMERIC + VECTORS, outputCol="features_raw")


def scaler() -> StandardScaler:
    return StandardScaler(
        inputCol="features_raw", outputCol="features", withMean=True, withStd=True
    )


def fit_encoding(df: DataFrame) -> PipelineModel:
    """Category indexes and one-hot vectors, without assembly and scaling."""
    words = vocabularies(df, CATEGORIES)
    return Pipeline(stages=[*category_indexers(words), encoder()]).fit(df)


def fit_features(df: DataFrame, words: dict[str, list[str]] | None = None) -> PipelineModel:
    """The whole feature pipeline; it needs no label, so it also serves unlabelled flows.

    Without ``words``, two passes over ``df`` follow, so its inputs are written once before.
    """
    if words is None:
        df = written(df.select(*NUMERIC, *CATEGORIES), "feature-inputs")
        words = vocabularies(df, CATEGORIES)
    stages = [*category_indexers(words), encoder(), assembler(), scaler()]
    return Pipeline(stages=stages).fit(df)


def feature_names(words: dict[str, list[str]]) -> list[str]:
    """Name of each slot of the feature vector."""
    return NUMERIC + [f"{c}={value}" for c in CATEGORIES for value in words[c]]
