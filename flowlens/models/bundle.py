"""One saved unit for scoring: features, classifier and label decoding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.models.features import CATEGORIES, assemblable, feature_names


@dataclass(frozen=True)
class ModelBundle:
    """A fitted feature pipeline, a classifier and an ``IndexToString`` in one pipeline."""

    pipeline: PipelineModel

    @classmethod
    def of(cls, features: PipelineModel, classifier, labels: list[str]) -> ModelBundle:
        decode = IndexToString(
            inputCol="prediction", outputCol="predicted_label", labels=labels
        )
        return cls(PipelineModel(stages=[*features.stages, classifier, decode]))

    @property
    def features(self) -> PipelineModel:
        return PipelineModel(stages=self.pipeline.stages[:-2])

    @property
    def classifier(self):
        return self.pipeline.stages[-2]

    @property
    def labels(self) -> list[str]:
        return self.pipeline.stages[-1].getLabels()

    @property
    def feature_names(self) -> list[str]:
        indexers = self.pipeline.stages
        return feature_names({c: list(indexers[i].labels) for i, c in enumerate(CATEGORIES)})

    def score(self, df: DataFrame, handle_invalid: str = "error") -> DataFrame:
        """Add prediction, probability (array) and predicted label, in batch or on a stream.

        ``handle_invalid`` is the assembler's: an error for a missing input, or ``keep``.
        """
        pipeline = self.pipeline
        if handle_invalid != "error":
            stages = [
                s.copy({s.handleInvalid: handle_invalid}) if isinstance(s, VectorAssembler) else s
                for s in pipeline.stages
            ]
            pipeline = PipelineModel(stages=stages)
        scored = pipeline.transform(df)
        return scored.withColumn("probability", vector_to_array("probability"))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> ModelBundle:
        return cls(PipelineModel.load(path))

    def importances(self) -> list[tuple[str, float]]:
        """Feature names with their importance, in vector order."""
        values = self.classifier.featureImportances.toArray()
        return [(name, float(v)) for name, v in zip(self.feature_names, values)]


def score_all(df: DataFrame, bundle: ModelBundle) -> DataFrame:
    """Score every row in one pass: one that lacks an input gets NULLs and a ``reason``.

    The assembler passes missing inputs on as NaN, which trees accept; what the model makes of such
    a row is not given.
    """
    reason = F.when(~assemblable(), "incomplete")
    scored = bundle.score(df.withColumn("reason", reason), handle_invalid="keep")
    given = F.col("reason").isNull()
    out = ("prediction", "probability", "predicted_label")
    return scored.withColumns({c: F.when(given, F.col(c)) for c in out})
