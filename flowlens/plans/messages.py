"""Flows from messages, parsed as far as a consumer needs them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from flowlens.operators.cleaning import add_features, clean, fields_for
from flowlens.schema import TABLE_NAMES, wire_schema
from flowlens.sources.topics import decode

Consumer = Callable[[DataFrame], DataFrame]


def message_flows(messages: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Featured flows from messages, in batch or as a stream; with ``columns``, only these.

    Fields that no column is made of are not parsed.
    """
    if columns is None:
        return add_features(clean(decode(messages)))
    return add_features(clean(decode(messages, fields_for(columns)))).select(*columns)


def columns_used(consumer: Consumer, spark: SparkSession) -> list[str]:
    """The columns of featured flows that a consumer refers to.

    The consumer is given flows without rows that lack one column after the other: what it cannot
    do without, or what changes its result's columns, it uses. Queries are only analysed, so a
    consumer must not run jobs of its own.
    """
    fields = spark.createDataFrame([], wire_schema()).withColumnsRenamed(TABLE_NAMES)
    types = add_features(clean(fields)).schema
    whole = consumer(spark.createDataFrame([], types)).schema

    def needed(column: str) -> bool:
        others = StructType([f for f in types if f.name != column])
        try:
            return consumer(spark.createDataFrame([], others)).schema != whole
        except AnalysisException:
            return True

    return [c for c in types.names if needed(c)]


def consumed(messages: DataFrame, consumer: Consumer) -> DataFrame:
    """What a consumer makes of the flows in messages, with its own columns alone parsed."""
    return consumer(message_flows(messages, columns_used(consumer, messages.sparkSession)))
