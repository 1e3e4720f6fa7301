"""Projections that turn parsed records into typed flows with features."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions import features as X
from flowlens.functions.values import is_malicious, to_double, to_long, to_port
from flowlens.schema import MEASURES, TABLE_NAMES


def rename_fields(df: DataFrame) -> DataFrame:
    """Replace wire names with table names."""
    return df.withColumnsRenamed(TABLE_NAMES)


def cast_measures(df: DataFrame) -> DataFrame:
    types = {"duration": to_double, "orig_bytes": to_long, "resp_bytes": to_long}
    return df.withColumns({c: typed(c) for c, typed in types.items() if c in df.columns})


def add_ports(df: DataFrame) -> DataFrame:
    ports = {"orig_port": "orig_p", "resp_port": "resp_p"}
    return df.withColumns({name: to_port(c) for name, c in ports.items() if c in df.columns})


def fill_measures(df: DataFrame) -> DataFrame:
    """Missing measures count as 0; a NaN duration does too."""
    return df.fillna(0, subset=[c for c in MEASURES if c in df.columns])


def clean(df: DataFrame) -> DataFrame:
    """Type the measures, add integer ports, fill missing measures with 0.

    Of flows that lack some fields, those that are there.
    """
    return fill_measures(add_ports(cast_measures(df)))


def add_ip_aliases(df: DataFrame) -> DataFrame:
    return df.withColumns({"orig_ip": F.col("orig_h"), "resp_ip": F.col("resp_h")})


def labelled(df: DataFrame) -> DataFrame:
    return df.where(F.col("label").isNotNull())


def derived_once(df: DataFrame) -> DataFrame:
    """The same rows; a later filter does not derive its columns a second time.

    The optimizer moves a filter below projections, where it repeats all that its columns are made
    of, in one generated method that is too long for the JVM to compile. It does not move one past
    an inlined array of one. All columns are computed, so this is for rows that are written whole.
    """
    return df.select(F.inline(F.array(F.struct("*"))))


def malicious(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(is_malicious(label))


def not_malicious(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows with another label; rows without a label are in neither part."""
    return df.where(~is_malicious(label))


def add_features(df: DataFrame, epsilon: float = X.RATE_EPSILON) -> DataFrame:
    """Add time and traffic features; only projections, so batch and stream share it.

    Of flows that lack some fields, the features whose inputs are there.
    """
    steps = [
        {"timestamp": X.epoch_to_time("ts"), "total_bytes": X.total_bytes()},
        {
            "hour_of_day": X.hour_of_day(),
            "day_of_week": X.day_of_week(),
            "bytes_per_sec": X.bytes_per_sec(epsilon=epsilon),
        },
    ]
    for step in steps:
        there = {c: x for c, x in step.items() if set(FEATURE_INPUTS[c]) <= set(df.columns)}
        df = df.withColumns(there)
    return df


# What each derived column is made of.
FEATURE_INPUTS = {
    "timestamp": ["ts"], "total_bytes": ["orig_bytes", "resp_bytes"],
    "hour_of_day": ["timestamp"], "day_of_week": ["timestamp"],
    "bytes_per_sec": ["total_bytes", "duration"],
    "orig_port": ["orig_p"], "resp_port": ["resp_p"],
}


def fields_for(columns: Iterable[str]) -> list[str]:
    """The fields of a record that columns of featured flows are made of."""
    found = set()
    for c in columns:
        found |= set(fields_for(FEATURE_INPUTS[c])) if c in FEATURE_INPUTS else {c}
    return sorted(found)


def add_bytes_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("orig_bytes_ratio", X.orig_bytes_ratio())


def evaluable(df: DataFrame, actual: str = "label", predicted: str = "predicted_label") -> DataFrame:
    """Rows on which a prediction can be judged."""
    return df.dropna(subset=[actual, predicted])
