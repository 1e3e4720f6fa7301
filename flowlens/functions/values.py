"""Column expressions that type and test raw flow values.

All of them yield NULL for a bad value, also under ANSI mode, where a plain cast would fail.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlens.schema import MALICIOUS, UNKNOWN


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def without_dash(value: Column | str) -> Column:
    """NULL for ``-``, the mark of a missing value.

    A cast would give NULL as well, but parsing text that is no number is slow, and in many
    logs most values are missing.
    """
    return F.nullif(as_column(value), F.lit("-"))


def to_double(value: Column | str) -> Column:
    return without_dash(value).try_cast("double")


def to_long(value: Column | str) -> Column:
    """Text to long; a decimal text such as ``12.7`` is truncated to 12."""
    value = without_dash(value)
    return F.coalesce(value.try_cast("long"), value.try_cast("double").try_cast("long"))


def to_port(value: Column | str) -> Column:
    """Port as int; NaN and out-of-range numbers give NULL."""
    return as_column(value).try_cast("int")


def text_or_null(value: Column | str) -> Column:
    """NULL for the text that the JSON token ``NaN`` leaves in a string field."""
    return F.nullif(as_column(value), F.lit('"NaN"'))


def is_malicious(label: Column | str = "label") -> Column:
    """Label contains the word; NULL for a NULL label, so its negation skips NULL as well."""
    return as_column(label).contains(MALICIOUS)


def label_of(prediction: Column | str, labels: list[str]) -> Column:
    """Text for a predicted class index; ``labels`` come from the fitted label index."""
    prediction = as_column(prediction)
    index = prediction.try_cast("int")
    names = F.array(*[F.lit(name) for name in labels])
    known = F.when(index == prediction, F.get(names, index))
    return F.coalesce(known, F.lit(UNKNOWN))
