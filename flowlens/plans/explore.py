"""Exploration of cleaned flows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

from flowlens.operators import distributions as D
from flowlens.operators.signatures import port_signatures, rule_texts
from flowlens.session import written


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a table for repeated use, on disk where memory is short; freed at the end."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def explore(flows: DataFrame) -> dict[str, DataFrame]:
    """The exploratory reports.

    Nothing is cached, so the size of the flows does not matter: all counts come from one
    written table of category counts, the other two reports from one scan each.
    """
    counts = written(D.category_counts(flows), "category-counts")
    reports = {
        name: counts.where(counts.dimension == name).drop("dimension", "label")
        for name in ("label", "detailed_label", "proto", "conn_state")
    }
    reports["proto_label"] = counts.where(counts.dimension == "proto_label").drop("dimension")
    reports["statistics"] = D.label_statistics(flows)
    reports["signatures"] = port_signatures(flows)
    reports["rules"] = rule_texts(reports["signatures"])
    return reports
