"""Connectors are not installed here; the calls must still reach them with the right name."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from flowlens.sources.topics import encode, read_topic, stream_topic, write_topic
from flowlens.streaming.sinks import Batch, document_writer

ADDRESS = {"servers": "host:9092", "topic": "flows"}


@pytest.mark.parametrize("read", [read_topic, stream_topic])
def test_kafka_source(spark, read):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read(spark, **ADDRESS)


def test_limited_kafka_stream(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        stream_topic(spark, **ADDRESS, starting="earliest", per_trigger=5000, partitions=4)


def test_kafka_sink(spark, make_flows):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        write_topic(encode(make_flows({})), **ADDRESS)


def test_document_sink(spark, make_flows):
    write = document_writer("mongodb://host", "flows", "predictions")
    with pytest.raises(Exception, match="(?i)mongodb"):
        write(make_flows({}), "unused", Batch("q", 0))
