from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from flowlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


FLOW = (
    "uid string, ts double, orig_h string, orig_p double, resp_h string, resp_p double, "
    "proto string, duration string, orig_bytes string, resp_bytes string, conn_state string, "
    "label string, detailed_label string"
)


@pytest.fixture(scope="session")
def make_flows(spark):
    """Parsed flows from partial records; what a record leaves out takes a plain value."""
    plain = dict(
        ts=1526756261.8665, orig_h="10.0.0.1", orig_p=40000.0, resp_h="10.1.0.1", resp_p=22.0,
        proto="tcp", duration="1.5", orig_bytes="10", resp_bytes="20", conn_state="SF",
        label="Benign", detailed_label="-",
    )

    def make(*records: dict):
        names = ["uid", *plain]
        rows = [
            tuple({"uid": f"C{i}", **plain, **record}[n] for n in names)
            for i, record in enumerate(records)
        ]
        return spark.createDataFrame(rows, FLOW)

    return make


@pytest.fixture(scope="session")
def make_predictions(spark):
    """Predictions from (uid, time text, label, predicted label)."""

    def make(*rows: tuple):
        df = spark.createDataFrame(
            list(rows), "uid string, t string, label string, predicted_label string"
        )
        return df.selectExpr(
            "uid", "cast(t as timestamp) as processing_time", "label", "predicted_label"
        )

    return make
