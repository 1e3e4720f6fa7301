from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_oracles import compare, connect  # noqa: E402
from flowlens.catalog.queries import QUERIES  # noqa: E402
from flowlens import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_contract(spark):
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert QUERIES.keys() <= contract.oracle_sql().keys()
    result = contract.entry(spark)
    assert result.columns == ["resp_port", "proto", "malicious_count", "benign_count", "risk_ratio"]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, SMALL, name) is None


def test_no_python_rows_and_no_cross_joins():
    """Core work stays in built-in operators, and no table is collected whole."""
    banned = re.compile(
        r"crossJoin|\.rdd\b|toPandas|localCheckpoint|\bpandas_udf|\budf\(|applyInPandas|mapInPandas"
    )
    for file in (ROOT / "flowlens").rglob("*.py"):
        assert not banned.search(file.read_text()), file


def test_shared_folder_is_the_clusters(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")
    df = session.written(spark.range(3), "t")
    assert df.count() == 3
    assert df.inputFiles()[0].replace("file://", "").startswith(named)
