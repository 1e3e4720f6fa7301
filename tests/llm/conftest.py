from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
for folder in (ROOT, ROOT / "tools"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from cases import SCHEMA, texts  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with every odd case, over several partitions."""
    rows = [(i, t, "en", "s", len(t or ""), *(["?"] * 8)) for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "lang", "doc_id")


@pytest.fixture(scope="session")
def plain(spark):
    """Documents with unique ids."""
    seen, rows = set(), []
    for i, t in texts():
        if i is not None and i not in seen:
            seen.add(i)
            rows.append((i, t, "en", "s", len(t or ""), *(["?"] * 8)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
