from __future__ import annotations

import duckdb
import pyarrow as pa

import __spark_entry__ as contract
import corpus_pipeline
from flowlens.session import written
from llm import packing
from llm.queries import ORACLES

from cases import ordered, texts
from test_text import brute_near, brute_removed


def brute_kept(rows):
    sql = duckdb.connect()
    sql.register("documents", pa.table({"doc_id": list(range(len(rows))), "text": [t for _, t in rows]}))
    kept = {r[0] for r in sql.sql(f"SELECT doc_id FROM ({ORACLES['op9_quality_rules']}) WHERE kept").fetchall()}
    return [r for k, r in enumerate(rows) if k in kept]


def test_stages_equal_a_plain_version(spark, docs, no_docs):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "repeats_removed", "packed"]
    now, results = docs, []
    for name, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, ""), name)
        results.append(now)
    assert all(r.columns == docs.columns for r in results[:3])
    rows = ordered(brute_kept(texts()))
    texts_of = lambda df: sorted((str(r.doc_id), r.text or "") for r in df.collect())
    assert texts_of(results[0]) == sorted((str(i), t) for i, t in rows)
    rows = [r for r, mark in zip(rows, brute_near(rows)) if mark[3]]
    assert texts_of(results[1]) == sorted((str(i), t) for i, t in rows)
    left = [(x[0], x[5].decode("utf-8", "ignore")) for x in brute_removed(rows)]
    assert texts_of(results[2]) == sorted(left)
    assert all(r.n_chars == len(r.text) for r in results[2].collect())
    total = sum(r.length for r in results[3].collect())
    want = packing.pieces(results[2]).agg({"length": "sum"}).first()[0]
    assert total == want and results[3].where("piece = 0").count() == len(rows)
    now = no_docs
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, "")
        assert now.count() == 0


def test_registered():
    names = contract.queries()
    assert corpus_pipeline.ORACLE_SQL is None and names["pipeline"] is corpus_pipeline.run
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
