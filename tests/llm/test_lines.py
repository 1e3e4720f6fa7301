from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from check_oracles import compare, connect
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import lines

from cases import SMALL, ordered, texts


def plain(rows, min_docs, min_chars=1, keep_first=False):
    seen = Counter()
    for _, text in rows:
        seen.update({lines.key(x) for x in text.encode().split(b"\n")})
    out, met = [], set()
    for i, text in rows:
        kept, n = [], 0
        for line in text.encode().split(b"\n"):
            name = lines.key(line)
            shared = len(name.decode()) >= min_chars and name and seen[name] >= min_docs
            if not shared or keep_first and name not in met:
                kept.append(line)
            met.add(name)
            n += 1
        left = b"\n".join(kept)
        out.append((str(i), n, n - len(kept), hashlib.sha256(left).hexdigest(), left.decode()))
    return sorted(out)


def rows_of(found):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256, r.text) for r in found.collect())


@pytest.mark.parametrize("chunk", [500, 8 << 20])
def test_shared_lines_go(docs, chunk):
    found = lines.drop_lines(docs, min_docs=2, with_text=True, chunk_bytes=chunk)
    want = plain(ordered(texts()), 2)
    assert sum(x[2] for x in want) > 3
    assert rows_of(found) == want


def test_filters_that_suspect_everything_change_nothing(docs, monkeypatch):
    def all_suspected(group):
        sizes = [len(lines.grow(x, 2)[0]) for x in group.column("keys").to_pylist()]
        masks = [np.packbits(np.ones(n, bool)).tobytes() for n in sizes]
        out = group.select(["chunk", "slice"]).append_column("size", pa.array(sizes, pa.int32()))
        return out.append_column("mask", pa.array(masks, pa.binary()))

    monkeypatch.setattr(lines, "SLICE", 3)  # many slices
    monkeypatch.setattr(lines, "_suspected", all_suspected)
    found = lines.drop_lines(docs, min_docs=2, with_text=True, chunk_bytes=700)
    assert rows_of(found) == plain(ordered(texts()), 2)


def test_filters_miss_nothing_and_suspect_little():
    r = np.random.default_rng(1)
    keys = [np.unique(r.integers(0, 1 << 32, 20_000)) for _ in range(4)]
    keys[3] = np.unique(np.concatenate([keys[3][5000:], keys[0][:500]]))
    blobs = [lines.shrink(np.diff(k, prepend=0), np.arange(len(k))) for k in keys]
    flags = [np.zeros(len(k), bool) for k in keys]
    flags[1][7] = True
    group = pa.table(
        {
            "slice": pa.array([0] * 4, pa.int32()), "chunk": pa.array(range(4), pa.int64()),
            "keys": pa.array(blobs, pa.binary()),
            "twice": pa.array([np.packbits(f).tobytes() for f in flags], pa.binary()),
        }
    )
    found = lines._suspected(group)
    count = Counter(k for own in keys for k in own.tolist())
    wrong = 0
    for own, flag, mask, n in zip(keys, flags, found.column("mask").to_pylist(), found.column("size").to_pylist()):
        mask = np.unpackbits(np.frombuffer(mask, np.uint8), count=n).astype(bool)
        truth = np.array([count[k] > 1 for k in own.tolist()]) | flag
        assert mask[truth].all()
        wrong += int((mask & ~truth).sum())
    assert wrong < 0.05 * sum(map(len, keys))


def test_first_lines_stay(plain_rows, spark):
    docs = spark.createDataFrame(plain_rows, "doc_id long, text string").repartition(3)
    found = lines.drop_lines(docs, 2, keep_first=True, with_text=True, chunk_bytes=300)
    assert rows_of(found) == plain(ordered(plain_rows), 2, keep_first=True)


@pytest.fixture
def plain_rows():
    rows = [(k, f"Shared Line\n own {k}\n\nSHARED line  \nlast {k % 3}") for k in range(-4, 20)]
    return rows + [(50, None), (51, ""), (52, "\n"), (53, " shared line\r")]


def test_short_keys_stay(plain_rows, spark):
    docs = spark.createDataFrame(plain_rows, "doc_id long, text string")
    found = lines.drop_lines(docs, 2, min_chars=8, with_text=True)
    assert rows_of(found) == plain(ordered(plain_rows), 2, min_chars=8)


def test_no_rows(no_docs):
    assert lines.drop_lines(no_docs).count() == 0
    with pytest.raises(ValueError):
        lines.drop_lines(no_docs, min_docs=1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"\n", b"bb", b"\r"])), st.integers(1, 4))
def test_long_texts_split_alike(parts, size):
    text, part = b"".join(parts), lines._PART
    try:
        lines._PART = size
        assert list(lines.split(text)) == text.split(b"\n")
    finally:
        lines._PART = part


def test_a_very_long_text(spark):
    text = "\n".join(f"line {k % 50_000}" for k in range(300_000))
    docs = spark.createDataFrame([(1, text), (2, "x\nline 7")], "doc_id long, text string")
    found = rows_of(lines.drop_lines(docs, 2, with_text=True))
    assert found == plain([(1, text), (2, "x\nline 7")], 2)


def test_as_in_sql(spark):
    assert compare(spark, connect(SMALL), SMALL, "op12_line_repeats") is None
