from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import alignment

from cases import texts

ODD = [
    (100, " lead"), (101, "a  b   c \n d"), (102, "x\n\n y "), (103, "　a b"), (104, " "), (105, "\n"),
    (106, "one ▁ sign"), (107, "<s> </s> <unk> <|endoftext|> <0x41>"), (-3, "negative id"),
    (108, "中文字符没有空格" * 40), (109, "é́ ﬁ x　 y\x85z"),
]


def plain(rows):
    """Tokens of whole texts by the libraries, all pairs tried within each group."""
    both = alignment.sides()
    per = []
    for i, text in rows:
        a = both.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = both.b.encode(text) if text else []
        own = [[names[x] for x in ids] for names, ids in ((both.a_bytes, a), (both.b_bytes, b))]
        if not text or any(b"".join(x) != b" " + text.encode() for x in own):
            per.append((i, None))
            continue
        spans = []
        for x in own:
            ends = np.cumsum([len(t) for t in x]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        links, groups = [], []
        for start, end in zip([0, *cuts], cuts):
            left, right = ([k for k, (x, y) in enumerate(s) if start <= x and y <= end] for s in spans)
            groups.append(",".join(str(a[k]) for k in left) + "|" + ",".join(str(b[k]) for k in right))
            links += [
                (a[x], b[y]) for x in left for y in right
                if max(spans[0][x][0], spans[1][y][0]) < min(spans[0][x][1], spans[1][y][1])
            ]
        per.append((i, (len(a), len(b), len(groups), links, ";".join(groups))))
    count = Counter(link for _, x in per if x for link in x[3])
    best: dict[int, int] = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, x in per:
        if x is None:
            out.append((str(i), 0, 0, 0, 0, 0, 0, "", ""))
            continue
        n_a, n_b, n_groups, links, text = x
        top = sum(count[link] == best[link[1]] for link in links)
        total = sum(count[link] for link in links)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.append((str(i), n_a, n_b, n_groups, len(links), top, total, digest, text))
    return sorted(out)


def rows_of(found):
    return sorted(
        (str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.groups)
        for r in found.collect()
    )


@pytest.mark.parametrize("chunk", [2500, 8 << 20])
def test_tokens_are_aligned(spark, chunk):
    rows = texts() + ODD
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, pair string")
    found = alignment.align_documents(docs.repartition(3), with_groups=True, chunk_bytes=chunk)
    assert rows_of(found) == plain([(i, t or "") for i, t in rows])


def test_no_rows(no_docs):
    assert alignment.align_documents(no_docs).count() == 0


def ends(draw, total):
    inner = draw(st.lists(st.integers(1, max(1, total - 1)), max_size=total, unique=True))
    return np.array(sorted({x for x in inner if x < total} | {total}))


@st.composite
def two_lists(draw):
    total = draw(st.integers(1, 60))
    return ends(draw, total), ends(draw, total), draw(st.integers(1, 9))


@settings(max_examples=300, deadline=None)
@given(two_lists())
def test_pieces_of_a_merge_are_independent(case):
    a, b, steps = case
    left, right, a_cut, b_cut = alignment.merge(a, b, steps)
    spans = [list(zip([0, *x.tolist()], x.tolist())) for x in (a, b)]
    want = [
        (i, j) for i, (p, q) in enumerate(spans[0]) for j, (r, s) in enumerate(spans[1])
        if max(p, r) < min(q, s)
    ]
    assert sorted(zip(left.tolist(), right.tolist())) == sorted(want)
    shared = sorted(set(a.tolist()) & set(b.tolist()))
    assert [(a.tolist().index(e) + 1, b.tolist().index(e) + 1) for e in shared] == list(
        zip(a_cut.tolist(), b_cut.tolist())
    )
    i, j = alignment.borders(a, b, steps)
    order = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
    assert i.tolist() == [sum(s == 0 for _, s in order[:d]) for d in range(0, len(order), steps)]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n\t.'　é中\x1c\x85▁"), max_size=40), st.integers(1, 9))
def test_segments_are_those_of_the_whole(text, part):
    both, saved = alignment.sides(), alignment._PART
    try:
        alignment._PART = part
        parts = [p for x in alignment.segments(text) for p in x]
    finally:
        alignment._PART = saved
    assert " ".join(parts) == text
    if not text:
        return
    a, b = both.ids(parts)
    assert sum(a, []) == both.a.encode(" " + text, add_special_tokens=False).ids
    if "▁" not in text:
        assert sum(b, []) == both.b.encode(text)


def test_a_very_long_text(spark):
    text = " ".join(f"word{k % 9000}x" for k in range(900_000))
    docs = spark.createDataFrame([(1, text), (2, "word7x y")], "doc_id long, text string")
    found = {r.doc_id: r for r in alignment.align_documents(docs).collect()}
    want = alignment.sides().a.encode(" " + text, add_special_tokens=False).ids
    assert found[1].n_a == len(want) and found[1].n_groups >= 900_000
    assert found[2].count_sum > 0
