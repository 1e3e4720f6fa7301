from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from llm import conversations
from llm.queries import damaged

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
KINDS = ["s", "u", "a", "x"]


def plain(codes: bytes) -> tuple[int, str]:
    """Cost and ASCII-least audit by the cheapest way over (turn, last role)."""
    n, never = len(codes), 10**9

    def moves(i, last):
        if i < n:
            kind, fault = KINDS[codes[i] & 3], codes[i] >> 2
            yield "D", 2, (i + 1, last)
        yield "I", 5, (i, NEXT[last])
        if i < n and fault not in (1, 2):
            more = 5 * (fault == 3)
            if kind == NEXT[last] or kind == "s" and last == "":
                yield "K", more, (i + 1, kind)
            yield "R", more + 1, (i + 1, NEXT[last])

    cost = {(i, s): never for i in range(n + 1) for s in NEXT}
    cost[n, ""] = cost[n, "a"] = 0
    for i in range(n, -1, -1):
        for _ in range(4):
            for s in NEXT:
                cost[i, s] = min(cost[i, s], *(c + cost[to] for _, c, to in moves(i, s)))
    at, audit = (0, ""), []
    while at[0] < n or at[1] not in ("", "a"):
        letter, _, at = min(m for m in moves(*at) if m[1] + cost[m[2]] == cost[at])
        audit.append(letter)
    return cost[0, ""], "".join(audit)


@pytest.mark.parametrize("block", [1, 3, 7, conversations.BLOCK])
def test_audits_are_the_cheapest(block):
    r = random.Random(block)
    for size in [r.randrange(0, 12) for _ in range(500)] + [r.randrange(20, 70) for _ in range(25)] + [300]:
        hard, faults = r.random(), r.random() * 0.6
        codes = bytes(
            (r.choice([0, 1, 1, 1, 2, 2, 2, 3]) if r.random() < hard else 1 + k % 2)
            | (r.choice([0, 1, 2, 3]) if r.random() < faults else 0) << 2
            for k in range(size)
        )
        assert conversations.align(codes, block) == plain(codes)


def expected(rows):
    """All columns for damaged rows, by the statement of the query."""
    all_turns: dict = {}
    for conv, turn, role, text in rows:
        own = all_turns.setdefault(conv, [])
        name = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    out = []
    for conv, own in all_turns.items():
        digest = lambda x: hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), digest(x)))
        seen, faults, codes = set(), [], []
        for _, role, text in own:
            end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            faults.append(1 if not end else 2 if (role, text) in seen else 0 if end in ".!?" else 3)
            seen.add((role, text))
            codes.append((KINDS.index(role[0]) if role[:1] in ("s", "u", "a") else 3) | faults[-1] << 2)
        cost, audit = plain(bytes(codes))
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        repaired, at, last = [], iter(own), ""
        for edit in audit:
            role, text = "assistant" if last == "u" else "user", ""
            if edit != "I":
                _, old, text = next(at)
                role = old if edit == "K" else role
            if edit != "D":
                repaired.append(f"{role}:{text}")
                last = role[0]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in repaired))
        digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        counts = [faults.count(k) for k in (1, 2, 3)]
        out.append((str(conv), gaps, *counts, illegal, cost, audit, digest, repaired))
    return sorted(out)


def turns_of(seed=5):
    r = random.Random(seed)
    rows = []
    for conv in [None, -2, *range(50)]:
        for k in range(700 if conv == 7 else r.randrange(1, 9)):
            role = ["user", "assistant"][k % 2]
            if r.random() < 0.3:
                role = r.choice(["user", "assistant", "system", "tool", None, "ux", ""])
            text = r.choice(
                ["ok.", "Fine!", "  \t\n", "no end", "a?  \n", "\x0b", None, "", "é.", f"text {k}.", "x." * 500]
            )
            rows.append((conv, r.choice([k, k, k, k, k + 3, None]), role, text))
    return rows + rows[:40]


SCHEMA = "conv_id long, turn long, role string, text string, part string, codes string"


@pytest.mark.parametrize("partitions", [1, 6])
def test_conversations_are_repaired(spark, partitions):
    rows = turns_of()
    turns = spark.createDataFrame([(*x, "?", "?") for x in rows], SCHEMA).repartition(partitions)
    found = conversations.repair(damaged(turns), turns, with_turns=True).collect()
    got = sorted(
        (
            str(r.conv_id), r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
            r.repaired_sha256, [f"{t.role}:{t.text}" for t in r.turns],
        )
        for r in found
    )
    assert got == expected(rows)


def test_a_conversation_over_many_partitions(spark):
    """Its turns are coded by several tasks and put together again."""
    rows = [(1, k // 2, ["user", "assistant"][k % 2], f"text {k % 37}.") for k in range(3000)]
    rows += [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    turns = spark.createDataFrame([(*x, "?", "?") for x in rows], SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.conv_id: r for r in conversations.repair(turns).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found[1].gaps == 0 and found[1].duplicate == 3000 - 37 * 2
    assert found[2].audit == "KK" and found[2].cost == 0


def test_no_turns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(none).count() == 0
    ids = spark.createDataFrame([(4,), (4,), (None,)], "conv_id long")
    found = conversations.repair(none, ids).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(i, 0, 0, 0, 0, 0, 0, "", empty) for i in (4, None)], key=str
    )
