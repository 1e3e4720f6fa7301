"""Conversations repaired at the least cost, by aligning their turns to an alternating target.

A repaired conversation has roles ``s?(ua)+`` by their initials, or no turns. Turns are kept (0),
given the role user or assistant (1) or deleted (2), which blank and repeated ones must be; empty
turns are inserted (5); a truncated turn that is not deleted costs 5 more.

Targets of all lengths with the same last role agree from the end on, so one Wagner-Fischer table
over (turns left, roles left) holds the alignments to each feasible length, and a second one those
that still need the system turn. A path of a given cost strays from the diagonal by half of it in
deletions and a fifth in insertions: tables are made in a band for an incumbent cost, which is
doubled until the best of all lengths is within it. Each length that attains it is backtraced to its
ASCII-least audit, and the audits are compared.

Turns become one byte each before they are put together by conversation. They are dealt out by
range of (conversation, turn), so that a large conversation is shared by many tasks; a conversation
is aligned block by block. Texts are hashed as a stream in order and never gathered.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.session import written

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Turns aligned at a time.
BLOCK = 256
_SYSTEM, _USER, _ASSISTANT = 0, 1, 2
#: What came last: nothing, the system turn, a user's, an assistant's.
_START, _S, _U, _A = 0, 1, 2, 3
_NEVER = 1 << 28
_BLANK = " \t\n\x0b\x0c\r"


class Table:
    """Costs of aligning a block's last turns to the last roles of targets that end with ``last``.

    Row i of ``plain`` is over the roles left from ``wanted[i] - below`` on, where ``wanted`` counts
    the turns left that need not be deleted; ``system`` is the same with a system turn to come first.
    """

    def __init__(self, codes: np.ndarray, last: int, limit: int):
        self.codes, self.last = codes, last
        self.below, self.width = limit // DELETE, limit // DELETE + limit // INSERT + 1
        n = len(codes)
        fault = codes >> 2
        forced = (fault == 1) | (fault == 2)
        self.wanted = np.append(np.cumsum(~forced[::-1])[::-1], 0)
        steps = INSERT * np.arange(self.width)
        self.plain = np.full((n + 1, self.width), _NEVER, np.int64)
        self.system = np.full((n + 1, self.width), _NEVER, np.int64)
        self.plain[n, self.below :] = steps[: self.width - self.below]
        even = (np.arange(self.width) - self.below) % 2 == 0
        user = [even if last == _A else ~even]  # whether a user's turn is next, by parity of wanted
        user.append(~user[0])
        wrong = [[REROLE * (u if k == _ASSISTANT else ~u if k == _USER else np.ones_like(u)) for u in user] for k in range(4)]
        for i in range(n - 1, -1, -1):
            after, later = self.plain[i + 1], self.system[i + 1]
            row, first = self.plain[i], self.system[i]
            if forced[i]:
                base = after + DELETE
                first[:] = later + DELETE
            else:
                kind, more = int(codes[i] & 3), TRUNCATED * (fault[i] == 3)
                base = after + wrong[kind][self.wanted[i] % 2] + more
                np.minimum(base[:-1], after[1:] + DELETE, out=base[:-1])
                first[:-1] = later[1:] + DELETE
                if kind == _SYSTEM:
                    np.minimum(first[:-1], after[1:] + more, out=first[:-1])
                none = self.below - self.wanted[i]
                if none >= 0:  # no role left: every turn goes
                    base[:none] = _NEVER
                    first[:none] = _NEVER
                    if none < self.width:
                        base[none] = after[none + 1] + DELETE if none + 1 < self.width else _NEVER
            row[:] = np.minimum.accumulate(base - steps) + steps
        np.minimum(self.plain, _NEVER, out=self.plain)
        np.minimum(self.system, _NEVER, out=self.system)

    def cost(self, i: int, left: int, system: bool = False) -> int:
        at = left - int(self.wanted[i]) + self.below
        if left < 0 or not 0 <= at < self.width:
            return _NEVER
        return int((self.system if system else self.plain)[i, at])

    def user_next(self, left: int) -> bool:
        return (left % 2 == 0) == (self.last == _A)

    def lengths(self, state: int) -> list[tuple[int, int, bool]]:
        """(cost, roles, system first) of each target in the band that may follow ``state``."""
        out = []
        for left in range(max(0, int(self.wanted[0]) - self.below), int(self.wanted[0]) + self.width - self.below):
            if left and self.user_next(left) == (state != _U):
                out.append((self.cost(0, left), left, False))
                if state == _START and self.user_next(left):
                    out.append((self.cost(0, left, True), left, True))
            elif left == 0 and state == self.last:
                out.append((self.cost(0, 0), 0, False))
        return [x for x in out if x[0] < _NEVER]

    def audit(self, left: int, system: bool) -> str:
        """The ASCII-least edits of one target: D before I before K before R."""
        i, n, out = 0, len(self.codes), []
        while i < n or left or system:
            here = self.cost(i, left, system)
            if i < n and self.cost(i + 1, left, system) + DELETE == here:
                out.append("D")
                i += 1
                continue
            if not system and left and self.cost(i, left - 1) + INSERT == here:
                out.append("I")
                left -= 1
                continue
            kind = int(self.codes[i] & 3)
            if system:
                out.append("K")
                system = False
            else:
                out.append("K" if kind == (_USER if self.user_next(left) else _ASSISTANT) else "R")
                left -= 1
            i += 1
        return "".join(out)


def _options(codes: np.ndarray, state: int, ends: tuple[int, ...]):
    """(total cost, exit state, way to the audit) of all targets that may be best.

    ``ends`` are the costs of what follows the block, by what came last.
    """
    fault = codes >> 2
    forced = DELETE * int(((fault == 1) | (fault == 2)).sum())
    whole = DELETE * len(codes)
    least = min(ends)
    limit = 16
    while True:
        out = []
        if state in (_START, _S):  # nothing is added
            out.append((whole + ends[state], state, None))
        for last in (_U, _A):
            if ends[last] >= _NEVER and last == _U:
                continue
            table = _table(codes.tobytes(), last, limit)
            for cost, left, system in table.lengths(state):
                out.append((cost + ends[last], last, (table, left, system)))
            if state == _START and last == _A and ends[_S] < _NEVER:
                cost = table.cost(0, 0, True)
                if cost < _NEVER:
                    out.append((cost + ends[_S], _S, (table, 0, True)))
        best = min(x[0] for x in out)
        if best - least - forced <= limit:
            return best, [x for x in out if x[0] == best]
        limit *= 2


@functools.lru_cache(16)
def _table(codes: bytes, last: int, limit: int) -> Table:
    return Table(np.frombuffer(codes, np.uint8), last, limit)


def _align(codes: np.ndarray, block: int) -> tuple[int, str]:
    blocks = [codes[k : k + block] for k in range(0, len(codes), block)]
    ends = (0, _NEVER, _NEVER, 0)
    behind = []
    for part in reversed(blocks[1:]):
        behind.append(ends)
        ends = tuple(_options(part, state, ends)[0] for state in (_START, _S, _U, _A))
    behind.append(ends)
    state, total, audit = _START, 0, []
    for part, ends in zip(blocks, reversed(behind)):
        best, options = _options(part, state, ends)
        if not audit:
            total = best
        # Of two audits where one goes on with insertions, the next block can insert them as well.
        text, state = min(
            ("D" * len(part) if way is None else way[0].audit(way[1], way[2]), last)
            for _, last, way in options
        )
        audit.append(text)
    return total, "".join(audit)


@functools.lru_cache(1 << 16)
def _short(codes: bytes) -> tuple[int, str]:
    return _align(np.frombuffer(codes, np.uint8), BLOCK)


def align(codes: bytes, block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of a conversation, given one byte for each turn.

    The two low bits are the role (system, user, assistant, other), the next two the fault (none,
    blank, duplicate, truncated).
    """
    if not codes:
        return 0, ""
    if len(codes) <= 64 and block == BLOCK:
        return _short(codes)
    return _align(np.frombuffer(codes, np.uint8), block)


_RUN = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int32()), ("codes", pa.binary()),
        ("least", pa.int64()), ("most", pa.int64()), ("distinct", pa.int64()),
        ("head", pa.int64()), ("tail", pa.int64()),
    ]
)
_RUN_KIND = (
    "conv_id long, part int, codes binary, least long, most long, distinct long, head long, tail long"
)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).fill_null(0).to_numpy(zero_copy_only=False)


class _Runs:
    """Sorted turns as a row for each conversation of a partition."""

    def __init__(self, part: int):
        self.part, self.open, self.out = part, None, []
        self.before = None  # conversation, turn and identity of the row before

    def close(self) -> None:
        if self.open:
            conv, codes, turns = self.open
            least = [t for t, _, _ in turns if t is not None]
            self.out.append(
                (
                    conv, self.part, b"".join(codes), min(least, default=None),
                    max((t for _, t, _ in turns if t is not None), default=None),
                    sum(n for _, _, n in turns), turns[0][0], turns[-1][1],
                )
            )
            self.open = None

    def add(self, batch: pa.RecordBatch) -> None:
        n = batch.num_rows
        conv, no_conv = _column(batch, "conv_id"), batch.column("conv_id").is_null().to_numpy(False)
        turn, no_turn = _column(batch, "turn"), batch.column("turn").is_null().to_numpy(False)
        mark = batch.column("digest").to_pylist()
        changed = np.ones(n, bool)
        changed[1:] = (conv[1:] != conv[:-1]) | (no_conv[1:] != no_conv[:-1])
        fresh = changed.copy()
        fresh[1:] |= (turn[1:] != turn[:-1]) | (no_turn[1:] != no_turn[:-1])
        same = np.zeros(n, bool)
        same[1:] = ~fresh[1:] & np.fromiter((x == y for x, y in zip(mark[1:], mark)), bool, n - 1)
        head = (None if no_conv[0] else int(conv[0]), None if no_turn[0] else int(turn[0]), mark[0])
        if self.before is not None and self.before[0] == head[0]:
            changed[0] = False
            fresh[0] = self.before[1] != head[1]
            same[0] = not fresh[0] and self.before[2] == head[2]
        again = same | ~batch.column("first").to_numpy(zero_copy_only=False)
        fault = _column(batch, "fault")
        fault = np.where((fault != 1) & again, 2, fault)
        codes = (_column(batch, "kind") | fault << 2).astype(np.uint8)
        cuts = np.append(np.flatnonzero(changed | (np.arange(n) == 0)), n).tolist()
        for a, b in zip(cuts, cuts[1:]):
            if changed[a]:
                self.close()
                self.open = (None if no_conv[a] else int(conv[a]), [], [])
            _, own, turns = self.open
            own.append(codes[a:b].tobytes())
            known = ~no_turn[a:b]
            low = None if no_turn[a] else int(turn[a])
            high = None if no_turn[b - 1] else int(turn[b - 1])
            turns.append((low, high, int((fresh[a:b] & known).sum())))
            if low is None and high is not None:  # nulls first, then the least turn
                turns[-1:] = [(None, None, 0), (int(turn[a + int(known.argmax())]), high, turns[-1][2])]
        self.before = (
            None if no_conv[-1] else int(conv[-1]), None if no_turn[-1] else int(turn[-1]), mark[-1]
        )

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) or [()] * len(_RUN)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RUN)], schema=_RUN)


def _runs(batches):
    runs = _Runs(TaskContext.get().partitionId())
    for batch in batches:
        if batch.num_rows:
            runs.add(batch)
            yield runs.take()
    runs.close()
    yield runs.take()


def _audits(batches):
    """What is known of each conversation but the hash, from its runs in order."""
    legal = np.zeros((4, 4), bool)
    legal[[_SYSTEM, _USER, _ASSISTANT], [_USER, _ASSISTANT, _USER]] = True
    for batch in batches:
        out = []
        for conv, runs in zip(*(c.to_pylist() for c in batch.columns)):
            runs = sorted((r for r in runs if r["codes"]), key=lambda r: r["part"])
            whole = b"".join(r["codes"] for r in runs)
            codes = np.frombuffer(whole, np.uint8)
            turns = [t for r in runs for t in (r["least"], r["most"]) if t is not None]
            distinct = sum(r["distinct"] for r in runs) - sum(
                a["tail"] is not None and a["tail"] == b["head"] for a, b in zip(runs, runs[1:])
            )
            gaps = max(turns) - min(turns) + 1 - distinct if turns else 0
            kinds, faults = codes & 3, np.bincount(codes >> 2, minlength=4).tolist()
            illegal = int((~legal[kinds[:-1], kinds[1:]]).sum()) if len(codes) else 0
            cost, audit = align(whole)
            out.append((conv, gaps, *faults[1:], illegal, cost, audit))
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        columns = list(zip(*out)) or [()] * 8
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:7]), pa.array(columns[7], pa.string())],
            [*names, "audit"],
        )


class Repaired:
    """The repaired turns of one conversation, hashed as its turns pass by in order."""

    def __init__(self, audit: str, keep: bool):
        self.audit, self.at, self.last, self.count = audit, 0, "", 0
        self.sha, self.turns = hashlib.sha256(), [] if keep else None

    def _put(self, role: str, text: str) -> None:
        line = f"{role}:{text}"
        self.sha.update((("\n" if self.count else "") + line).encode("utf-8", "replace"))
        self.count += 1
        self.last = role[:1]
        if self.turns is not None:
            self.turns.append((role, text))

    def _next(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._put(self._next(), "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._put(role if edit == "K" else self._next(), text)


def _hashed(names: list[str], with_turns: bool):
    def run(batches):
        now, row, out = None, None, []

        def done():
            if now is not None:
                now.inserted()
                turns = [{"role": r, "text": t} for r, t in now.turns] if with_turns else None
                out.append((*row, now.sha.hexdigest(), turns))

        kinds = [pa.int64()] * 7 + [pa.string(), pa.string()]
        for batch in batches:
            at = {n: batch.column(n).to_pylist() for n in [*names, "text", "role", "sort"]}
            for k, sort in enumerate(at["sort"]):
                if sort == 0:
                    done()
                    row = tuple(at[n][k] for n in names)
                    now = Repaired(row[-1], with_turns)
                else:
                    now.turn(at["role"][k], at["text"][k])
            if len(out) >= 1000 or with_turns:
                yield _rows(out, names, kinds, with_turns)
                out = []
        done()
        yield _rows(out, names, kinds, with_turns)

    return run


def _rows(out, names, kinds, with_turns) -> pa.RecordBatch:
    columns = list(zip(*out)) or [()] * 10
    arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
    labels = [*names, "repaired_sha256"]
    if with_turns:
        turn = pa.struct([("role", pa.string()), ("text", pa.string())])
        arrays.append(pa.array(columns[9], pa.list_(turn)))
        labels.append("turns")
    return pa.RecordBatch.from_arrays(arrays, labels)


def repair(turns: DataFrame, ids: DataFrame | None = None, with_turns: bool = False) -> DataFrame:
    """One row for each conv_id of ``ids``, or of ``turns`` (conv_id, turn, role, text).

    Rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 and, on
    demand, the repaired turns. The audit is the cheapest sequence of edits (Keep, Rerole, Delete,
    Insert), the ASCII-least of several. A null role or text is one space; a null conv_id is a
    conversation. Turns are in the order of turn, nulls first; of the same turn by role and by a
    digest of role and text. A role counts by its first letter. Repeated rows are turns like any
    other. Conversations without turns have zeros, an empty audit and the hash of the empty string.
    Other columns are ignored; empty tables give no rows. Runs the first passes when called.

    A conversation's codes and audit, a byte for each turn, are held by one task, as the audit is by
    the row returned; its texts pass through one task in order, since the hash needs them so.
    """
    known = F.coalesce(F.col("role"), F.lit(" ")).alias("role")
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), known,
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    )
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.withColumn("digest", F.unhex(F.sha2(whole.cast("binary"), 256)))
    trimmed = F.rtrim("text", F.lit(_BLANK))
    initial = F.substring("role", 1, 1)
    compact = rows.select(
        "conv_id", "turn", "role", "digest",
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("kind"),
        F.when(trimmed == "", 1)
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), 3).otherwise(0).alias("fault"),
    )
    compact = written(compact, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("set"), "turn")
    firsts = compact.groupBy(
        F.col("conv_id").alias("of"), F.col("digest").alias("same")
    ).agg(F.min(place).alias("place"))
    marked = compact.join(
        firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same"))
    ).select(
        "conv_id", "turn", "role", "digest", "kind", "fault",
        F.col("turn").eqNullSafe(F.col("place.turn")).alias("first"),
    )
    marked = written(marked, "marked-turns")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest")]
    runs = marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_runs, _RUN_KIND)
    every = (turns if ids is None else ids).select(F.col("conv_id").cast("long")).distinct()
    runs = runs.unionByName(every, allowMissingColumns=True)
    kind = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    parts = F.struct("part", "codes", "least", "most", "distinct", "head", "tail")
    # Aligning costs far more than its few bytes suggest, so these are dealt out by number.
    tasks = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gathered = runs.repartition(tasks, "conv_id").groupBy("conv_id")
    audits = gathered.agg(F.collect_list(parts).alias("runs")).mapInArrow(
        _audits, "conv_id long, " + kind
    )
    audits = written(audits, "audits")
    both = audits.withColumn("sort", F.lit(0)).unionByName(
        rows.withColumn("sort", F.lit(1)), allowMissingColumns=True
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "sort", "turn", "role", "digest")]
    stream = both.repartition("conv_id").sortWithinPartitions(*order).drop("turn", "digest")
    kind = f"conv_id long, {kind}, repaired_sha256 string"
    return stream.mapInArrow(
        _hashed(audits.columns, with_turns),
        kind + ", turns array<struct<role: string, text: string>>" * with_turns,
    )
