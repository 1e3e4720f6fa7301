"""Near-duplicate documents by SuperMinHash signatures, bands and verified links.

A signature takes for each shingle a pseudo-random permutation of the slots: its value in the
slot at rank j is j plus a fraction, and each slot keeps the smallest value. Ranks are dealt from 0
on, and a document stops as soon as all its slots are filled, since later ranks cannot win.

Documents with the same set are one class. Classes that share a band are linked to the smallest of
them, if their full sets are similar enough. Where a band's classes are then still in several
components, those are compared by signature, so that no link is lost to the choice of the
smallest. Components that may be linked form families; within a family all members of
different components are compared, again in blocks inside the tasks, and each task returns no more
links than it takes to join what it found linked. So neither pairs of a group nor near misses are
ever listed. With 48 bands of 5 slots a pair at the threshold of 0.75 shares none with a
probability of 2e-6, and falls below the signature threshold with less than 1e-7.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.session import written
from llm.common import CHUNK, chunks, keyed, mix, word_parts, words
from llm.components import components

SHINGLE = 5
PERCENT = 75
ROWS = 5
BANDS = 48
SLOTS = ROWS * BANDS
#: Share of equal slots below which a pair cannot reach the threshold.
LIKELY = 0.60
#: Members of a band compared with each other in one task.
BLOCK = 1024

_FRACTION = np.uint64(40)
_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(
    column: pa.Array, size: int = SHINGLE, limit: int = CHUNK
) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct shingle, by row and hash. Fewer words are one shingle.

    Words are hashed about ``limit`` bytes at a time, so a long text costs its words, not its bytes.
    """
    parts = [(at[row], word) for at, part in word_parts(column, limit) for row, word in [words(part)]]
    row, word = map(np.concatenate, zip(*parts)) if parts else words(column)
    n = len(word)
    count = np.bincount(row, minlength=len(column))
    total = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size):
        total += mix(word[k : n - size + 1 + k] * _FACTORS[k]) if len(total) else 0
    whole = row[: len(total)] == row[size - 1 :] if len(total) else np.zeros(0, bool)
    rows, hashes = row[: len(total)][whole], mix(total[whole])
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.searchsorted(row, short)
        extra = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = count[short] > k
            extra[has] += mix(word[first[has] + k] * _FACTORS[k + size])
        rows = np.concatenate([rows, short])
        hashes = np.concatenate([hashes, mix(extra + count[short].astype(np.uint64))])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def signatures(rows: np.ndarray, hashes: np.ndarray, count: int, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of ``count`` sets as (count, slots): rank in the high bits, then the fraction."""
    least = np.full(count * slots, np.iinfo(np.uint64).max, np.uint64)
    swapped: list[tuple[np.ndarray, np.ndarray]] = []

    def at(x: np.ndarray) -> np.ndarray:
        out = x.copy()
        for k, old in swapped:
            hit = k == x
            out[hit] = old[hit]
        return out

    for rank in range(slots):
        if len(rows) == 0:
            break
        draw = mix(hashes + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        k = rank + ((draw & np.uint64(0xFFFFFF)).astype(np.int64) * (slots - rank) >> 24)
        old, slot = at(np.full(len(k), rank)), at(k)
        swapped.append((k, old))
        value = (np.uint64(rank) << _FRACTION) | (draw >> np.uint64(64 - 40))
        np.minimum.at(least, rows * slots + slot, value)
        done = (least.reshape(count, slots) != np.iinfo(np.uint64).max).all(axis=1)
        active = ~done[rows]
        if not active.all():
            rows, hashes = rows[active], hashes[active]
            swapped = [(a[active], b[active]) for a, b in swapped]
    return least.reshape(count, slots)


_FEATURES = (
    "key long, doc_id long, n_shingles long, low long, high long, bands array<long>"
)


def features(docs: DataFrame) -> DataFrame:
    """Of keyed documents: set size, hash of the set, and bands of the signature."""

    def run(batches):
        for batch in chunks(batches):
            n = batch.num_rows
            rows, hashes = shingles(batch.column("text"))
            size = np.bincount(rows, minlength=n)
            low, high = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            full = size > 0
            if full.any():
                begin = (np.cumsum(size) - size)[full]
                low[full] = np.add.reduceat(mix(hashes ^ _FACTORS[40]), begin)
                high[full] = np.add.reduceat(mix(hashes ^ _FACTORS[41]), begin)
            least = signatures(rows, hashes, n)
            bands = np.zeros((n, BANDS), np.uint64)
            for k in range(ROWS):
                bands = mix(bands + least[:, k::ROWS] * _FACTORS[k + 20])
            bands = mix(bands + np.arange(BANDS, dtype=np.uint64) * _FACTORS[30])
            offsets = np.concatenate([[0], np.cumsum(np.where(full, BANDS, 0))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("doc_id").cast(pa.int64()), pa.array(size),
                    pa.array(low.view(np.int64)), pa.array(high.view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(offsets.astype(np.int32)), pa.array(bands[full].ravel().view(np.int64))
                    ),
                ],
                ["key", "doc_id", "n_shingles", "low", "high", "bands"],
            )

    return docs.mapInArrow(run, _FEATURES)


def _sets(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, set, sketch) of the documents in ``keys``: their shingle hashes, sorted, as a blob,
    and the signature as 16-bit prints. Few documents share a band, so both are made again."""

    def run(batches):
        for batch in chunks(batches):
            rows, hashes = shingles(batch.column("text"))
            edges = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            blobs = [hashes[i:j].tobytes() for i, j in zip(edges, edges[1:])]
            prints = (mix(signatures(rows, hashes, batch.num_rows)) >> np.uint64(48)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), pa.array(blobs, pa.binary()),
                    pa.array([x.tobytes() for x in prints], pa.binary()),
                ],
                ["key", "set", "sketch"],
            )

    chosen = docs.join(keys, "key", "left_semi").select("key", "text")
    return written(chosen.mapInArrow(run, "key long, set binary, sketch binary"), "shingle-sets")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[place] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""

    def run(batches):
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            keep = [
                _similar(
                    np.frombuffer(left[k].as_buffer(), np.uint64),
                    np.frombuffer(right[k].as_buffer(), np.uint64),
                    percent,
                )
                for k in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_left = pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("left")), "a")
    with_both = with_left.join(sets.select(F.col("key").alias("b"), F.col("set").alias("right")), "b")
    return with_both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _join_up(percent: int | None):
    """Pairs of components in a block that may be linked (by signature), or with ``percent`` that
    are linked (by sets): as many as join what belongs together."""

    def run(block: pa.Table) -> pa.Table:
        root = block.column("component").to_numpy().copy()
        second = block.column("second").to_numpy(zero_copy_only=False)
        sketch = np.frombuffer(b"".join(block.column("sketch").to_pylist()), np.uint16)
        sketch = sketch.reshape(len(root), -1)
        if percent is not None:
            sets = [np.frombuffer(x, np.uint64) for x in block.column("set").to_pylist()]
        out = []
        left, right = np.flatnonzero(~second), np.flatnonzero(second)
        alone = len(right) == 0 and not block.column("two").to_numpy(zero_copy_only=False).any()
        for k, i in enumerate(left):
            others = left[k + 1 :] if alone else right
            others = others[root[others] != root[i]]
            if len(others) == 0:
                continue
            alike = others[(sketch[others] == sketch[i]).mean(axis=1) >= LIKELY]
            for j in alike.tolist():
                a, b = int(root[i]), int(root[j])
                if a != b and (percent is None or _similar(sets[i], sets[j], percent)):
                    out.append((max(a, b), min(a, b)))
                    root[root == max(a, b)] = min(a, b)
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _blocks(members: DataFrame, group: str) -> DataFrame:
    """Members dealt out so that any two of a group meet in one block: (group, i, j)."""
    counts = members.groupBy(group).agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")
    )
    counts = counts.where("low < high").select(group, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.join(counts, group).select("*", own.alias("own")).select("*", other.alias("other"))
    return dealt.select(
        *members.columns, (F.col("own") > F.col("other")).alias("second"),
        (F.col("own") != F.col("other")).alias("two"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(key, doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    Uses doc_id and text; other columns are ignored. A text without words (null, empty, blank) has
    no shingles and is linked with nothing. Rows that repeat a doc_id or have none are documents of
    their own, in the order of ``keyed``; ``kept`` marks the first row of each component. An empty
    table gives no rows.
    """
    return link(keyed(docs))


def link(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` of documents that have their keys (key, doc_id, text)."""
    found = written(features(docs), "near-features")
    same = ["n_shingles", "low", "high"]
    classes = found.where("n_shingles > 0").groupBy(*same).agg(F.min("key").alias("first"))
    classes = written(classes, "near-classes")
    firsts = classes.select(F.col("first").alias("key"))
    bands = found.join(firsts, "key", "left_semi").select(F.explode("bands").alias("band"), "key")
    centers = bands.groupBy("band").agg(F.min("key").alias("center"), F.count("*").alias("n"))
    shared = bands.join(centers.where("n > 1").drop("n"), "band")
    shared = written(shared, "near-bands")
    # The smallest of a document's centers; its other bands come below.
    star = shared.where("key <> center").groupBy(F.col("key").alias("a")).agg(F.min("center").alias("b"))
    star = written(star, "near-pairs")
    sets = _sets(docs, written(shared.select("key").distinct(), "near-keys"))
    links = written(verified(star, sets), "near-links")

    tied = components(links)
    named = shared.select("band", "key").join(
        tied.select(F.col("node").alias("key"), "component"), "key", "left"
    ).withColumn("component", F.coalesce("component", "key"))
    named = written(named, "near-bands-named")
    sketches = sets.select("key", "sketch")
    kind = "a long, b long"
    likely = _blocks(named, "band").join(sketches, "key").groupBy("band", "i", "j").applyInArrow(
        _join_up(None), kind
    )
    likely = written(likely.distinct(), "near-likely")
    all_tied = tied
    if not likely.isEmpty():
        families = components(likely).select(F.col("node").alias("component"), F.col("component").alias("family"))
        members = named.select("key", "component").distinct().join(families, "component")
        members = _blocks(written(members, "near-families"), "family")
        members = members.join(sets, "key")
        more = written(
            members.groupBy("family", "i", "j").applyInArrow(_join_up(PERCENT), kind), "near-links-rest"
        )
        all_tied = components(links.unionByName(more))

    by_class = classes.join(all_tied.withColumnRenamed("node", "first"), "first", "left").select(
        *same, F.coalesce("component", "first").alias("component")
    )
    rows = found.select("key", "doc_id", *same).join(by_class, same, "left")
    rows = rows.withColumn("component", F.coalesce("component", "key"))
    heads = found.select(F.col("key").alias("component"), F.col("doc_id").alias("component_id"))
    return rows.join(heads, "component").select(
        "key", "doc_id", "n_shingles", "component_id", (F.col("key") == F.col("component")).alias("kept")
    )
