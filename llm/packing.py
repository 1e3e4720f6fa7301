"""Token sequences of a fixed size, filled by sum-of-squares packing."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.session import written
from llm.common import CHUNK, chunks, keyed, slices
from llm.tokens import BYTE_BPE, pre_tokens

SEQUENCE = 2048
END = 0
#: Rounds of open bins at most; the number of a sequence has room for 31.
ROUNDS = 30
#: Pre-tokens whose ids a worker keeps, by hash; beyond it the memory is emptied and filled anew.
REMEMBERED = 600_000

_memory: dict[str, dict[int, bytes]] = {}


def _ids(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each with the closing id, and where each begins."""
    tokens = pre_tokens(path)
    body, text, starts, ends, hashes = tokens.spans(texts)
    distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    memory = _memory.setdefault(path, {})
    if len(memory) > REMEMBERED:
        memory.clear()
    names = distinct.tolist()
    new = [k for k, h in enumerate(names) if h not in memory]
    strings = [body[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist())]
    for k, found in zip(new, tokens.ids(strings)):
        memory[names[k]] = np.array(found, "<u4").tobytes()
    blobs = [memory[h] for h in names]
    flat = np.frombuffer(b"".join(blobs), "<u4")
    size = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    begin = np.cumsum(size) - size
    # Each text ends with the closing id, so text k is shifted by k places.
    sizes = size[which]
    put = np.cumsum(sizes) - sizes + text
    edges = np.zeros(len(texts) + 1, np.int64)
    np.add.at(edges[1:], text, sizes)
    edges = np.cumsum(edges) + np.arange(len(texts) + 1)
    out = np.full(int(edges[-1]), END, "<u4")
    inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(put, sizes) + inner] = flat[np.repeat(begin[which], sizes) + inner]
    return out, edges


def _all_ids(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The same, with long texts taken piece by piece."""
    if max(map(len, texts)) <= CHUNK:
        return _ids(path, texts)
    out, size = [], []
    for text in texts:
        parts = [_ids(path, [part])[0] for part in slices(text)]
        # A closing id stands after the last piece only.
        out += [part[:-1] for part in parts[:-1]] + parts[-1:]
        size.append(sum(map(len, parts)) - len(parts) + 1)
    return np.concatenate(out), np.concatenate([[0], np.cumsum(size)])


def pieces(
    docs: DataFrame, size: int = SEQUENCE, path: str = BYTE_BPE, with_ids: bool = False
) -> DataFrame:
    """Each document's ids and the closing id, cut only where longer than ``size``.

    Of a cut document the first piece is the shorter one, all others are full. Rows: key, doc_id,
    piece, start, length, ids_crc32, and with ``with_ids`` the ids. A null text is empty, thus one
    id. Other columns of ``docs`` are ignored.
    """
    fields = [
        ("key", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
        ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def run(batches):
        for batch in chunks(batches):
            out: list[list] = [[] for _ in fields]
            ids, edges = _all_ids(path, batch.column("text").to_pylist())
            keys, docs = batch.column("key").to_pylist(), batch.column("doc_id").to_pylist()
            for key, doc, first, last in zip(keys, docs, edges.tolist(), edges[1:].tolist()):
                n = last - first
                cuts = [0, *range(n % size or size, n + 1, size)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    own = ids[first + a : first + b]
                    row = [key, doc, k, a, b - a, zlib.crc32(own)]
                    if with_ids:
                        row.append(own.astype(np.int32))
                    for c, v in zip(out, row):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema
            )

    kind = "key long, doc_id long, piece int, start long, length long, ids_crc32 long"
    return keyed(docs).mapInArrow(run, kind + ", ids array<int>" * with_ids)


def place(lengths: np.ndarray, size: int) -> np.ndarray:
    """The bin of each item, in the order given.

    An item goes where the sum over gaps of the squared number of open bins with that gap becomes
    smallest: of the gaps that hold it, or a new bin. Ties take the smallest gap left, and an open
    bin before a new one. Full bins are not counted.
    """
    number = np.zeros(size + 1, np.int64)  # open bins by gap; index 0 stays 0
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    out = np.empty(len(lengths), np.int64)
    made = 0
    for i, s in enumerate(lengths.tolist()):
        # Moving a bin from gap g to g - s changes the sum by 2 * (1 + N(g - s) - N(g)),
        # and by 1 - 2 * N(g) where it becomes full; a new bin by 2 * N(size - s) + 1.
        have = number[s:]
        change = 2 * (1 + number[: size + 1 - s] - have)
        change[0] = 1 - 2 * have[0]
        change[have == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())
        new = 0 if s == size else 2 * number[size - s] + 1
        if change[best] <= new and s < size:
            gap, left = s + best, best
            b = stacks[gap].pop()
            number[gap] -= 1
        else:
            b, left = made, size - s
            made += 1
        if left:
            number[left] += 1
            stacks[left].append(b)
        out[i] = b
    return out


def _fill(group: pa.Table, size: int) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The items of a group, longest first, with the bin and the place of each."""
    lengths = group.column("length").to_numpy()
    order = np.lexsort((group.column("piece").to_numpy(), group.column("key").to_numpy(), -lengths))
    lengths = lengths[order]
    bins = place(lengths, size)
    by = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[by])
    first = np.concatenate([[True], bins[by][1:] != bins[by][:-1]])
    offset = np.empty(len(by), np.int64)
    offset[by] = ends - lengths[by] - np.maximum.accumulate(np.where(first, ends - lengths[by], 0))
    return group.take(pa.array(order)), bins, offset


def pack(items: DataFrame, size: int = SEQUENCE, per_group: int = 8192) -> DataFrame:
    """``items`` (key, piece, length and more) with sequence_id and offset.

    Items are dealt out by hash into groups of about ``per_group`` and packed group by group,
    longest first. Bins left open are dealt out anew, again about ``per_group`` to a group, and
    packed as single items. That ends with the round of a single group, or with one that joins
    fewer than one bin in fifty, where most bins cannot be joined at all: so no group holds more,
    however many bins stay open. A sequence's number is made of round, group and bin.
    """
    names = items.columns

    def deal(level: int):
        def run(key: tuple, group: pa.Table) -> pa.Table:
            group, bins, offset = _fill(group.drop(["group"]), size)
            base = (level << 58) | (key[0].as_py() << 32)
            group = group.append_column("sequence_id", pa.array(bins + base))
            return group.append_column("offset", pa.array(offset))

        return run

    def dealt(rows: DataFrame, n: int, level: int) -> DataFrame:
        schema = rows.selectExpr("*", "0L as sequence_id", "0L as offset").schema
        groups = max(1, -(-n // per_group))
        group = F.pmod(F.xxhash64("key", "piece", F.lit(level)), F.lit(groups)).cast("int")
        out = rows.withColumn("group", group).groupBy("group").applyInArrow(deal(level), schema)
        return written(out, f"packed-{level}")

    def opened(packed: DataFrame) -> DataFrame:
        bins = packed.groupBy(F.col("sequence_id").alias("key")).agg(
            F.lit(0).alias("piece"), F.sum("length").alias("length")
        )
        return written(bins.where(F.col("length") < size), "open-bins")

    n = items.count()
    placed = dealt(items, n, 0)
    moves: list[DataFrame] = []
    last = placed
    while n > per_group and len(moves) < ROUNDS:
        bins = opened(last)
        n = bins.count()
        last = dealt(bins, n, len(moves) + 1)
        moves.append(last)
        if last.select("sequence_id").distinct().count() > 0.98 * n:
            break
    for move in moves:
        move = move.select(
            F.col("key").alias("sequence_id"), F.col("sequence_id").alias("to"),
            F.col("offset").alias("shift"),
        )
        placed = placed.join(move, "sequence_id", "left").select(
            *names, F.coalesce("to", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
    return placed


def pack_documents(docs: DataFrame, size: int = SEQUENCE, path: str = BYTE_BPE) -> DataFrame:
    """The pieces of all documents, each with its sequence and its place there.

    Every row of ``docs`` is packed, also with a null or repeated doc_id; an empty table gives no
    rows.
    """
    return pack(written(pieces(docs, size, path), "pieces"), size)
