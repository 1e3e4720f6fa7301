"""SentencePiece encoding by sampling from the piece lattice, and its decoding.

Forward filtering gives each place of a text the total weight of all segmentations up to it;
backward sampling draws the last piece by its share, then the one before, and so on. Draws depend
on the row's key and on the place in the text alone, so that they do not depend on partitions.

No piece spans the beginning of a space, so the lattice falls apart into units: spaces with what
follows up to the next space. Each distinct unit of a chunk is filtered once, all units at a time
by distance from their beginning; all occurrences are sampled at a time. A character without a
piece is spelled in bytes, as is the sign that pieces use for a space where a text has it itself.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import CHUNK, PrefixHash, chunks, mix, raw

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Weight of a piece: the exponential of its score times this.
ALPHA = 0.0005
_SIGN = "▁".encode()


class Pieces:
    """The pieces of a model as a tree over bytes."""

    def __init__(self, path: str, alpha: float):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes: list[bytes] = [b""] * size
        nodes: list[dict[int, int]] = [{}]
        ends = {}
        self.byte_ids = np.full(256, -1, np.int32)
        self.weight = np.array([alpha * model.get_score(i) for i in range(size)])
        for i in range(size):
            if model.is_byte(i):
                b = int(model.id_to_piece(i)[1:-1], 16)
                self.byte_ids[b], self.bytes[i] = i, bytes([b])
                continue
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            self.bytes[i] = model.id_to_piece(i).encode().replace(_SIGN, b" ")
            if b" " in self.bytes[i].lstrip(b" "):
                raise ValueError("a piece goes on after a space that follows something else")
            at = 0
            for b in self.bytes[i]:
                if b not in nodes[at]:
                    nodes[at][b] = len(nodes)
                    nodes.append({})
                at = nodes[at][b]
            ends[at] = i
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        self.spelled = float(self.weight.min()) - 10.0
        self.next = np.zeros((len(nodes), 256), np.int32)
        for k, children in enumerate(nodes):
            for b, to in children.items():
                self.next[k, b] = to
        self.piece = np.full(len(nodes), -1, np.int32)
        self.piece[list(ends)] = list(ends.values())


@functools.lru_cache(2)
def load(path: str = MODEL, alpha: float = ALPHA) -> Pieces:
    """One for each worker and file. ``path`` must name a file that every executor has."""
    return Pieces(path, alpha)


class Lattice:
    """Forward-filtered lattices of distinct units, given as joined bytes and lengths.

    Nodes are numbered by distance from the unit's beginning, longest units first, so that the
    edges into all nodes of one distance lie together.
    """

    def __init__(self, pieces: Pieces, data: np.ndarray, lengths: np.ndarray):
        units = len(lengths)
        rank = np.empty(units, np.int64)
        rank[np.argsort(-lengths, kind="stable")] = np.arange(units)
        self.rank, self.lengths = rank, lengths
        reach = np.bincount(lengths, minlength=1)[::-1].cumsum()[::-1]  # units of length r or more
        self.level = np.concatenate([[0], np.cumsum(reach)])
        unit = np.repeat(np.arange(units), lengths)
        begin = np.cumsum(lengths) - lengths
        inner = np.arange(len(data)) - begin[unit]
        left = lengths[unit] - inner
        head = (data & 0xC0) != 0x80
        edges: list[tuple[np.ndarray, int, np.ndarray]] = []
        at = np.flatnonzero(head)
        node = np.zeros(len(at), np.int32)
        width = np.ones(len(data), np.int64)
        heads = np.append(at, len(data))
        width[at] = np.minimum(np.diff(heads), left[at])
        covered = np.zeros(len(data), bool)
        size = 0
        while len(at):
            size += 1
            inside = left[at] >= size
            at, node = at[inside], node[inside]
            node = pieces.next[node, data[at + size - 1]]
            alive = node > 0
            at, node = at[alive], node[alive]
            found = pieces.piece[node]
            hit = found >= 0
            edges.append((at[hit], size, found[hit]))
            covered[at[hit][width[at[hit]] == size]] = True
        # Characters without a piece of their own: byte by byte.
        bare = np.flatnonzero(head & ~covered)
        for k in range(4):
            own = bare[width[bare] > k] + k
            edges.append((own, 1, pieces.byte_ids[data[own]] + np.int32(1 << 30)))
        nodes = int(self.level[-1])
        place = self.level[inner] + rank[unit]  # of the node before each byte
        count = np.zeros(nodes + 1, np.int64)
        ends = []
        for start, size, _ in edges:
            end = self.level[inner[start] + size] + rank[unit[start]]
            ends.append(end)
            count[end + 1] += 1  # no end twice in one step
        self.first = np.cumsum(count)
        total = int(self.first[-1])
        self.source = np.empty(total, np.int64)
        self.id = np.empty(total, np.int32)
        fill = self.first[:-1].copy()
        for (start, _, found), end in zip(edges, ends):
            slot = fill[end]
            fill[end] += 1
            self.source[slot] = place[start]
            self.id[slot] = found
        spelled = self.id >= 1 << 30
        self.id[spelled] -= 1 << 30
        weight = np.where(spelled, pieces.spelled, pieces.weight[self.id])
        self.share = np.empty(total)
        alpha = np.full(nodes, -np.inf)
        alpha[: self.level[1]] = 0.0
        for r in range(1, len(self.level) - 1):
            a, b = self.level[r], self.level[r + 1]
            e, f = self.first[a], self.first[b]
            if e == f:
                continue
            cut = self.first[a : b + 1] - e
            some = np.flatnonzero(np.diff(cut))
            value = alpha[self.source[e:f]] + weight[e:f]
            top = np.maximum.reduceat(value, cut[some])
            sizes = np.diff(cut)[some]
            safe = np.where(np.isfinite(top), top, 0.0)
            part = np.exp(value - np.repeat(safe, sizes))
            sums = np.add.reduceat(part, cut[some])
            running = np.cumsum(part)
            before = np.concatenate([[0.0], running])[cut[some]]
            with np.errstate(divide="ignore", invalid="ignore"):
                alpha[a + some] = safe + np.log(sums)
                self.share[e:f] = (running - np.repeat(before, sizes)) / np.repeat(sums, sizes)

    def sample(self, unit: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A segmentation of each occurrence: ids one after another, and how many each has."""
        node = self.level[self.lengths[unit]] + self.rank[unit]
        who = np.arange(len(unit))
        steps = []
        step = 0
        count = np.zeros(len(unit), np.int64)
        while len(who):
            draw = mix(seed[who] + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            draw = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge, last = self.first[node], self.first[node + 1] - 1
            moving = np.flatnonzero((self.share[edge] <= draw) & (edge < last))
            while len(moving):
                edge[moving] += 1
                e = edge[moving]
                moving = moving[(self.share[e] <= draw[moving]) & (e < last[moving])]
            steps.append((who, self.id[edge]))
            count[who] += 1
            node = self.source[edge]
            on = node >= self.level[1]
            who, node = who[on], node[on]
            step += 1
        ends = np.cumsum(count)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        for k, (who, found) in enumerate(steps):
            ids[ends[who] - 1 - k] = found
        return ids, count


def sample(column: pa.Array, keys: np.ndarray, pieces: Pieces, seed: int = 0, begin: int = 0):
    """Sampled ids of all texts, and where each text's begin.

    With ``begin`` they are later parts of texts, that many bytes from the space before the text.
    """
    offsets, data = raw(column)
    n = len(offsets) - 1
    full = np.diff(offsets) > 0
    # A space before each text that is not empty.
    shift = np.concatenate([[0], np.cumsum(full & (begin == 0))])
    text = np.full(len(data) + int(shift[-1]), 32, np.uint8)
    text[np.arange(len(data)) + np.repeat(shift[1:], np.diff(offsets))] = data
    offsets = offsets + shift
    if len(text) == 0:
        return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
    space = text == 32
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[offsets[:-1][full]] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], len(text))
    hashes = mix(PrefixHash(text).spans(starts, ends) + (ends - starts).astype(np.uint64))
    _, at, unit = np.unique(hashes, return_index=True, return_inverse=True)
    lengths = (ends - starts)[at]
    inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    lattice = Lattice(pieces, text[np.repeat(starts[at], lengths) + inner], lengths)
    row = np.searchsorted(offsets, starts, "right") - 1
    seeds = mix(keys.astype(np.uint64) ^ mix(np.array([seed + 1], np.uint64)))[row]
    seeds = mix(seeds + (starts - offsets[row] + begin).astype(np.uint64))
    ids, count = lattice.sample(unit, seeds)
    per_row = np.bincount(row, count, n).astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(per_row)])


def unit_parts(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[pa.Array, int]]:
    """Texts and the ``begin`` that ``sample`` takes: all at once, or a single long text in parts of
    about ``limit`` bytes, cut where a unit begins. A unit longer than that stays whole."""
    _, data = raw(column)
    if len(column) != 1 or len(data) <= limit:
        yield column, 0
        return
    at = 0
    while at < len(data):
        to = at + limit
        while to < len(data):
            here = data[to : to + limit] == 32
            here &= data[to - 1 : to - 1 + len(here)] != 32
            if here.any():
                to += int(here.argmax())
                break
            to += limit
        part = data[at:to].tobytes()
        yield pa.array([part], pa.binary()).cast(pa.string()), at + 1 if at else 0
        at = to


def sampled(
    column: pa.Array, keys: np.ndarray, pieces: Pieces, seed: int = 0, limit: int = CHUNK
) -> tuple[np.ndarray, np.ndarray, list[int], list[bool]]:
    """Ids of all texts, where each text's begin, their checksums, and whether they give the text."""
    n = len(column)
    found, count, crc, same = [], np.zeros(n, np.int64), [0] * n, [True] * n
    for part, begin in unit_parts(column, limit):
        ids, edges = sample(part, keys, pieces, seed, begin)
        offsets, data = raw(part)
        spelled = list(map(pieces.bytes.__getitem__, ids.tolist()))
        for k, (i, j) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
            crc[k] = zlib.crc32(ids[i:j].astype("<u4"), crc[k])
            text = b"".join(spelled[i:j])
            same[k] &= (text if begin else text[1:]) == data[offsets[k] : offsets[k + 1]].tobytes()
        found.append(ids)
        count += np.diff(edges)
    return np.concatenate(found), np.concatenate([[0], np.cumsum(count)]), crc, same


def decode(ids, pieces: Pieces) -> str:
    """The text of ids: their bytes, without the space before it."""
    return b"".join(map(pieces.bytes.__getitem__, ids))[1:].decode("utf-8", "replace")


def encode_documents(
    docs: DataFrame, path: str = MODEL, alpha: float = ALPHA, seed: int = 0
) -> DataFrame:
    """(doc_id, n_bytes, n_pieces, ids, ids_crc32, round_trip) for each row of ``docs``.

    ``ids`` is a segmentation sampled by key doc_id (null: 0) and ``seed``; equal texts with equal
    keys get equal ids. ``round_trip`` tells whether they decode to the text. A null or empty text
    has no pieces. A long text is taken in parts that begin where units do, with the same result.
    Other columns are ignored; an empty table gives no rows. Larger ``alpha`` makes the best
    segmentation likelier.
    """

    def run(batches):
        pieces = load(path, alpha)
        for batch in chunks(batches):
            column = batch.column("text")
            keys = np.array([k or 0 for k in batch.column("doc_id").to_pylist()], np.int64)
            ids, edges, crc, same = sampled(column, keys, pieces, seed)
            offsets, _ = raw(column)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(np.diff(edges)),
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids)),
                    pa.array(crc, pa.int64()), pa.array(same, pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_pieces", "ids", "ids_crc32", "round_trip"],
            )

    kind = "doc_id long, n_bytes long, n_pieces long, ids array<int>, ids_crc32 long, round_trip boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kind)


def decode_documents(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids are no text."""

    def run(batches):
        pieces = load(path)
        for batch in batches:
            texts = [decode(x, pieces) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    ids = F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    return encoded.select("doc_id", ids).mapInArrow(run, "doc_id long, text string")
