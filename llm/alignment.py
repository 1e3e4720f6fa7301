"""Two tokenizers' tokens of the same texts, aligned by merging their ends.

A text falls apart at each blank between two characters that are not white space: there tokens of
both begin, whatever comes before. Each distinct segment of a chunk is encoded once by both. The
token ends of all segments, one after another, are two sorted lists. Diagonals at equal distances
divide their merge into pieces of the same number of steps; a binary search along each diagonal
finds where its piece begins, and pieces are merged independently, all side by side. Each step of a
piece emits the pair of tokens that overlap there, or closes a group where both lists end; counts
of the groups closed in earlier pieces stitch those that cross a border. Documents are sums over
their segments. Pair counts are summed over the corpus from one row for each chunk and pair, and
come back to the chunks to be weighted by the documents' segments.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowlens.session import written
from llm.common import chunks, each, grow, raw, rows, shrink
from llm.tokens import BYTE_BPE

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: Steps of each piece of a merge.
STEPS = 512
#: Segments encoded and merged at a time, and bytes of a text split at a time.
_SEGMENTS = 1 << 16
_PART = 4 << 20
_SHIFT = 32
_UNSAFE = re.compile(r"^ | $| \s|\s ")
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_SIGN = "▁"

_CHUNK = pa.schema(
    [
        ("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("totals", pa.binary()),
        ("digests", pa.list_(pa.string())), ("groups", pa.list_(pa.string())),
        ("docs", pa.binary()), ("segments", pa.binary()),
        ("pair", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
    ]
)
_KIND = (
    "chunk long, doc_id array<long>, totals binary, digests array<string>, groups array<string>, "
    "docs binary, segments binary, pair array<long>, times array<long>"
)


def segments(text: str) -> Iterator[list[str]]:
    """The segments of a text without the blank that each begins with, some at a time."""
    first = 0
    while True:
        last = len(text)
        if last - first > _PART:
            cut = _SAFE.search(text, first + _PART)
            last = cut.start() if cut else last
        part = text if first == 0 and last == len(text) else text[first:last]
        yield _SAFE.split(part) if _UNSAFE.search(part) else part.split(" ")
        if last == len(text):
            return
        first = last + 1


class Sides:
    """Both tokenizers; a side's tokens are ids with bytes, special strings are plain text."""

    def __init__(self, a: str, b: str):
        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        with open(a, encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        # Bytes stand for themselves where printable, the others follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = (
                bytes(map(byte.__getitem__, token)) if all(c in byte for c in token) else token.encode()
            )
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        self.b_bytes = [
            bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(_SIGN, " ").encode()
            for i in range(self.b.get_piece_size())
            for piece in [self.b.id_to_piece(i)]
        ]
        # Segments rest on this: no token goes on after a blank that follows something else.
        if type(self.a.pre_tokenizer).__name__ != "ByteLevel" or self.a.pre_tokenizer.add_prefix_space:
            raise ValueError("only byte-level files without a prefix are supported")
        if any(b" " in token.lstrip(b" ") for token in self.b_bytes):
            raise ValueError("a piece goes on after a blank that follows something else")
        # Of each id the text with what follows it: another of its side, the other side, the end.
        self.a_names = [f"{i}{c}" for c in (",", "|") for i in range(len(self.a_bytes))]
        self.b_names = [f"{i}{c}" for c in (",", ";", "\n") for i in range(len(self.b_bytes))]

    def ids(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        left = self.a.encode_batch_fast([" " + p for p in parts], add_special_tokens=False)
        return [x.ids for x in left], self.b.encode(parts, num_threads=1)


@functools.lru_cache(2)
def sides(a: str = BYTE_BPE, b: str = PIECE_BPE) -> Sides:
    """One for each worker and pair of files, which every executor must have."""
    return Sides(a, b)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    out = np.fromiter((i for x in lists for i in x), np.int64, int(sizes.sum()))
    return out, sizes


def borders(a: np.ndarray, b: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of ``a`` and of ``b`` come before every ``steps``-th place of their merge.

    Of equal values that of ``a`` comes first. Each diagonal is searched by itself.
    """
    place = np.arange(0, len(a) + len(b), steps)
    low, high = np.maximum(place - len(b), 0), np.minimum(place, len(a))
    while (low < high).any():
        mid = (low + high) >> 1
        open_ = low < high
        # The next of a comes before the last of b that the diagonal would take instead.
        more = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.clip(place - mid - 1, 0, len(b) - 1)])
        low = np.where(more, mid + 1, low)
        high = np.where(open_ & ~more, mid, high)
    return low, place - low


def merge(a: np.ndarray, b: np.ndarray, steps: int = STEPS):
    """Overlapping tokens and groups of two lists of token ends with the same last end.

    Gives the places in ``a`` and in ``b`` of each overlapping pair, in order, and how many of
    ``a`` and of ``b`` each group and those before it hold.
    """
    i, j = borders(a, b, steps)
    total = len(a) + len(b)
    first = i + j
    never = np.iinfo(np.int64).max
    a, b = np.append(a, never), np.append(b, never)
    shape = (steps, len(i))
    at_a, at_b = np.empty(shape, np.int64), np.empty(shape, np.int64)
    link, close = np.zeros(shape, bool), np.zeros(shape, bool)
    before = np.append(a, -1)  # the end before the first of a, at index -1
    for step in range(steps):
        live = first + step < total
        end_a, end_b = a[i], b[j]
        left = live & (end_a <= end_b)
        right = live & ~left
        both = right & (before[i - 1] == end_b)
        at_a[step], at_b[step] = i, j
        link[step] = live & ~both
        close[step] = both
        i = np.minimum(i + left, len(a) - 1)
        j = np.minimum(j + right, len(b) - 1)
    # Pieces one after another.
    link, close = link.T.ravel(), close.T.ravel()
    at_a, at_b = at_a.T.ravel(), at_b.T.ravel()
    return at_a[link], at_b[link], at_a[close], at_b[close] + 1


class Aligned:
    """Distinct segments with their tokens, groups and pairs; ``add`` takes new ones."""

    def __init__(self, both: Sides):
        self.both = both
        self.names: list[str] = []
        self.totals: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def add(self, parts: list[str]) -> None:
        for k in range(0, len(parts), _SEGMENTS):
            self._add(parts[k : k + _SEGMENTS])

    def _add(self, parts: list[str]) -> None:
        both = self.both
        a, b = both.ids(parts)
        texts = [b" " + p.encode() for p in parts]
        good = np.ones(len(parts), bool)
        for ids, names in ((a, both.a_bytes), (b, both.b_bytes)):
            spelled = [b"".join(map(names.__getitem__, x)) for x in ids]
            if spelled != texts:
                good &= np.fromiter((x == y for x, y in zip(spelled, texts)), bool, len(parts))
        kept = np.flatnonzero(good).tolist()
        a_ids, a_sizes = _flat([a[k] for k in kept])
        b_ids, b_sizes = _flat([b[k] for k in kept])
        a_len = np.array([len(x) for x in both.a_bytes])
        b_len = np.array([len(x) for x in both.b_bytes])
        totals = np.zeros((len(parts), 4), np.int64)
        sizes = np.zeros(len(parts), np.int64)
        strings = [""] * len(parts)
        pair = np.zeros(0, np.int64)
        if kept:
            left, right, a_cut, b_cut = merge(np.cumsum(a_len[a_ids]), np.cumsum(b_len[b_ids]))
            pair = a_ids[left] << _SHIFT | b_ids[right]
            owner_a = np.repeat(np.arange(len(kept)), a_sizes)
            per = np.bincount(owner_a[left], minlength=len(kept))
            last = np.bincount(owner_a[a_cut - 1], minlength=len(kept))
            totals[kept] = np.stack([a_sizes, b_sizes, last, per], axis=1)
            sizes[kept] = per
            for k, text in zip(kept, self._groups(a_ids, b_ids, a_cut, b_cut, np.cumsum(a_sizes))):
                strings[k] = text
        totals[~good, 0] = -1
        self.names += strings
        self.totals.append(totals)
        self.sizes.append(sizes)
        self.pairs.append(pair)

    def _groups(self, a, b, a_cut, b_cut, ends) -> list[str]:
        """The groups of each segment as text: a group's ids of a, then those of b."""
        both = self.both
        before = lambda x: np.concatenate([[0], x[:-1]])
        a_size, b_size = a_cut - before(a_cut), b_cut - before(b_cut)
        place = np.empty(len(a) + len(b), np.int64)
        at_a = np.arange(len(a)) + np.repeat(before(b_cut), a_size)
        at_b = np.arange(len(b)) + np.repeat(a_cut, b_size)
        tail = np.zeros(len(a), np.int64)
        tail[a_cut - 1] = 1
        place[at_a] = a + tail * len(both.a_bytes)
        tail = np.zeros(len(b), np.int64)
        tail[b_cut - 1] = 1
        tail[b_cut[np.isin(a_cut, ends)] - 1] = 2
        place[at_b] = b + tail * len(both.b_bytes) + len(both.a_names)
        names = both.a_names + both.b_names
        return "".join(map(names.__getitem__, place.tolist())).split("\n")[:-1]


def _chunk(batch: pa.RecordBatch, number: int, both: Sides, with_groups: bool) -> tuple:
    numbers: defaultdict[str, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    offsets, data = raw(batch.column("text"))
    owned: list[np.ndarray] = []
    for i, j in zip(offsets.tolist(), offsets[1:].tolist()):
        if i == j:
            owned.append(np.zeros(0, np.int32))
            continue
        text = data[i:j].tobytes().decode("utf-8", "replace")
        owned.append(
            np.concatenate(
                [np.fromiter(map(numbers.__getitem__, x), np.int32, len(x)) for x in segments(text)]
            )
        )
    found = Aligned(both)
    found.add(list(numbers))
    names = found.names
    totals = np.concatenate([np.zeros((0, 4), np.int64), *found.totals])
    pairs = np.concatenate([np.zeros(0, np.int64), *found.pairs])
    sizes = np.concatenate([np.zeros(0, np.int64), *found.sizes])
    bad = totals[:, 0] < 0
    sums = np.zeros((len(owned), 4), np.int64)
    digests, groups = [], []
    for k, own in enumerate(owned):
        if not len(own) or bad[own].any():
            owned[k] = own[:0]
            digests.append("")
            groups.append("")
            continue
        sums[k] = totals[own].sum(axis=0)
        sha = hashlib.sha256()
        for at in range(0, len(own), 1 << 18):
            text = ";".join(map(names.__getitem__, own[at : at + (1 << 18)].tolist()))
            sha.update((";" * (at > 0) + text).encode())
        digests.append(sha.hexdigest())
        if with_groups:
            groups.append(";".join(map(names.__getitem__, own.tolist())))
    # Each document's distinct segments and how often it has each.
    doc = np.repeat(np.arange(len(owned)), list(map(len, owned)))
    key, often = np.unique(doc << _SHIFT | np.concatenate([np.zeros(0, np.int64), *owned]), return_counts=True)
    doc, seg = key >> _SHIFT, key & 0xFFFFFFFF
    total = np.zeros(len(sizes), np.int64)
    np.add.at(total, seg, often)
    distinct, which = np.unique(pairs, return_inverse=True)
    times = np.zeros(len(distinct), np.int64)
    np.add.at(times, which, np.repeat(total, sizes))
    return (
        number, batch.column("doc_id").to_pylist(), sums.tobytes(), digests,
        groups if with_groups else None,
        shrink(np.bincount(doc, minlength=len(owned)), seg, often), shrink(sizes, which),
        distinct, times,
    )


def _chunked(docs: DataFrame, a: str, b: str, with_groups: bool, chunk_bytes: int) -> DataFrame:
    def run(batches):
        both = sides(a, b)
        number = TaskContext.get().partitionId() << 32
        for batch in chunks(batches, chunk_bytes):
            yield rows(_CHUNK, [_chunk(batch, number, both, with_groups)])
            number += 1

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _KIND)


def _summed(with_groups: bool):
    """Each document's sums over its links, from the counts of its chunk's pairs."""

    def one(batches):
        for batch in batches:
            answers = batch.column("answers")
            for k, row in enumerate(each([batch.drop_columns(["answers"])])):
                yield row, answers[k].values

    def run(batches):
        for row, answers in one(batches):
            sizes, which = (x.astype(np.int64) for x in grow(row["segments"], 2))
            count = np.zeros(int(which.max(initial=-1)) + 1, np.int64)
            best = np.zeros(len(count), np.int64)
            if answers is not None:
                at = answers.field("at").to_numpy()
                count[at], best[at] = answers.field("n").to_numpy(), answers.field("best").to_numpy()
            many, seg, often = (x.astype(np.int64) for x in grow(row["docs"], 3))
            ends, doc_ends = np.cumsum(sizes), np.cumsum(many)
            out = []
            for value in (best, count):
                sums = np.concatenate([[0], np.cumsum(value[which])])
                of = sums[ends] - sums[ends - sizes]
                sums = np.concatenate([[0], np.cumsum(of[seg] * often)])
                out.append(sums[doc_ends] - sums[doc_ends - many])
            totals = np.frombuffer(row["totals"], np.int64).reshape(-1, 4)
            columns = {
                "doc_id": pa.array(row["doc_id"], pa.int64()),
                **{n: pa.array(totals[:, k]) for k, n in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
                "n_best": pa.array(out[0]), "count_sum": pa.array(out[1]),
                "groups_sha256": pa.array(row["digests"], pa.string()),
            }
            if with_groups:
                columns["groups"] = pa.array(row["groups"], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def pair_counts(chunked: DataFrame) -> DataFrame:
    """(pair, n, best): links of each id pair, and whether no other pair of its id of b has more."""
    entry = F.explode(F.arrays_zip("pair", "times")).alias("x")
    counted = chunked.select(entry).where("x.times > 0").groupBy(F.col("x.pair").alias("pair")).agg(
        F.sum("x.times").alias("n")
    )
    counted = written(counted, "pair-counts")
    own = F.col("pair").bitwiseAND((1 << _SHIFT) - 1).alias("b")
    # One row for each id of b: no more than its vocabulary.
    most = counted.groupBy(own).agg(F.max("n").alias("most"))
    return counted.join(F.broadcast(most), own == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best")
    )


def align_documents(
    docs: DataFrame,
    a: str = BYTE_BPE,
    b: str = PIECE_BPE,
    with_groups: bool = False,
    chunk_bytes: int = 8 << 20,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, on demand, groups).

    The tokens of a blank and the text, by a byte-level file ``a`` and a piece model ``b`` that adds
    the blank itself. Places where tokens of both end cut them into groups, written as
    ``a1,a2|b1;a3|b2``. A link is a pair of tokens whose bytes overlap; an id pair's count is that
    of its links in all rows. ``n_best`` counts a document's links whose count no other pair with
    the same id of ``b`` exceeds, ``count_sum`` adds up the counts of its links.

    A null or empty text, and one whose tokens do not spell a blank and the text, has no tokens:
    zeros and empty strings. Every row counts, also a repeated one or one with a null doc_id. Other
    columns are ignored; an empty table gives no rows. Long texts are split at blanks piece by piece;
    a stretch without blanks is encoded whole. Runs the passes up to the pair counts when called.
    """
    chunked = written(_chunked(docs, a, b, with_groups, chunk_bytes), "aligned")
    known = pair_counts(chunked)
    asked = chunked.select("chunk", F.posexplode("pair").alias("at", "pair"))
    # As many entries as the chunk has distinct pairs. Pairs of texts that do not count have no n.
    answers = asked.join(known, "pair").groupBy("chunk").agg(
        F.collect_list(F.struct("at", "n", "best")).alias("answers")
    )
    kept = ["chunk", "doc_id", "totals", "digests", "docs", "segments"] + ["groups"] * with_groups
    kind = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string" + ", groups string" * with_groups
    )
    return chunked.select(*kept).join(answers, "chunk", "left").mapInArrow(_summed(with_groups), kind)
