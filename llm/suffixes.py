"""Removal of repeated byte strings by a hash-compared suffix sort.

Which windows of 100 bytes also start earlier is found among suffixes that can share one:

1. A window belongs to the place of the smallest hash of the 32-byte strings in it. Consecutive
   windows of one place form a fragment. Equal windows belong to equal strings, so fragments are
   dealt out by the hash of that string; of equal fragments, which a 128-bit BLAKE2 digest of their
   bytes tells, all but the first repeat wholly.
2. Strings with several different fragments come with their text. The suffixes at the fragments'
   windows, aligned by the shared string, are sorted by merging sorted runs. Two suffixes are
   compared by a binary search, over prefix hashes, for their longest common extension, and by the
   byte after it. Neighbours that agree over a whole window are compared byte by byte.
3. The repeated windows of each document are united and cut out.

A passage that very many documents hold is one fragment for each chunk in step 1, because the
chunks drop their own repetitions. At its edges every document has another fragment; a string with
more than ``CROWD`` of them is taken apart into single windows, dealt out by their own hash. Of
equal windows (compared byte by byte) only the first in each group of documents is dealt out, so
that a window costs one row for each group; the others are repeated spans at once.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.session import written
from llm.common import CHUNK, PrefixHash, chunks, keyed, mix, raw

WINDOW = 100
ANCHOR = 32
CROWD = 4096
#: Suffixes sorted at a time; those of one string always together.
BLOCK = 200_000
_SPREAD = WINDOW - ANCHOR + 1
_POSITION = np.uint64((1 << 26) - 1)
_LOW48 = np.uint64((1 << 48) - 1)


def _pack(*columns: tuple[np.ndarray, int]) -> bytes:
    """Columns of non-negative numbers of so many bytes, stored by byte plane and compressed."""
    n = len(columns[0][0])
    planes = [
        np.ascontiguousarray(c).astype("<u8").view(np.uint8).reshape(n, 8)[:, :w].T.tobytes()
        for c, w in columns
    ]
    return zstandard.compress(n.to_bytes(8, "little") + b"".join(planes), 1)


def _unpack(blobs: list[bytes], *widths: int) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)] for _ in widths]
    for blob in blobs:
        data = np.frombuffer(zstandard.decompress(blob), np.uint8)
        n, at = int(data[:8].view("<u8")[0]), 8
        for out, w in zip(parts, widths):
            whole = np.zeros((n, 8), np.uint8)
            whole[:, :w] = data[at : at + n * w].reshape(w, n).T
            out.append(whole.view("<u8").ravel())
            at += n * w
    return [np.concatenate(p) for p in parts]


_SIGN = np.uint64(1 << 63)


def _unsigned(keys: np.ndarray) -> np.ndarray:
    """Keys as unsigned numbers in the same order, negative ones first."""
    return keys.astype(np.int64).view(np.uint64) ^ _SIGN


def _groups(key: np.ndarray, count: int) -> list[tuple[int, np.ndarray]]:
    """The rows of each group of documents: (group, row numbers). As pmod of the signed keys."""
    group = (key ^ _SIGN).view(np.int64) % count
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[order], np.arange(count + 1)).tolist()
    return [(g, order[i:j]) for g, (i, j) in enumerate(zip(edges, edges[1:])) if j > i]


def _slices(batches):
    """(keys, bytes, offsets, first byte) of about 2 MB; a longer text comes in several, which
    overlap by one byte less than a window, so that each window is in one of them."""
    for batch in chunks(batches):
        keys = _unsigned(batch.column("key").to_numpy())
        offsets, data = raw(batch.column("text"))
        if len(data) <= 2 * CHUNK:
            yield keys, data, offsets, 0
            continue
        for at in range(0, len(data), CHUNK):  # one text alone
            part = data[at : at + CHUNK + WINDOW - 1]
            yield keys, part, np.array([0, len(part)]), at


def fragments(data: np.ndarray, offsets: np.ndarray):
    """Runs of windows with one smallest string: row, first window, windows, place and its hash,
    and a digest of all bytes as two numbers."""
    n = len(data) - WINDOW + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, none.astype(np.uint64), np.zeros((0, 2), np.uint64)
    hashes = PrefixHash(data)
    least = (mix(hashes.windows(ANCHOR)) & ~_POSITION) | np.arange(
        len(data) - ANCHOR + 1, dtype=np.uint64
    )
    width = 1
    while 2 * width <= _SPREAD:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    rest = _SPREAD - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = row[:n] == row[WINDOW - 1 :]
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:n] != row[: n - 1])
    first = np.flatnonzero(new & whole)
    edges = np.append(np.flatnonzero(new | ~whole), n)
    last = edges[np.searchsorted(edges, first, "right")]
    place = (least[first] & _POSITION).astype(np.int64)
    string = mix(hashes.spans(place, place + ANCHOR))
    view, digest = memoryview(np.ascontiguousarray(data)), functools.partial(hashlib.blake2b, digest_size=16)
    ends = (last + WINDOW - 1).tolist()
    body = b"".join([digest(view[a:b]).digest() for a, b in zip(first.tolist(), ends)])
    body = np.frombuffer(body, np.uint64).reshape(-1, 2)
    return row[first], first, last - first, place - first, string, body


def _repeats(string: np.ndarray, body: np.ndarray, key: np.ndarray, start: np.ndarray):
    """Order by string, body, document and place; there, which begin a string and a body."""
    order = np.lexsort((start, key, body[:, 1], body[:, 0], string))
    s, b = string[order], body[order]
    new_string = np.ones(len(order), bool)
    new_string[1:] = s[1:] != s[:-1]
    new_body = new_string.copy()
    new_body[1:] |= (b[1:] != b[:-1]).any(axis=1)
    return order, new_string, new_body


_SPAN = (8, 6, 5)  # document, first window, windows
_CANDIDATE = (8, 6, 2, 1, 6, 1)  # document, first window, windows, place, string, crowd


def _spans(key, start, count, groups: int) -> list[tuple[int, int, bytes]]:
    return [
        (g, 0, _pack(*((x[i], w) for x, w in zip((key, start, count), _SPAN))))
        for g, i in _groups(key, groups)
    ]


def _first_pass(docs: DataFrame, groups: int, count: int) -> DataFrame:
    """(group, kind, blob) by group of documents: repeated spans (0) and fragments to compare (1)."""

    def deal(batches):
        for keys, data, offsets, at in _slices(batches):
            row, first, size, place, string, body = fragments(data, offsets)
            if len(row) == 0:
                continue
            key, start = keys[row], (first - offsets[row] + at).astype(np.uint64)
            order, _, new = _repeats(string, body, key, start)
            again, own = order[~new], order[new]
            out = []
            bucket = (string % np.uint64(count)).astype(np.int64)
            edges = np.searchsorted(bucket[own][np.argsort(bucket[own], kind="stable")], np.arange(count + 1))
            own = own[np.argsort(bucket[own], kind="stable")]
            for b in range(count):
                i = own[edges[b] : edges[b + 1]]
                if len(i):
                    out.append((b, None, _pack(
                        (key[i], 8), (start[i], 6), (size[i], 2), (place[i], 1),
                        (string[i] & _LOW48, 6), (body[i, 0], 8), (body[i, 1], 8),
                    )))
            for g, _, blob in _spans(key[again], start[again], size[again], groups):
                out.append((g % count, g, blob))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()))],
                ["bucket", "group", "blob"],
            )

    def settle(table: pa.Table) -> pa.Table:
        group, blobs = table.column("group").to_pylist(), table.column("blob").to_pylist()
        out = [(g, 0, b) for g, b in zip(group, blobs) if g is not None]
        key, start, size, place, string, *body = _unpack(
            [b for g, b in zip(group, blobs) if g is None], 8, 6, 2, 1, 6, 8, 8
        )
        body = np.stack(body, axis=1)
        order, new_string, new_body = _repeats(string, body, key, start)
        again = order[~new_body]
        out += _spans(key[again], start[again], size[again], groups)
        number = np.cumsum(new_string) - 1
        different = np.bincount(number, new_body, minlength=1)[number] if len(order) else number
        compare = new_body & (different > 1)
        i, crowd = order[compare], (different > CROWD)[compare]
        for g, k in _groups(key[i], groups):
            j = i[k]
            columns = (key[j], start[j], size[j], place[j], string[j], crowd[k])
            out.append((g, 1, _pack(*zip(columns, _CANDIDATE))))
        columns = list(zip(*out)) or [(), (), ()]
        kinds = (pa.int32(), pa.int32(), pa.binary())
        return pa.table({n: pa.array(list(c), t) for n, c, t in zip(("group", "kind", "blob"), columns, kinds)})

    dealt = docs.select("key", "text").mapInArrow(deal, "bucket int, group int, blob binary")
    return dealt.groupBy("bucket").applyInArrow(settle, "group int, kind int, blob binary")


def _documents(table: pa.Table):
    """Keys in order, and where each text lies in the joined bytes."""
    table = table.sort_by("key").combine_chunks()
    offsets, data = raw(_one(table.column("text")))
    return table, _unsigned(_one(table.column("key")).to_numpy()), offsets, data


def _one(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _cut_out(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of runs that begin at ``at``."""
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(at, size) + inner


def _again(data, at, string, key, start) -> np.ndarray:
    """Of single windows: which equal, byte by byte, the first with their hash."""
    order = np.lexsort((start, key, string))
    new = np.ones(len(order), bool)
    new[1:] = string[order][1:] != string[order][:-1]
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    out = np.zeros(len(order), bool)
    out[order[~new]] = _equal(data, at[order[~new]], at[first[~new]], WINDOW)
    return out


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Which pairs of places agree over ``length``, byte by byte."""
    out = np.ones(len(a), bool)
    reach = np.arange(length)
    for at in range(0, len(a), 1 << 16):
        x, y = a[at : at + (1 << 16), None], b[at : at + (1 << 16), None]
        out[at : at + (1 << 16)] = (data[x + reach] == data[y + reach]).all(axis=1)
    return out


def _runs(key: np.ndarray, window: np.ndarray):
    """Windows of documents as runs: document, first window, windows."""
    order = np.lexsort((window, key))
    key, window = key[order], window[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    return key[first], window[first].astype(np.uint64), np.diff(np.append(first, len(key)))


_FRAGMENT = (8, 6, 2, 1, 8)  # document, first window, windows, place, string


def _with_text(count: int):
    """Fragments of a group of documents with their bytes, by hash of their string; and spans that
    repeat an earlier one of the group, without."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        _, keys, offsets, data = _documents(docs)
        key, start, size, place, string, crowd = _unpack(found.column("blob").to_pylist(), *_CANDIDATE)
        start, size, place = start.astype(np.int64), size.astype(np.int64), place.astype(np.int64)
        at = offsets[np.searchsorted(keys, key)] + start
        out = []
        if crowd.any():
            many = crowd == 1
            windows = _cut_out(at[many], size[many])
            of = np.repeat(np.flatnonzero(many), size[many])
            lengths = size[many] + WINDOW - 1
            own = PrefixHash(data[_cut_out(at[many], lengths)]).windows(WINDOW)
            own = own[_cut_out(np.cumsum(lengths) - lengths, size[many])]
            few, own, window = ~many, mix(own), start[of] + windows - at[of]
            again = _again(data, windows, own, key[of], window)
            if again.any():
                spans = _runs(key[of][again], window[again])
                out.append((int(keys[0] % np.uint64(count)), _pack(*zip(spans, _SPAN)), None))
            of, own, window, windows = of[~again], own[~again], window[~again], windows[~again]
            key = np.concatenate([key[few], key[of]])
            start = np.concatenate([start[few], window])
            string = np.concatenate([string[few], own])
            at = np.concatenate([at[few], windows])
            size = np.concatenate([size[few], np.ones(len(windows), np.int64)])
            place = np.concatenate([place[few], np.zeros(len(windows), np.int64)])
        bucket = (mix(string) % np.uint64(count)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(count + 1))
        for b in range(count):
            i = order[edges[b] : edges[b + 1]]
            if len(i):
                text = data[_cut_out(at[i], size[i] + WINDOW - 1)].tobytes()
                columns = (key[i], start[i], size[i], place[i], string[i])
                out.append((b, _pack(*zip(columns, _FRAGMENT)), zstandard.compress(text, 1)))
        columns = list(zip(*out)) or [(), (), ()]
        kinds = (pa.int32(), pa.binary(), pa.binary())
        return pa.table({n: pa.array(list(c), t) for n, c, t in zip(("bucket", "blob", "text"), columns, kinds)})

    return run


class Suffixes:
    """Suffixes of a byte array, compared over the length of a window."""

    def __init__(self, data: np.ndarray, length: int = WINDOW):
        self.data, self.length = data, length
        self.hashes = PrefixHash(data)
        self.steps = [1 << k for k in reversed(range(length.bit_length()))]

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The length of the common prefix, the window's at most."""
        sums, down = self.hashes.sums, self.hashes.down
        common = np.zeros(len(a), np.int64)
        for step in self.steps:
            x, y = a + common, b + common
            fits = np.flatnonzero(common + step <= self.length)
            x, y = x[fits], y[fits]
            same = (sums[x + step] - sums[x]) * down[x] == (sums[y + step] - sums[y]) * down[y]
            common[fits[same]] += step
        return common

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        """Which suffixes a come before b."""
        common = self.extension(a, b)
        ended = common >= self.length
        at = np.minimum(common, self.length - 1)
        less = self.data[a + at] < self.data[b + at]
        return np.where(ended, or_equal, less)

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which agree over the whole window, byte by byte."""
        return _equal(self.data, a, b, self.length)

    def sort(self, suffix: np.ndarray, part: np.ndarray) -> np.ndarray:
        """A stable order of suffixes within parts; equal parts are adjacent.

        Runs double in size: each suffix finds its place in the run beside its own by binary
        search.
        """
        n = len(suffix)
        order = np.arange(n)
        first = np.ones(n, bool)
        first[1:] = part[1:] != part[:-1]
        begin = np.flatnonzero(first)[np.cumsum(first) - 1]
        size = np.bincount(np.cumsum(first) - 1)[np.cumsum(first) - 1]
        local = np.arange(n) - begin
        width = 1
        while n and width < size.max():
            right = (local // width) % 2 == 1
            base = local - local % (2 * width)
            low = np.where(right, base, base + width)
            high = np.minimum(np.where(right, base + width, base + 2 * width), size)
            low, high = begin + np.minimum(low, size), begin + high
            own_low = low.copy()
            while True:
                open_ = np.flatnonzero(low < high)
                if len(open_) == 0:
                    break
                middle = (low[open_] + high[open_]) // 2
                me, other = suffix[order[open_]], suffix[order[middle]]
                goes = np.empty(len(open_), bool)
                r = right[open_]
                goes[r] = self.before(other[r], me[r], True)
                goes[~r] = self.before(other[~r], me[~r], False)
                low[open_[goes]] = middle[goes] + 1
                high[open_[~goes]] = middle[~goes]
            rank = begin + base + (local - base - np.where(right, width, 0)) + (low - own_low)
            merged = np.empty(n, np.int64)
            merged[rank] = order
            order = merged
            width *= 2
        return order


def repeated_windows(data, at, size, place, string, key, start):
    """Of fragments in ``data``: (document, window) of all windows that an earlier one equals."""
    suffix = _cut_out(at, size)
    inner = suffix - np.repeat(at, size)
    string, align = np.repeat(string, size), np.repeat(place, size) - inner
    key, window = np.repeat(key, size), np.repeat(start, size) + inner
    order = np.lexsort((window, key, align, string))
    new = np.ones(len(order), bool)
    s, a = string[order], align[order]
    new[1:] = (s[1:] != s[:-1]) | (a[1:] != a[:-1])
    part = np.cumsum(new) - 1
    several = np.bincount(part, minlength=1)[part] > 1 if len(part) else new
    order, part = order[several], part[several]
    suffixes = Suffixes(data)
    order_in = suffixes.sort(suffix[order], part)
    sorted_ = suffix[order][order_in]
    beside = np.flatnonzero(part[1:] == part[:-1])
    alike = suffixes.extension(sorted_[beside], sorted_[beside + 1]) >= WINDOW
    beside = beside[alike]
    if not suffixes.equal(sorted_[beside], sorted_[beside + 1]).all():
        raise ArithmeticError("two different windows have equal hashes; choose other hash values")
    again = order[order_in[beside + 1]]
    return key[again], window[again]


def _compare(groups: int):
    def run(table: pa.Table) -> pa.Table:
        blobs, texts = table.column("blob").to_pylist(), table.column("text").to_pylist()
        known = _unpack([b for b, x in zip(blobs, texts) if x is None], *_SPAN)
        key, start, size, place, string = _unpack(
            [b for b, x in zip(blobs, texts) if x is not None], *_FRAGMENT
        )
        data = np.frombuffer(
            b"".join(zstandard.decompress(x) for x in texts if x is not None), np.uint8
        )
        size, place, start = (x.astype(np.int64) for x in (size, place, start))
        at = np.cumsum(size + WINDOW - 1) - (size + WINDOW - 1)
        # Single windows need no sort: many groups of documents may hold the same.
        single = np.flatnonzero(size == 1)
        again = single[_again(data, at[single], string[single], key[single], start[single])]
        found = [(key[again], start[again])]
        rest = np.ones(len(key), bool)
        rest[again] = False
        at, key, start, size, place, string = (x[rest] for x in (at, key, start, size, place, string))
        order = np.argsort(string, kind="stable")
        new = np.flatnonzero(np.append(True, string[order][1:] != string[order][:-1])[: len(order)])
        done = np.cumsum(size[order])
        first = 0
        while first < len(order):
            before = done[first - 1] if first else 0
            after = np.append(new[new > first], len(order))
            fits = after[done[after - 1] - before <= BLOCK]
            last = int(fits[-1] if len(fits) else after[0])
            i = order[first:last]
            lengths = size[i] + WINDOW - 1
            text = data[_cut_out(at[i], lengths)]
            found.append(
                repeated_windows(
                    text, np.cumsum(lengths) - lengths, size[i], place[i], string[i], key[i], start[i]
                )
            )
            first = last
        runs = _runs(*(np.concatenate(x) for x in zip(*found)))
        out = _spans(*(np.concatenate(x) for x in zip(known, runs)), groups)
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table(
            {"group": pa.array(list(columns[0]), pa.int32()), "blob": pa.array(list(columns[2]), pa.binary())}
        )

    return run


def _removed(with_text: bool):
    """The result for a group of documents from its repeated spans."""

    def run(docs: pa.Table, spans: pa.Table) -> pa.Table:
        table, keys, offsets, data = _documents(docs)
        key, start, count = _unpack(spans.column("blob").to_pylist(), *_SPAN)
        at = offsets[np.searchsorted(keys, key)] + start.astype(np.int64)
        change = np.zeros(len(data) + 1, np.int32)
        np.add.at(change, at, 1)
        np.add.at(change, at + count.astype(np.int64) + WINDOW - 1, -1)
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        begins = gone.copy()
        begins[1:] &= ~gone[:-1] | first[1:-1]
        kept, texts = [], []
        n_removed, n_spans = [], []
        for i, j in zip(offsets.tolist(), offsets[1:].tolist()):
            mine = gone[i:j]
            rest = data[i:j][~mine].tobytes()
            kept.append(hashlib.sha256(rest).hexdigest())
            n_removed.append(int(mine.sum()))
            n_spans.append(int(begins[i:j].sum()))
            if with_text:
                texts.append(rest.decode("utf-8", "ignore"))
        out = {
            "key": table.column("key"), "doc_id": table.column("doc_id"),
            "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(kept, pa.string()),
        }
        if with_text:
            out["text"] = pa.array(texts, pa.string())
        return pa.table(out)

    return run


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(key, doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of ``docs``, and with
    ``with_text`` the text left, without bytes of characters cut apart.

    Each byte covered by a 100-byte string that starts earlier is removed: in a smaller doc_id, or
    earlier in the same text. Strings are judged on the input. Uses doc_id and text; other columns
    are ignored. A null text is empty; a text shorter than 100 bytes stays whole. Rows that repeat
    a doc_id or have none are documents of their own, in the order of ``keyed``. An empty table
    gives no rows.
    """
    return strip(keyed(docs), with_text)


def strip(
    docs: DataFrame,
    with_text: bool = False,
    group_bytes: int = 8 << 20,
    bucket_bytes: int = 8 << 20,
) -> DataFrame:
    """``remove_repeats`` of documents that have their keys (key, doc_id, text).

    A document is held whole by one task at the end, and with others up to about ``group_bytes``.
    Strings are dealt into as many buckets as there are ``bucket_bytes`` of text, 128 at least,
    so that a bucket holds about as many fragments at any size.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(64, -(-size // group_bytes)) | 1
    count = max(128, -(-size // bucket_bytes))
    first = written(_first_pass(docs, groups, count), "repeat-candidates")
    dealt = docs.withColumn("group", F.pmod("key", F.lit(groups)).cast("int")).groupBy("group")
    texts = dealt.cogroup(first.where("kind = 1").groupBy("group")).applyInArrow(
        _with_text(count), "bucket int, blob binary, text binary"
    )
    more = texts.groupBy("bucket").applyInArrow(_compare(groups), "group int, blob binary")
    spans = first.where("kind = 0").select("group", "blob").unionByName(more)
    schema = "key long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return dealt.cogroup(spans.groupBy("group")).applyInArrow(
        _removed(with_text), schema + ", text string" * with_text
    )
