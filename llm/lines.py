"""Lines that many documents share, found by two Bloom filters and confirmed exactly.

Documents become chunks, each with the hashes of its distinct keys. Hashes are dealt out in slices
of their range; a slice folds them into a filter of keys seen in one document and a filter of keys
seen in two or more, both sized by its own keys, and tells every chunk which of its keys the second
filter holds. Only these, the suspected repeats, are shuffled as text: one row for each chunk and
key, with the number of documents and the first place. Their sums decide, so that a wrong suspicion
costs a row and nothing else. Chunks lie bucketed in the shared folder; texts are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.session import written
from llm.common import chunks, each, grow, in_place, mix, raw, rows, shrink

MIN_DOCS = 10
MIN_CHARS = 1
#: Keys whose filters a task holds at a time, and the bits of each filter for a key.
SLICE = 1 << 22
BITS = 16
_HASHES = 3
_BLANK = b" \t\n\x0b\x0c\r"
#: A longer text is split this many bytes at a time.
_PART = 4 << 20

_CHUNK = pa.schema(
    [
        ("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("sizes", pa.binary()),
        ("body", pa.binary()), ("hashes", pa.binary()), ("twice", pa.binary()), ("n", pa.int64()),
    ]
)
_KIND = (
    "chunk long, doc_id array<long>, sizes binary, body binary, hashes binary, twice binary, n long"
)


def split(data: bytes) -> Iterator[bytes]:
    r"""The lines of a text, cut at ``\n``; long texts are taken apart piece by piece."""
    first = 0
    while len(data) - first > _PART:
        cut = data.find(b"\n", first + _PART)
        if cut < 0:
            break
        yield from data[first:cut].split(b"\n")
        first = cut + 1
    yield from (data[first:] if first else data).split(b"\n")


def key(line: bytes) -> bytes:
    """The line without white space at both ends, A-Z in lower case."""
    return line.strip(_BLANK).lower()


def _texts(row: dict) -> Iterator[bytes]:
    body = zstandard.decompress(row["body"])
    ends = np.cumsum(np.frombuffer(row["sizes"], np.int64)).tolist()
    for a, b in zip([0, *ends], ends):
        yield body[a:b]


def _found(texts, min_chars: int) -> dict[bytes, tuple[int, int, int]]:
    """Of each key the number of texts that hold it, and text and line where it comes first."""
    out: dict[bytes, tuple[int, int, int]] = {}
    for k, text in enumerate(texts):
        own: dict[bytes, int] = {}
        for at, line in enumerate(split(text)):
            own.setdefault(key(line), at)
        for name, at in own.items():
            if name and (min_chars <= 1 or len(name.decode("utf-8", "replace")) >= min_chars):
                seen = out.get(name)
                out[name] = (1, k, at) if seen is None else (seen[0] + 1, seen[1], seen[2])
    return out


def _hash(names) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))


def _chunked(docs: DataFrame, min_chars: int, chunk_bytes: int) -> DataFrame:
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in chunks(batches, chunk_bytes):
            offsets, data = raw(batch.column("text"))
            edges = offsets.tolist()
            found = _found((data[a:b].tobytes() for a, b in zip(edges, edges[1:])), min_chars)
            hashes, at, many = np.unique(_hash(found), return_inverse=True, return_counts=True)
            twice = many > 1
            twice[at[np.fromiter((n > 1 for n, *_ in found.values()), bool, len(found))]] = True
            yield rows(
                _CHUNK,
                [
                    (
                        number, batch.column("doc_id").to_pylist(), np.diff(offsets).tobytes(),
                        zstandard.compress(data, 3), hashes.tobytes(),
                        np.packbits(twice).tobytes(), len(hashes),
                    )
                ],
            )
            number += 1

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _KIND)


def _dealt(chunked: DataFrame, slices: int) -> DataFrame:
    """Each chunk's hashes by slice: 32 bits of each, in order, as differences."""
    schema = pa.schema(
        [("slice", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("twice", pa.binary())]
    )

    def run(batches):
        for row in each(batches):
            hashes = np.frombuffer(row["hashes"], np.uint64)
            twice = np.unpackbits(np.frombuffer(row["twice"], np.uint8), count=len(hashes))
            where = (hashes >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)
            cuts = np.searchsorted(where, np.arange(slices + 1).astype(np.uint64))
            out = []
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                i, j = cuts[s], cuts[s + 1]
                low = np.sort((hashes[i:j] & np.uint64(0xFFFFFFFF)).astype(np.int64))
                order = np.argsort(hashes[i:j] & np.uint64(0xFFFFFFFF), kind="stable")
                out.append(
                    (
                        s, row["chunk"], shrink(np.diff(low, prepend=0), order),
                        np.packbits(twice[i:j][order]).tobytes(),
                    )
                )
            if out:
                yield rows(schema, out)

    return chunked.select("chunk", "hashes", "twice").mapInArrow(
        run, "slice int, chunk long, keys binary, twice binary"
    )


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key."""
    salts = (np.arange(1, _HASHES + 1, dtype=np.uint64) << np.uint64(32))[:, None]
    return (mix(salts + keys.astype(np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def _suspected(group: pa.Table) -> pa.Table:
    """Fold a slice's keys into both filters; then mark every chunk's keys that were seen twice."""
    blobs = [grow(x, 2) for x in group.column("keys").to_pylist()]
    keys = [np.cumsum(steps.astype(np.int64)) for steps, _ in blobs]
    bits = 1 << max(10, int(BITS * sum(map(len, keys)) - 1).bit_length())
    once, twice = np.zeros(bits, bool), np.zeros(bits, bool)
    for own, flags in zip(keys, group.column("twice").to_pylist()):
        at = _places(own, bits)
        again = np.unpackbits(np.frombuffer(flags, np.uint8), count=len(own)).astype(bool)
        again |= once[at].all(axis=0)
        twice[at[:, again]] = True
        once[at] = True
    masks = []
    for own, (_, order) in zip(keys, blobs):
        mask = np.zeros(len(own), bool)
        mask[order] = twice[_places(own, bits)].all(axis=0)
        masks.append(np.packbits(mask).tobytes())
    sizes = pa.array(list(map(len, keys)), pa.int32())
    out = group.select(["chunk", "slice"]).append_column("size", sizes)
    return out.append_column("mask", pa.array(masks, pa.binary()))


def _asked(min_chars: int):
    """The suspected keys of each chunk, with their documents counted."""
    schema = pa.schema(
        [
            ("key", pa.binary()), ("chunk", pa.int64()), ("n_docs", pa.int64()),
            ("no_id", pa.bool_()), ("doc_id", pa.int64()), ("row", pa.int64()), ("line", pa.int64()),
        ]
    )

    def run(batches):
        for row in each(batches):
            parts = sorted(row["answers"] or [], key=lambda x: x["slice"])
            masks = [
                np.unpackbits(np.frombuffer(x["mask"], np.uint8), count=x["size"]) for x in parts
            ]
            mask = np.concatenate([np.zeros(0, np.uint8), *masks]).astype(bool)
            if not mask.any():
                continue
            suspects = np.frombuffer(row["hashes"], np.uint64)[mask]
            found = _found(_texts(row), min_chars)
            hit = np.isin(_hash(found), suspects).tolist()
            ids = row["doc_id"]
            yield rows(
                schema,
                [
                    (name, row["chunk"], n, ids[k] is None, ids[k], k, at)
                    for (name, (n, k, at)), mine in zip(found.items(), hit) if mine
                ],
            )

    return run


def _result(keep_first: bool, with_text: bool):
    def run(batches):
        for row in each(batches):
            gone = {x["key"]: (x["row"], x["line"]) for x in row["gone"] or []}
            out: list[tuple] = []
            for k, text in enumerate(_texts(row)):
                n = dropped = 0
                kept = []
                for at, line in enumerate(split(text)):
                    n += 1
                    first = gone.get(key(line))
                    if first is None or keep_first and first == (k, at):
                        kept.append(line)
                    else:
                        dropped += 1
                left = b"\n".join(kept) if dropped else text
                out.append((row["doc_id"][k], n, dropped, hashlib.sha256(left).hexdigest(), left))
            ids, lines, counts, digests, texts = zip(*out)
            columns = {
                "doc_id": pa.array(ids, pa.int64()), "n_lines": pa.array(lines, pa.int64()),
                "n_dropped": pa.array(counts, pa.int64()), "kept_sha256": pa.array(digests),
            }
            if with_text:
                columns["text"] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def drop_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    keep_first: bool = False,
    with_text: bool = False,
    chunk_bytes: int = 8 << 20,
) -> DataFrame:
    r"""(doc_id, n_lines, n_dropped, kept_sha256 and, on demand, text) for each row of ``docs``.

    A line's key is the line without white space at both ends, A-Z in lower case. Keys of at least
    ``min_chars`` code points that are found in at least ``min_docs`` (two or more) documents lose
    all their lines, or all but the first one with ``keep_first``: that of the smallest doc_id, null
    ids last, of rows with the same id any one. Other lines stay and are joined by ``\n``.

    Every row is a document, also with a null or repeated doc_id. A null or empty text is one empty
    line; blank lines have no key and stay. Other columns are ignored; an empty table gives no rows.
    A long text is split piece by piece; what is held of it is its bytes and its distinct keys.
    Runs the first passes when called.
    """
    if min_docs < 2:
        raise ValueError("a line of one document is not shared")
    chunked = in_place(_chunked(docs, min_chars, chunk_bytes), "lines")
    slices = -(-(chunked.agg(F.sum("n")).first()[0] or 1) // SLICE)
    answers = _dealt(chunked, slices).groupBy("slice").applyInArrow(
        _suspected, "chunk long, slice int, size int, mask binary"
    )
    # One bit for each key of the chunk.
    answers = answers.groupBy("chunk").agg(
        F.collect_list(F.struct("slice", "size", "mask")).alias("answers")
    )
    asked = chunked.select("chunk", "doc_id", "sizes", "body", "hashes").join(answers, "chunk")
    asked = asked.mapInArrow(
        _asked(min_chars),
        "key binary, chunk long, n_docs long, no_id boolean, doc_id long, row long, line long",
    )
    asked = written(asked, "suspected-lines")
    place = F.struct("no_id", "doc_id", "chunk", "row", "line")
    shared = asked.groupBy("key").agg(F.sum("n_docs").alias("all"), F.min(place).alias("first"))
    shared = shared.where(F.col("all") >= min_docs).select("key", "first")
    mine = F.col("first.chunk") == F.col("chunk")
    gone = asked.select("key", "chunk").join(shared, "key").groupBy("chunk").agg(
        F.collect_list(
            F.struct(
                "key", F.when(mine, F.col("first.row")).alias("row"),
                F.when(mine, F.col("first.line")).alias("line"),
            )
        ).alias("gone")
    )
    kind = "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + ", text string" * with_text
    left = chunked.select("chunk", "doc_id", "sizes", "body").join(gone, "chunk", "left")
    return left.mapInArrow(_result(keep_first, with_text), kind)
