"""Tables, row keys and byte-level helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import fresh_path, written

#: White space between words: space and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 2 << 20

# Freed memory goes back at once: workers stay alive between tasks, beside the executor's heap.
pa.set_memory_pool(pa.system_memory_pool())

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)


def _importable(spark: SparkSession) -> None:
    """Let Python workers find these modules where the driver did, whatever folder it runs in.

    Where executors have no copy at that path, ship the packages with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``docs`` as (key long, doc_id, text): ``key`` is unique and orders rows by (doc_id, text).

    Where every doc_id is set and unique, it is the key. Else rows are sorted once (null ids last,
    equal ids by text, repeated rows in any order) and numbered, so that each stays a document.
    With ``whole``, the struct ``row`` holds all columns. Runs a count of the ids.
    """
    columns = [
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ]
    if whole:
        columns.append(F.struct(*docs.columns).alias("row"))
    seen = docs.agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids")).first()
    docs = docs.select(*columns)
    if seen.n == seen.ids:
        return docs.select(F.col("doc_id").alias("key"), "*")
    order = docs.orderBy(F.col("doc_id").asc_nulls_last(), "text")
    return written(order.select(F.monotonically_increasing_id().alias("key"), "*"), "keyed")


def in_place(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder in buckets by chunk, so that joins by chunk leave it there.

    The catalog's entry goes at once; the frame returned knows files and buckets.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    entry = path.rsplit("/", 1)[1].replace("-", "_")
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(count, "chunk").option("path", path).saveAsTable(entry)
    out = spark.table(entry)
    out.schema  # resolved before the entry goes
    spark.sql(f"DROP TABLE {entry}")
    return out


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and UTF-8 bytes of a text column; null is empty."""
    column = pc.fill_null(column.cast(pa.string()), "")
    if len(column) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], body[at[0] : at[-1]]


def chunks(
    batches: Iterator[pa.RecordBatch], limit: int = CHUNK, column: str = "text"
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text; a longer text is one alone."""
    for batch in batches:
        offsets, _ = raw(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


_SAFE = re.compile(r"(?<=\S) (?=\S)")


def slices(text: str, limit: int = CHUNK) -> Iterator[str]:
    """A text in pieces of about ``limit`` characters, cut before a blank between two characters
    that are not white space; tokens of byte-level files begin there, whatever stands before. A
    stretch without such a place stays whole."""
    first = 0
    while len(text) - first > limit:
        cut = _SAFE.search(text, first + limit)
        if cut is None:
            break
        yield text[first : cut.start()]
        first = cut.start()
    yield text[first:] if first else text


def pieces_of(texts: list[str], limit: int = CHUNK) -> Iterator[tuple[list[int], list[str]]]:
    """Numbers and pieces of texts, about ``limit`` characters at a time."""
    rows_, parts, size = [], [], 0
    for k, text in enumerate(texts):
        for part in slices(text, limit):
            rows_.append(k)
            parts.append(part)
            size += len(part)
            if size >= limit:
                yield rows_, parts
                rows_, parts, size = [], [], 0
    if parts:
        yield rows_, parts


def word_parts(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Row numbers and texts, about ``limit`` bytes at a time; longer texts are cut at white space."""
    offsets, data = raw(column)
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        if offsets[last] - offsets[first] <= limit:
            yield np.arange(first, last), column.slice(first, last - first)
        else:  # one long text
            at, end = int(offsets[first]), int(offsets[last])
            while at < end:
                to = min(at + limit, end)
                while to < end and not _BLANK[data[to]]:
                    blank = np.flatnonzero(_BLANK[data[to : to + limit]])
                    to = min(to + (int(blank[0]) if len(blank) else limit), end)
                yield np.array([first]), pa.array([data[at:to].tobytes()], pa.binary()).cast(pa.string())
                at = to
        first = last


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, made as far as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = -(-n // (1 << 20)) << 20
            steps = np.full(n, self.base, np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps[1:] = self.inverse
            self.down = np.cumprod(steps)
        return self.up, self.down


_POWERS = Powers(0x5851F42D4C957F2D)
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


class PrefixHash:
    """Polynomial hashes of all spans of a byte array from sums over its prefixes."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = _POWERS.upto(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * self.up[: len(data)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal spans have equal values; the length is not mixed in."""
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def windows(self, size: int) -> np.ndarray:
        """The hash of each window of ``size`` bytes, by start."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[size:] - self.sums[:n]) * self.down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of a text column with A-Z in lower case: row and 64-bit hash of each word, in order."""
    offsets, data = raw(column)
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    data = _LOWER[data]
    inside = ~_BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.concatenate([inside[1:], [False]])
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    hashes = PrefixHash(data).spans(starts, ends)
    hashes = mix(hashes + (ends - starts).astype(np.uint64) * _MULTIPLIER)
    return np.searchsorted(offsets, starts, "right") - 1, hashes


def packed(bucket: np.ndarray, count: int, *columns: np.ndarray) -> Iterator[tuple]:
    """(bucket, blob of each column) of the rows, by bucket."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(count + 1))
    columns = [c[order] for c in columns]
    for b in np.flatnonzero(edges[1:] > edges[:-1]):
        yield (int(b), *(c[edges[b] : edges[b + 1]].tobytes() for c in columns))


def joined(column, kind) -> np.ndarray:
    """One array from a column of blobs."""
    return np.frombuffer(b"".join(column), kind)


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows with large blobs, one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def shrink(*arrays: np.ndarray) -> bytes:
    """Arrays of 32-bit numbers as one compressed blob, bytes of equal weight together."""
    sizes = np.array([len(a) for a in arrays], np.int64).tobytes()
    planes = [a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays]
    return zstandard.compress(b"".join([sizes, *planes]), 3)


def grow(blob: bytes, count: int) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.decompress(blob), np.uint8)
    out, at = [], 8 * count
    for n in data[:at].view(np.int64).tolist():
        planes = data[at : at + 4 * n].reshape(4, n).T
        out.append(np.ascontiguousarray(planes).view("<u4").ravel())
        at += 4 * n
    return out


def rows(schema: pa.Schema, tuples) -> pa.RecordBatch:
    """A record batch from an iterable of tuples."""
    columns = list(zip(*tuples)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
    )
