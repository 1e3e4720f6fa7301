"""Token counts from pre-token counts: each distinct pre-token is encoded once.

Documents become frequencies of pre-tokens, in chunks with a dictionary each. Dictionaries are
dealt out by hash of the pre-token; a group counts the pieces of each distinct pre-token once and
answers every chunk that asked. A chunk's answers meet its frequencies, and the weighted sums are
the token counts. No list of ids of a text is ever made. A frequent pre-token costs one entry a
chunk, so no group grows with its frequency. Within a chunk, pre-tokens are told apart by a 64-bit
hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.session import written
from llm.common import chunks, each, grow, pieces_of, raw, rows, shrink
from llm.tokens import BYTE_BPE, pre_tokens

_KIND = (
    "chunk long, bucket int, pieces binary, doc_id array<long>, n_bytes array<long>, docs binary"
)
_CHUNK = pa.schema(
    [
        ("chunk", pa.int64()), ("bucket", pa.int32()), ("pieces", pa.binary()),
        ("doc_id", pa.list_(pa.int64())), ("n_bytes", pa.list_(pa.int64())), ("docs", pa.binary()),
    ]
)


def _strings(pieces: list[str]) -> bytes:
    coded = [p.encode("utf-8", "surrogatepass") for p in pieces]
    sizes = np.fromiter(map(len, coded), np.uint32, len(coded))
    return zstandard.compress(
        len(coded).to_bytes(8, "little") + sizes.tobytes() + b"".join(coded), 3
    )


def _pieces(blob: bytes) -> list[str]:
    data = zstandard.decompress(blob)
    n = int.from_bytes(data[:8], "little")
    ends = (8 + 4 * n + np.cumsum(np.frombuffer(data, np.uint32, n, 8))).tolist()
    return [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip([8 + 4 * n, *ends], ends)]


def frequencies(
    docs: DataFrame, path: str = BYTE_BPE, chunk_bytes: int = 24 << 20, count: int = 128
) -> DataFrame:
    """Two kinds of rows: a chunk's dictionary by one of ``count`` buckets, and (bucket null) its
    documents.

    The dictionary is sorted by bucket. ``docs`` holds for each document the number of its distinct
    pre-tokens, their places in the dictionary as differences, and their frequencies.
    """

    def run(batches):
        tokens = pre_tokens(path)
        number = TaskContext.get().partitionId() << 32
        for batch in chunks(batches, chunk_bytes):
            names = np.zeros(0, np.uint64)
            strings: list[str] = []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keys, own = [np.zeros(0, np.uint64)], [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for rows_, parts in pieces_of(texts):
                body, text, starts, ends, hashes = tokens.spans(parts)
                text = np.array(rows_, np.int64)[text]
                found, at, which = np.unique(hashes, return_index=True, return_inverse=True)
                new = at[~np.isin(found, names)]
                strings += [body[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
                names = np.concatenate([names, hashes[new]])
                pair, freq = np.unique((text << 32) + which, return_counts=True)
                keys.append(found[pair & 0xFFFFFFFF])
                own.append((pair >> 32, freq))
            bucket = (names % np.uint64(count)).astype(np.int64)
            order = np.lexsort((names, bucket))
            by_name = np.argsort(names)
            place = np.empty(len(names), np.int64)
            place[order] = np.arange(len(names))
            text = np.concatenate([x for x, _ in own])
            freq = np.concatenate([x for _, x in own])
            keys = np.concatenate(keys)
            where = place[by_name[np.searchsorted(names, keys, sorter=by_name)]]
            sort = np.lexsort((where, text))
            text, where, freq = text[sort], where[sort], freq[sort]
            # A pre-token of several pieces of a text counts once, with all its occurrences.
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (where[1:] != where[:-1])
            at = np.flatnonzero(new)
            freq = np.add.reduceat(freq, at) if len(at) else freq
            text, where = text[at], where[at]
            fresh = np.concatenate([[True], text[1:] != text[:-1]])[: len(text)]
            steps = np.where(fresh, where, where - np.concatenate([[0], where[:-1]])[: len(text)])
            sizes = np.bincount(text, minlength=batch.num_rows)
            out = [
                (
                    number, None, None, batch.column("doc_id").to_pylist(),
                    np.diff(raw(batch.column("text"))[0]).tolist(), shrink(sizes, steps, freq),
                )
            ]
            edges = np.searchsorted(bucket[order], np.arange(count + 1)).tolist()
            order = order.tolist()
            out += [
                (number, b, _strings([strings[k] for k in order[i:j]]), None, None, None)
                for b, (i, j) in enumerate(zip(edges, edges[1:])) if j > i
            ]
            yield rows(_CHUNK, out)
            number += 1

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _KIND)


def count_tokens(docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row of ``docs``.

    Columns other than doc_id and text are ignored. A null or empty text has 0 tokens; a null or
    repeated doc_id, or a repeated row, is counted as any other row. Special strings inside a text
    count as the library counts them by default. An empty table gives no rows.
    """
    # The distinct pre-tokens of some 8 MB of text in a bucket, at any size.
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(128, -(-size // (8 << 20)))
    split = written(frequencies(docs, path, count=count), "pre-token-frequencies")

    def answer(table: pa.Table) -> pa.Table:
        lists = [_pieces(x) for x in table.column("pieces").to_pylist()]
        distinct = list(dict.fromkeys(p for pieces in lists for p in pieces))
        known = dict(zip(distinct, map(len, pre_tokens(path).ids(distinct))))
        found = [shrink(np.fromiter(map(known.get, x), np.uint32, len(x))) for x in lists]
        return table.drop(["pieces"]).append_column("n", pa.array(found, pa.binary()))

    dictionaries = split.where("bucket is not null").select("chunk", "bucket", "pieces")
    answers = dictionaries.groupBy("bucket").applyInArrow(
        answer, "chunk long, bucket int, n binary"
    )
    # Both sides have a bounded size for each chunk: its entries, packed.
    answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n")).alias("answers"))
    documents = split.where("bucket is null").select("chunk", "doc_id", "n_bytes", "docs")

    def total(batches):
        for row in each(batches):
            parts = sorted(row["answers"] or [], key=lambda x: x["bucket"])
            known = np.concatenate(
                [np.zeros(0, np.uint32), *(grow(x["n"], 1)[0] for x in parts)]
            )
            sizes, steps, freq = (x.astype(np.int64) for x in grow(row["docs"], 3))
            ends = np.cumsum(sizes)
            # Places are differences within a document: sum them up and take off the start.
            place = np.cumsum(steps)
            before = np.concatenate([[0], place])[ends - sizes]
            place -= np.repeat(before, sizes)
            summed = np.concatenate([[0], np.cumsum(known[place] * freq)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_id"], pa.int64()), pa.array(row["n_bytes"], pa.int64()),
                    pa.array(summed[ends] - summed[ends - sizes]),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return documents.join(answers, "chunk", "left").drop("chunk").mapInArrow(
        total, "doc_id long, n_bytes long, n_tokens long"
    )
