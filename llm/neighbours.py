"""Nearest neighbours by inner product from randomly rotated one-bit codes.

A vector is centred, rotated by a random orthogonal map into ``bits`` dimensions, and kept as the
signs there with two numbers: its length and how far its signs lean from it. Signs and a rotated
query give an unbiased estimate of the inner product, with a bound on its error. Vectors whose
upper bound reaches the k-th largest lower bound are reranked with the original components.

Queries and rows meet in blocks: every query block sees every row block, so the index is scanned
whole. Each pair of blocks keeps k rows for each query; those are merged. No pair of vectors leaves
a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.session import written

BITS = 512
#: Bound on the error of an estimate, in standard deviations.
DEVIATIONS = 3.0
ROW_BLOCK = 16_384
QUERY_BLOCK = 4_096


def usable(vector: Column) -> Column:
    """Not null, not empty, every component a finite number, and not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(size: int, bits: int) -> np.ndarray:
    """A random map of ``size`` into ``bits`` dimensions (``size`` at least) that keeps lengths."""
    bits = max(bits, size)
    return np.linalg.qr(np.random.default_rng(3).normal(size=(bits, size)))[0].T


def _mean(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The mean vector for each length."""
    sums = vectors.select(F.size("vector").alias("size"), F.posexplode("vector")).groupBy(
        "size", "pos"
    ).agg(F.avg("col").alias("m"))
    out: dict[int, dict[int, float]] = {}
    for row in sums.toLocalIterator():  # one number for each dimension
        out.setdefault(row["size"], {})[row["pos"]] = row["m"]
    return {n: np.array([m[k] for k in range(n)]) for n, m in out.items()}


def encode(vectors: DataFrame, mean: dict[int, np.ndarray], bits: int = BITS) -> DataFrame:
    """(vec_id, size, vector, code, length, lean) of the vectors."""

    def run(batches):
        for batch in batches:
            ids, lists = batch.column("vec_id"), batch.column("vector").to_pylist()
            out = []
            for v in lists:
                x = np.array(v, np.float64)
                turned = (x - mean[len(x)]) @ maps[len(x)]
                length = float(np.linalg.norm(turned))
                lean = float(np.abs(turned).sum() / (np.sqrt(len(turned)) * length)) if length else 1.0
                out.append((len(x), x.tobytes(), np.packbits(turned > 0).tobytes(), length, lean))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(list(c), t) for c, t in zip(columns, kinds))],
                ["vec_id", "size", "vector", "code", "length", "lean"],
            )

    maps = {n: rotation(n, bits) for n in mean}
    kind = "vec_id long, size int, vector binary, code binary, length double, lean double"
    return vectors.select("vec_id", "vector").mapInArrow(run, kind)


def _search(mean: dict[int, np.ndarray], k: int, bits: int):
    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        n, size = rows.num_rows, key[0].as_py()
        out_query, out_ids, out_scores = [], [], []
        if n and queries.num_rows:
            wide = max(bits, size)
            ids = rows.column("vec_id").to_numpy()
            vectors = np.frombuffer(b"".join(rows.column("vector").to_pylist())).reshape(n, size)
            code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(n, -1)
            length, lean = rows.column("length").to_numpy(), rows.column("lean").to_numpy()
            signs = np.unpackbits(code, axis=1, count=wide).astype(np.float32) * 2 - 1
            scale = (length / (lean * np.sqrt(wide))).astype(np.float32)
            error = length * np.sqrt(np.maximum(1 - lean**2, 0)) / lean * DEVIATIONS / np.sqrt(wide - 1)
            error = error.astype(np.float32)
            turn = rotation(size, bits)
            asked = queries.column("vec_id").to_numpy()
            given = np.frombuffer(b"".join(queries.column("vector").to_pylist())).reshape(-1, size)
            for first in range(0, len(asked), 128):
                q, names = given[first : first + 128], asked[first : first + 128]
                estimate = ((q @ turn).astype(np.float32) @ signs.T) * scale
                estimate += (q @ mean[size]).astype(np.float32)[:, None]
                margin = np.linalg.norm(q, axis=1).astype(np.float32)[:, None] * error
                own = names[:, None] == ids if n < 256 else None
                for i, name in enumerate(names):
                    mine = own[i] if own is not None else ids == name
                    upper = np.where(mine, -np.inf, estimate[i] + margin[i])
                    if n > k:
                        lower = np.where(mine, -np.inf, estimate[i] - margin[i])
                        least = np.partition(lower, n - k)[n - k]
                    else:
                        least = -np.inf
                    chosen = np.flatnonzero((upper >= least) & ~mine)
                    score = (vectors[chosen] * q[i]).sum(axis=1)
                    best = np.lexsort((ids[chosen], -score))[:k]
                    if len(best):
                        out_query.append(int(name))
                        out_ids.append(ids[chosen[best]])
                        out_scores.append(score[best])
        return pa.table(
            {
                "query_id": pa.array(out_query, pa.int64()),
                "ids": pa.array(out_ids, pa.list_(pa.int64())),
                "scores": pa.array(out_scores, pa.list_(pa.float64())),
            }
        )

    return run


def nearest(
    rows: DataFrame, is_query: Column, k: int = 20, bits: int = BITS, vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row with ``is_query``, the k others with the
    largest inner product in double precision; ties go to the smaller vec_id.

    Rows without an id or a usable vector take no part. Of rows that repeat an id, the one with the
    smallest vector counts. Vectors are compared with those of the same length only. A vector that
    more than k + 1 rows share is searched for as its k + 1 smallest ids, since no other can be
    among the k nearest of anything. Other columns are ignored; an empty table gives no rows.
    """
    good = rows.where(usable(F.col(vector)) & F.col("vec_id").isNotNull())
    good = good.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(F.col(vector).cast("array<double>")).alias("vector")
    )
    good = written(good, "vectors")
    mean = _mean(good)
    copies = Window.partitionBy("vector").orderBy("vec_id")
    few = good.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    index = written(encode(few, mean, bits), "vector-codes")
    asked = written(encode(good.where(is_query), mean, bits).select("vec_id", "size", "vector"), "queries")
    row_blocks = max(1, -(-index.count() // ROW_BLOCK))
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def blocks(df: DataFrame, own: str, count: int, other: str, others: int) -> DataFrame:
        return df.select(
            "*", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other),
        )

    by = ["size", "i", "j"]
    left = blocks(index, "i", row_blocks, "j", query_blocks).groupBy(*by)
    right = blocks(asked, "j", query_blocks, "i", row_blocks).groupBy(*by)
    found = left.cogroup(right).applyInArrow(
        _search(mean, k, bits), "query_id long, ids array<long>, scores array<double>"
    )
    found = found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.select("query_id", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
