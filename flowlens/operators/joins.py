"""Join of a large table with a lookup table of unproven size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.session import written

BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 32


def content_bytes(df: DataFrame) -> int:
    """Bytes of all rows as text; runs a job."""
    row = F.octet_length(F.to_json(F.struct("*")))
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread: list[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Left outer join; ``lookup`` holds at most one row per key.

    The lookup table is written once and measured. Up to ``broadcast_bytes`` of content it is
    broadcast and the large side does not move. Beyond that both sides are shuffled, with every key spread
    over ``salts`` partitions, since one key may hold a large share of all rows. ``spread``
    names columns that differ between rows of one key, such as the row's id; the salt derives
    from them and is thus the same when a lost task is run again.
    """
    lookup = written(lookup, "lookup")
    return keyed_join(large, lookup, keys, spread, content_bytes(lookup) <= broadcast_bytes, salts)


def keyed_join(
    large: DataFrame, lookup: DataFrame, keys: list[str], spread: list[str], small: bool, salts: int
) -> DataFrame:
    """The join itself, for a lookup table at rest that has been found ``small`` or not."""
    if small:
        return large.join(F.broadcast(lookup), on=keys, how="left")
    salted = large.withColumn("salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    copies = lookup.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    copies = copies.withColumn("salt", F.col("salt").cast("long"))
    return salted.join(copies, on=[*keys, "salt"], how="left").drop("salt")
