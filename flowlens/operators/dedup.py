"""Records sent more than once, by a replayed topic or a retried producer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_key(df: DataFrame, key: str = "uid") -> Column:
    """The record's id as text, or a digest of its content where it has none.

    The digest covers the columns of ``df`` in their order, so a record without an id is a copy of
    another one only if they agree in all of them.
    """
    content = F.sha2(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), 256)
    given = F.nullif(F.nullif(F.col(key).cast("string"), F.lit("-")), F.lit(""))
    return F.coalesce(given, F.concat(F.lit("#"), content))


def newest_per_key(df: DataFrame, key: str = "uid", by: tuple[str, ...] = ("ts",)) -> DataFrame:
    """One row for each record: the one with the largest ``by``, ties by the row's content.

    One aggregate with partial results, so a record sent a million times costs a row per task. A
    row without a time is older than all others.
    """
    rows = df.withColumn("key_", record_key(df, key))
    order = F.struct(
        *[F.struct(F.col(c).isNotNull(), F.col(c)) for c in by],
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}),
    )
    newest = F.max_by(F.struct(*df.columns), order).alias("row_")
    return rows.groupBy("key_").agg(newest).select("row_.*")


def first_seen(
    stream: DataFrame, key: str = "uid", time: str = "timestamp", within: str = "1 day"
) -> DataFrame:
    """A stream without the copies that follow a record within ``within`` of its event time.

    The state holds one short key for each record of that span. A copy that comes later than that
    is told by the watermark instead: a row older than ``within`` before the newest time of the
    batches before the last one is dropped, be it a copy or not, and counted in the progress table
    as dropped by the watermark. A copy with a newer time than its record is a record again once the record has left the state.
    Rows without a time can be given no place in the state and are left out.
    """
    keyed = stream.where(F.col(time).isNotNull()).withColumn("key_", record_key(stream, key))
    return keyed.withWatermark(time, within).dropDuplicatesWithinWatermark(["key_"]).drop("key_")
