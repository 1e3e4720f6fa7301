"""Closed days of a table of micro-batches, in few files, and a reader that gives each row once.

A table of micro-batches has a folder for each batch (``write_key=…``), whose rows know their day. A
compaction puts a day's rows into a new folder of the archive, and
then adds one file to the manifest that names the folder and the batches it took in. That file is
what makes the folder count: until it is there, and if it never comes, readers take the day from the
batches. Afterwards they take it from the archive, and from the batches only what is not named, so
a batch that is written again after the compaction adds nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators.joins import BROADCAST_BYTES, content_bytes
from flowlens.session import table_or_empty, written

MANIFEST = "event_day date, run string, sequence long, write_key string"
KEYS = "event_day date, write_key string"


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of a table of micro-batches; none where nothing was written yet."""
    return table_or_empty(spark, path, f"{schema}, {KEYS}")


def _manifest(spark: SparkSession, archive: str) -> DataFrame:
    """Day, folder and batches of the archive's current folders."""
    entries = table_or_empty(spark, f"{archive}/manifest", MANIFEST)
    newest = entries.groupBy("event_day").agg(F.max(F.struct("sequence", "run")).alias("newest"))
    newest = newest.select("event_day", "newest.*")
    return entries.join(newest, ["event_day", "sequence", "run"])


def _archived(spark: SparkSession, archive: str, schema: str, entries: DataFrame) -> DataFrame:
    """Rows of the folders that the manifest names; others are left over from failed runs."""
    folders = entries.select("event_day", "run").distinct()  # one row for each day
    rows = spark.read.schema(f"{schema}, event_day date, run string").parquet(f"{archive}/rows")
    return rows.join(F.broadcast(folders), ["event_day", "run"], "left_semi").drop("run")


def _without(live: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows of batches that the archive has not taken in for their day."""
    taken = written(entries.select("event_day", "write_key"), "archived-batches")
    if content_bytes(taken) <= BROADCAST_BYTES:
        taken = F.broadcast(taken)
    return live.join(taken, ["event_day", "write_key"], "left_anti")


def compact_day(
    spark: SparkSession,
    path: str,
    archive: str,
    day: str,
    schema: str,
    fold: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ended: bool = False,
) -> None:
    """Put a day's rows into few files of the archive; run again, it adds what came since.

    The newest batch of each query is left where it is, since it may be running or be repeated after
    a failure; with ``ended`` it is taken in too. ``fold`` may reduce rows, such as counts to be
    added up; it gets and gives the columns of ``schema``. Batches that the archive has taken in may
    be removed by age. Rows without a time stay in their batches.
    """
    on = F.to_date(F.lit(day))
    live = read_batches(spark, path, schema).where(F.col("event_day") == on)
    if not ended:
        query, batch = F.regexp_extract("write_key", r"^(.*)-(\d+)$", 1), F.regexp_extract("write_key", r"-(\d+)$", 1)
        every = read_batches(spark, path, schema).select("write_key").distinct()
        newest = every.groupBy(query.alias("query")).agg(F.max(batch.cast("long")).alias("batch"))
        newest = newest.select(F.concat_ws("-", "query", "batch").alias("write_key"))
        live = live.join(F.broadcast(newest), "write_key", "left_anti")  # one row for each query
    entries = written(_manifest(spark, archive).where(F.col("event_day") == on), "manifest")
    known = entries.agg(F.count("*").alias("n"), F.max("sequence").alias("sequence")).first()
    names = [f.split()[0] for f in schema.split(", ")]
    rows = live.select("write_key", *names)
    if known.n:
        taken = entries.select("write_key")
        rows = rows.join(taken, "write_key", "left_anti")
    fresh = written(rows, "closed-day")
    all_rows = fresh.select(*names)
    if known.n:
        old = _archived(spark, archive, schema, entries).where(F.col("event_day") == on)
        all_rows = all_rows.unionByName(old.select(*names))
    run = uuid.uuid4().hex
    folded = fold(all_rows).select(*names)
    folded.hint("rebalance").write.parquet(f"{archive}/rows/event_day={day}/run={run}")
    keys = fresh.select("write_key").distinct().unionByName(entries.select("write_key"))
    entry = keys.select(
        on.alias("event_day"), F.lit(run).alias("run"),
        F.lit((known.sequence or 0) + 1).cast("long").alias("sequence"), "write_key",
    )
    # One file, so that the entry is there as a whole or not at all.
    entry.coalesce(1).write.mode("append").parquet(f"{archive}/manifest")


def read_once(spark: SparkSession, path: str, schema: str, archive: str | None = None) -> DataFrame:
    """Each row once, from the archive's closed days and the batches, with its ``event_day``.

    Safe while a compaction runs and after one that broke off: batches are listed before the
    manifest is read, and what it does not name is not read from the archive. Runs a job that reads
    the manifest.
    """
    live = read_batches(spark, path, schema)
    columns = [c for c in live.columns if c != "write_key"]
    if archive is None:
        return live.select(*columns)
    entries = written(_manifest(spark, archive), "manifest")
    if entries.isEmpty():
        return live.select(*columns)
    left = _without(live, entries).select(*columns)
    return left.unionByName(_archived(spark, archive, schema, entries))
