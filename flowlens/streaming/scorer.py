"""Live scoring: topic to stored predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.models.bundle import ModelBundle, score_all
from flowlens.operators.cleaning import add_features, clean
from flowlens.schema import CORRUPT
from flowlens.sources.topics import decode
from flowlens.streaming.sinks import (
    SCORED,
    UNFIT,
    Batch,
    BatchWriter,
    running_batch,
    stored_columns,
    write_batch,
)


def prepare(messages: DataFrame, **options) -> DataFrame:
    """Messages to flows with features; projections only."""
    return add_features(clean(decode(messages, **options)))


def score_messages(messages: DataFrame, bundle: ModelBundle) -> DataFrame:
    """Scored flows for any sink; one that lacks an input has no prediction but a ``reason``."""
    return score_all(prepare(messages), bundle)


#: Told after each micro-batch: the batch, and its messages by reason (None: scored).
Report = Callable[[Batch, dict[str | None, int]], None]


def start_scoring(
    messages: DataFrame,
    bundle: ModelBundle,
    output: str,
    checkpoint: str,
    every: str | None = None,
    available_now: bool = False,
    write: BatchWriter = write_batch,
    report: Report | None = None,
) -> StreamingQuery:
    """Score a stream into ``output``: predictions, and apart from them messages that are unfit.

    Messages are parsed, scored and written in one pass, planned once for all micro-batches, and
    counted by reason on the way for ``report``. Each micro-batch replaces its own folder, so a
    batch that is run again after a failure adds nothing twice. An error in a sink ends the query,
    and the checkpoint repeats the batch on restart. ``write`` may put rows elsewhere than in a
    table; ``kind`` tells ``scored`` from ``unfit`` ones, which hold the message and a ``reason``.
    """
    scored = score_all(prepare(messages, corrupt=True, keep_value=True), bundle)
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").otherwise(F.col("reason"))
    scored = scored.withColumn("reason", reason)
    unfit = F.col("reason").isNotNull()
    scored = scored.withColumns(
        {"kind": F.when(unfit, UNFIT).otherwise(SCORED), "value": F.when(unfit, F.col("value"))}
    )

    def store(rows: DataFrame, batch_id: int) -> None:
        batch, seen = running_batch(rows, batch_id), Observation()
        counts = [F.count_if(~unfit).alias(SCORED)]
        counts += [F.count_if(F.col("reason") == r).alias(r) for r in ("malformed", "incomplete")]
        stored = stored_columns(rows, batch_id, "value", "reason", "kind")
        write(stored.observe(seen, *counts), output, batch)
        if report:
            found = dict(seen.get)
            report(batch, {None: found.pop(SCORED), **found})

    writer = scored.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()
