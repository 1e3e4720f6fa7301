"""Throughput and latency of a streaming query, one row per micro-batch."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = (
    "queryId string, batchId long, inputRows long, procTimeMs long, "
    "inputRowsPerSecond double, processedRowsPerSecond double, droppedByWatermark long"
)
METRICS = ["inputRows", "procTimeMs", "inputRowsPerSecond", "processedRowsPerSecond"]


class ProgressLog(StreamingQueryListener):
    """Keeps every batch's progress in a table below ``path``, whatever Spark itself remembers.

    Batches are written ``every`` so many, and the rest when a table is asked for, so the driver
    holds few of them. A batch that is run again after a failure counts by its last report.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100) -> None:
        self.spark, self.path, self.every = spark, path, every
        self.batches: dict[tuple[str, int], tuple] = {}
        self.seen: dict[str, int] = {}
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self.lock:
            self.batches[(str(p.id), p.batchId)] = (
                str(p.id),
                p.batchId,
                p.numInputRows,
                p.durationMs.get("addBatch"),
                p.inputRowsPerSecond,
                p.processedRowsPerSecond,
                sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            )
            self.seen[str(p.id)] = p.batchId
            if len(self.batches) >= self.every:
                self._flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def _flush(self) -> None:
        if self.batches:
            rows = self.spark.createDataFrame(list(self.batches.values()), SCHEMA)
            rows.coalesce(1).write.mode("append").parquet(self.path)
            self.batches.clear()

    def wait(self, query: StreamingQuery, seconds: float = 30.0) -> None:
        """Until the last batch of a query that has ended is reported; reports come a bit later."""
        last = query.lastProgress
        end = time.monotonic() + seconds
        while last and self.seen.get(str(query.id), -1) < last["batchId"]:
            if time.monotonic() > end:
                raise TimeoutError("the listener has not heard of the last batch")
            time.sleep(0.05)

    def table(self) -> DataFrame:
        """All batches so far, each once."""
        with self.lock:
            self._flush()
        if not self.seen:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path).dropDuplicates(["queryId", "batchId"])
