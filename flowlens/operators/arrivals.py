"""Time between the flows of a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 3600


def with_gap(
    df: DataFrame,
    source: str = "orig_h",
    time: str = "ts",
    tie: str = "uid",
    slice_seconds: float = SLICE_SECONDS,
) -> DataFrame:
    """Add ``gap``: the time since the source's flow before, in the unit of ``time``.

    A source's time is cut into slices that are sorted by themselves, so one busy source is shared
    by as many tasks as it has slices. The first flow of a slice takes its gap from the end of the
    slice before that has flows; these ends are one row for each source and slice. The first flow
    of a source has no gap, nor has one without a source or time.
    """
    sliced = df.withColumn("slice_", F.floor(F.col(time) / slice_seconds))
    inside = Window.partitionBy(source, "slice_").orderBy(time, tie)
    rows = sliced.withColumn("before_", F.lag(time).over(inside))
    known = sliced.where(F.col(source).isNotNull() & F.col("slice_").isNotNull())
    ends = known.groupBy(source, "slice_").agg(F.max(time).alias("end_"))
    slices = Window.partitionBy(source).orderBy("slice_")
    seams = ends.select(source, "slice_", F.lag("end_").over(slices).alias("seam_"))
    # Both sides lie by (source, slice) already, so the join moves no flow.
    joined = rows.join(seams, [source, "slice_"], "left")
    before = F.coalesce("before_", "seam_")
    gap = F.when(F.col(source).isNotNull(), F.col(time) - before)
    return joined.select(*df.columns, gap.alias("gap"))
