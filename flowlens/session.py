"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Clock functions (hour, day of week) follow the session time zone, so it is pinned.
# Partition counts are left to the cluster; AQE coalesces small shuffles and splits skewed ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method of more than 8000 bytes, and the chain from JSON to features
    # easily makes a longer one, which then runs several times slower. Beyond this limit Spark
    # splits the work by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "flowlens", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only where that is unset, a
    folder in the session's warehouse takes its place, which executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    context.setCheckpointDir(f"{warehouse}/flowlens-shared")
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Later uses neither recompute the input nor depend on executors that may be lost, and the
    optimizer knows the size of the table.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at ``path``, or no rows where it has not been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
