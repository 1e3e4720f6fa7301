"""Messages of a topic, in batch and as a stream.

A topic is a Kafka topic (``servers`` and ``topic``) or a folder of text files with one message
per line (``path``). Both give a column ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.values import text_or_null
from flowlens.schema import CORRUPT, TABLE_NAMES, WIRE_NAMES, wire_schema


def _kafka_options(servers: str | None, topic: str | None) -> dict[str, str]:
    if not (servers and topic):
        raise ValueError("give either a path, or servers and a topic")
    return {"kafka.bootstrap.servers": servers, "subscribe": topic}


def _only_earliest(starting: str) -> None:
    if starting != "earliest":
        raise ValueError("a folder of files has no offsets; for later files, give modifiedAfter")


def read_topic(
    spark: SparkSession,
    path: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
    starting: str = "earliest",
    **options: str,
) -> DataFrame:
    """All messages from ``starting`` to now; a folder is always read from its first file."""
    if path:
        _only_earliest(starting)
        return spark.read.options(**options).text(path)
    reader = spark.read.format("kafka").options(**_kafka_options(servers, topic), **options)
    return reader.option("startingOffsets", starting).load()


def stream_topic(
    spark: SparkSession,
    path: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
    starting: str | None = None,
    per_trigger: int | None = None,
    partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """Messages as they arrive.

    ``starting`` is where a new query begins: by default at the latest offset of a Kafka topic, and
    at the first file of a folder, which knows no other start. ``per_trigger`` limits a micro-batch, to that many offsets or files. ``partitions`` asks
    Kafka for at least that many input splits, which costs no shuffle; files are repartitioned.
    """
    if path:
        _only_earliest(starting or "earliest")
        reader = spark.readStream.format("text").options(**options)
        if per_trigger:
            reader = reader.option("maxFilesPerTrigger", per_trigger)
        stream = reader.load(path)
        return stream.repartition(partitions) if partitions else stream
    reader = spark.readStream.format("kafka").options(**_kafka_options(servers, topic), **options)
    reader = reader.option("startingOffsets", starting or "latest")
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    if partitions:
        reader = reader.option("minPartitions", partitions)
    return reader.load()


def write_topic(
    messages: DataFrame,
    path: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
) -> None:
    """Append messages (column ``value``) to a topic."""
    if path:
        messages.select("value").write.mode("append").text(path)
        return
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    messages.select("value").write.format("kafka").options(**options).save()


def decode(
    messages: DataFrame,
    fields: list[str] | None = None,
    corrupt: bool = False,
    keep_value: bool = False,
) -> DataFrame:
    """Parse JSON messages with the fixed schema and give fields their table names.

    ``fields`` limits parsing to those columns. A message that is no JSON object gives a row of
    NULLs; with ``corrupt`` its text is kept in ``_corrupt_record``.
    """
    schema = wire_schema(fields, corrupt)
    options = {"columnNameOfCorruptRecord": CORRUPT} if corrupt else {}
    text = F.col("value").cast("string")
    # As an inlined array of one the message is parsed once. As a plain projection it would be
    # parsed again for every later filter on its fields, which the optimizer moves below it.
    record = F.inline(F.array(F.from_json(text, schema, options)))
    parsed = messages.select(record, *([text.alias("value")] if keep_value else []))
    columns = []
    for field in schema.fields:
        value = F.col(f"`{field.name}`")
        is_text = field.dataType.typeName() == "string" and field.name != CORRUPT
        value = text_or_null(value) if is_text else value
        columns.append(value.alias(TABLE_NAMES.get(field.name, field.name)))
    return parsed.select(*columns, *(["value"] if keep_value else []))


def split_corrupt(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded rows, and the messages that could not be decoded (column ``value``)."""
    decoded = decode(messages, corrupt=True, keep_value=True)
    bad = F.col(CORRUPT).isNotNull()
    return decoded.where(~bad).drop(CORRUPT, "value"), decoded.where(bad).select("value")


def encode(df: DataFrame, clock: bool = True) -> DataFrame:
    """One JSON message per row, with wire names and the time of sending.

    Missing fields are left out of the message.
    """
    fields = [F.col(f"`{c}`").alias(WIRE_NAMES.get(c, c)) for c in df.columns]
    if clock:
        now = F.unix_micros(F.current_timestamp()) / 1e6
        fields.append(now.alias("timestamp_simulated"))
    return df.select(F.to_json(F.struct(*fields)).alias("value"))
