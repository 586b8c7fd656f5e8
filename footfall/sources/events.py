"""Raw events: JSON files, message encoding, Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.schema import ARRIVAL, CORRUPT_COLUMN, EVENT_COLUMNS, EVENT_DDL, ISO_MICROS

#: The whole line as a variant.
LINE = "line"

PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def event_ddl(keep_corrupt: bool) -> str:
    return f"{EVENT_DDL}, {CORRUPT_COLUMN} string" if keep_corrupt else EVENT_DDL


def read_events(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Scan JSON lines with the declared schema.

    A broken line becomes a row of NULLs and a bad field becomes NULL;
    ``keep_corrupt=True`` keeps the text of such lines in ``_corrupt_record``.
    """
    return spark.read.schema(event_ddl(keep_corrupt)).options(**PERMISSIVE).json(path)


def read_events_whole(spark: SparkSession, path: str) -> DataFrame:
    """The same rows as ``read_events`` with corrupt text, and the whole line as the variant ``line``.

    Fields that the schema does not declare are in ``line``, with the types they have; it is NULL
    for lines that are no JSON. Each line is read once.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    event = F.from_json("value", event_ddl(True), PERMISSIVE)
    return lines.select(event.alias("event"), F.try_parse_json("value").alias(LINE)).select("event.*", LINE)


def with_field(events: DataFrame, name: str, kind: str = "string", path: str | None = None) -> DataFrame:
    """Add an undeclared field of ``line`` as a column; NULL where it is missing or of another type.

    ``path`` is its place in the line, such as ``$.geo.city``, by default ``$.name``.
    """
    return events.withColumn(name, F.try_variant_get(F.col(LINE), path or f"$.{name}", kind))


def stream_events(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """JSON files arriving in a folder as an event stream, corrupt lines kept.

    An event has arrived when its file was written.
    """
    reader = spark.readStream.schema(event_ddl(True)).options(**PERMISSIVE, **options)
    return reader.json(path).select("*", F.col("_metadata.file_modification_time").alias(ARRIVAL))


def kafka_options(
    servers: str, topic: str, starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    """Reader options of a topic. A new checkpoint begins with the topic's first message."""
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_events(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A Kafka topic as an event stream; needs Spark's Kafka package on the classpath.

    ``options`` are those of ``kafka_options``. An event has arrived at its message's time.
    """
    messages = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()
    return decode_events(messages)


def write_json_events(events: DataFrame, path: str) -> None:
    """Store events as JSON lines with every microsecond of the timestamp."""
    writer = events.select(*EVENT_COLUMNS).write.mode("overwrite")
    writer.option("timestampFormat", ISO_MICROS).json(path)


def encode_events(events: DataFrame) -> DataFrame:
    """One UTF-8 JSON message per event in the binary column ``value``; NULLs are left out."""
    message = F.to_json(F.struct(*EVENT_COLUMNS), {"timestampFormat": ISO_MICROS})
    return events.select(F.encode(message, "UTF-8").alias("value"))


def decode_events(messages: DataFrame) -> DataFrame:
    """Event columns of JSON messages, the text of those that do not parse, and a message's time."""
    text = F.col("value").cast("string")
    event = F.from_json(text, event_ddl(True), PERMISSIVE)
    arrived = [F.col("timestamp").alias(ARRIVAL)] if "timestamp" in messages.columns else []
    return messages.select(event.alias("event"), *arrived).select("event.*", *[ARRIVAL] * len(arrived))


def event_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as messages, each as it is, whether it parses or not; blank lines are left out."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.encode("value", "UTF-8").alias("value"))


def publish_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Append messages to a Kafka topic, without a key."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
