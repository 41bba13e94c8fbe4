"""Stream sources: a Kafka topic, or a directory of files as a stand-in for one."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewindow.contract import DECODED, EVENT_SCHEMA
from tidewindow.functions.envelope import unwrap
from tidewindow.operators.quality import decoded as decoded_column

# Topic names of the event contract.
RAW_TOPIC = "events.raw.v1"
LATE_TOPIC = "events.late.v1"
POISON_TOPIC = "events.dlq.v1"


def kafka_options(servers: str, topic: str, per_trigger: int | None = None) -> dict[str, str]:
    """Read a topic from the beginning; later positions come from the checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def kafka_stream(
    spark: SparkSession, servers: str, topic: str = RAW_TOPIC, per_trigger: int | None = None
) -> DataFrame:
    """Streaming read of a topic; needs the Kafka connector on the class path."""
    options = kafka_options(servers, topic, per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def starting_offsets(upto: Mapping[int, int], partitions: int) -> str:
    """Where a topic is read on: at the positions given, at the beginning of other partitions."""
    return json.dumps({str(p): upto.get(p, -2) for p in range(partitions)})


def kafka_table(
    spark: SparkSession, servers: str, topic: str = LATE_TOPIC,
    upto: Mapping[int, int] | None = None, partitions: int = 0,
) -> DataFrame:
    """Batch read of what a topic holds now, from the positions ``upto`` where they are given."""
    options = {**kafka_options(servers, topic), "endingOffsets": "latest"}
    if upto:
        options["startingOffsets"] = f'{{"{topic}": {starting_offsets(upto, partitions)}}}'
    return spark.read.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = EVENT_SCHEMA,
    files_per_trigger: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Parquet files of a directory, oldest first, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def avro_event(body: str | Column, writer: str, reader: str) -> Column:
    """Decode an Avro body written by one schema and read by another.

    A body that cannot be decoded becomes null.  Needs the Avro module on the class
    path.  Times arrive as longs.
    """
    from pyspark.sql.avro.functions import from_avro

    return from_avro(body, writer, {"mode": "PERMISSIVE", "avroSchema": reader})


Decoder = Callable[[Column, str, str], Column]


def decode_avro_topic(
    raw: DataFrame, reader: str, writers: Mapping[int, str], decoder: Decoder = avro_event
) -> DataFrame:
    """Envelope and Avro body to event columns and the ``decoded`` column.

    ``writers`` has the schema of each id that producers use.  A message of another id
    is poison with the reason ``unknown_schema``: read by a guess it would be misread.
    """
    if not writers:
        raise ValueError("no writer schema is known")
    opened = unwrap(raw, "value")
    event = None
    for number, writer in writers.items():
        decoded = decoder(F.col("body"), writer, reader)
        chosen = F.col("schema_id") == number
        event = F.when(chosen, decoded) if event is None else event.when(chosen, decoded)
    # inline() keeps the decoder from being repeated for every column that uses it
    events = opened.select(
        F.struct(
            F.col("value").alias("raw"), F.col("envelope_status").alias("status"),
            F.col("schema_id").alias("schema"),
        ).alias("_message"),
        F.inline(F.array(event)),
    )
    reason = (
        F.when(F.col("_message.status") != "ok", F.col("_message.status"))
        .when(~F.col("_message.schema").isin(*writers), "unknown_schema")
        .when(F.col("event_id").isNull(), "malformed")
    )
    return events.withColumns({
        DECODED: decoded_column(F.col("_message.raw"), reason),
        "event_ts": F.timestamp_millis("event_ts"),
        "ingest_ts": F.timestamp_millis("ingest_ts"),
    }).drop("_message")
