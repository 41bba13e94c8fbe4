"""Start the streaming job: ``spark-submit tidewindow/streaming/main.py --help``."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewindow.contract import EVENT_COLUMNS, avro_schema
from tidewindow.functions.dims import late_payload
from tidewindow.operators.lateness import LatePolicy
from tidewindow.operators.quality import json_value
from tidewindow.session import build_session
from tidewindow.sinks.external import iceberg_history, write_jdbc, write_kafka
from tidewindow.sinks.tables import Tables
from tidewindow.sources.topics import (
    LATE_TOPIC,
    POISON_TOPIC,
    RAW_TOPIC,
    decode_avro_topic,
    file_stream,
    kafka_stream,
)
from tidewindow.streaming.job import StreamJob


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tables", required=True, help="folder of the written tables")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--files", help="read Parquet files of this folder, not the topic")
    parser.add_argument("--files-per-trigger", type=int)
    parser.add_argument("--servers", default=os.environ.get("BOOTSTRAP_SERVERS"))
    parser.add_argument("--topic", default=RAW_TOPIC)
    parser.add_argument("--offsets-per-trigger", type=int)
    parser.add_argument(
        "--writer-schema", action="append", default=[], metavar="ID=FILE",
        help="Avro schema that messages of this id were written by; may be repeated",
    )
    parser.add_argument("--late-topic", nargs="?", const=LATE_TOPIC)
    parser.add_argument(
        "--late-json", action="store_true", help="send late events as JSON, which can be replayed"
    )
    parser.add_argument("--poison-topic", nargs="?", const=POISON_TOPIC)
    parser.add_argument("--iceberg-table", help="also keep history in this Iceberg table")
    parser.add_argument("--catalog-table", help="name of the history in the catalog")
    parser.add_argument("--jdbc-url", help="also write closed windows to this database")
    parser.add_argument("--jdbc-table", default="metrics_1m")
    parser.add_argument("--bound-seconds", type=int, default=5)
    parser.add_argument("--dedup", action="store_true")
    parser.add_argument("--trigger-seconds", type=int, default=60)
    parser.add_argument("--available-now", action="store_true", help="stop when all is read")
    args = parser.parse_args(argv)
    if not args.files and not (args.servers and args.writer_schema):
        parser.error("a topic needs --servers and --writer-schema")
    if (args.late_topic or args.poison_topic) and not args.servers:
        parser.error("topics to write to need --servers")
    return args


def read(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return file_stream(spark, args.files, files_per_trigger=args.files_per_trigger)
    raw = kafka_stream(spark, args.servers, args.topic, args.offsets_per_trigger)
    writers = {}
    for entry in args.writer_schema:
        number, _, path = entry.partition("=")
        with open(path) as schema:  # on the driver, which plans the decoding
            writers[int(number)] = schema.read()
    return decode_avro_topic(raw, avro_schema(), writers)


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    hot, late, cold, poison = [], [], [], []
    if args.jdbc_url:
        hot.append(lambda closed: write_jdbc(closed, args.jdbc_url, args.jdbc_table))
    if args.late_topic:
        text = json_value(EVENT_COLUMNS) if args.late_json else late_payload()
        late.append(
            lambda rows: write_kafka(
                rows.select(rows.user_id.alias("key"), text.alias("value")),
                args.servers,
                args.late_topic,
            )
        )
    if args.poison_topic:
        poison.append(
            lambda rows, batch: write_kafka(
                rows.select(rows.reason.alias("key"), rows.raw.alias("value")),
                args.servers,
                args.poison_topic,
            )
        )
    if args.iceberg_table:
        cold.append(iceberg_history(args.iceberg_table))
    job = StreamJob(
        Tables(args.tables),
        LatePolicy(bound_seconds=args.bound_seconds),
        args.dedup,
        tuple(hot),
        tuple(late),
        tuple(cold),
        tuple(poison),
        args.catalog_table,
    )
    trigger = (
        {"availableNow": True}
        if args.available_now
        else {"processingTime": f"{args.trigger_seconds} seconds"}
    )
    return job.start(read(spark, args), args.checkpoint, **trigger)


if __name__ == "__main__":
    start(build_session("tidewindow"), arguments()).awaitTermination()
