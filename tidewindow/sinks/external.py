"""Sinks that need a connector on the class path, and the keyed layout for topics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewindow.functions.dims import cold_projection
from tidewindow.operators.ordered import even_ranges
from tidewindow.operators.quality import json_value


def keyed_messages(events: DataFrame, columns: list[str]) -> DataFrame:
    """``key`` (the user) and ``value`` (JSON) for a topic or for files."""
    return events.select(
        F.col("user_id").alias("key"),
        json_value(columns).alias("value"),
        "event_ts",
        "event_id",
    )


def publish_keyed(events: DataFrame, columns: list[str]) -> DataFrame:
    """Messages in user order, and in time order within a user.

    Ranges of (user, time) keep a user's events in order across consecutive files
    and split a user that is too large for one task.  The order across files is that of
    their names; a topic gets the order within a task only, so a consumer that needs
    the whole order of a user sorts by the event time in the message.

    ``events`` are read from files; from elsewhere they should be pinned first.
    """
    order = ["key", "event_ts", "event_id"]
    ranged = even_ranges(keyed_messages(events, columns), order, pinned=False)
    return ranged.sortWithinPartitions(*order).select("key", "value")


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.enable.idempotence": "true",
        "kafka.acks": "all",
    }


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Send ``key`` and ``value``; the key decides the partition of the topic."""
    messages.write.format("kafka").options(**kafka_sink_options(servers, topic)).save()


# Fixed values below: statement size, and file properties of the history table.
def jdbc_sink_options(url: str, table: str, **options: str) -> dict[str, str]:
    """100 rows per statement; failed tasks are retried by Spark."""
    return {"url": url, "dbtable": table, "batchsize": "100", "isolationLevel": "NONE", **options}


def write_jdbc(metrics: DataFrame, url: str, table: str, writers: int = 8, **options: str) -> None:
    """Append metric rows; a table that replaces by key makes a retry harmless.

    ``writers`` bounds the open connections.
    """
    options = jdbc_sink_options(url, table, **options)
    metrics.coalesce(writers).write.format("jdbc").mode("append").options(**options).save()


def write_iceberg(df: DataFrame, table: str, batch_id: int, create: bool = False) -> None:
    """Write a batch to a table of an Iceberg catalog, partitioned by day, 128 MB files.

    Rows carry their batch.  A repeated batch replaces the rows it wrote before, in one
    commit of the table, so nothing is doubled.
    """
    writer = df.withColumn("batch_id", F.lit(batch_id).cast("long")).writeTo(table)
    if create:
        (
            writer.using("iceberg")
            .partitionedBy(F.partitioning.days("event_ts"))
            .tableProperty("write.format.default", "parquet")
            .tableProperty("write.target-file-size-bytes", "134217728")
            .tableProperty("write.distribution-mode", "hash")
            .create()
        )
    else:
        writer.overwrite(F.col("batch_id") == batch_id)


def iceberg_history(table: str) -> Callable[[DataFrame, int], None]:
    """Sink of the job that keeps history in an Iceberg table; made with the first batch."""

    def write(good: DataFrame, batch_id: int) -> None:
        create = not good.sparkSession.catalog.tableExists(table)
        write_iceberg(cold_projection(good), table, batch_id, create)

    return write
