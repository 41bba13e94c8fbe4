"""Stateful streaming forms of the counts and session summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewindow.contract import DIMENSIONS
from tidewindow.functions.dims import millis, with_dimensions
from tidewindow.operators.metrics import METRIC_COLUMNS
from tidewindow.sinks.tables import write_hot


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session for queries with one stateful operator.

    With several allowed, Spark judges late rows by the watermark one batch older
    than the one that closes windows; with one, both are the same.  State is kept on
    local disk with RocksDB and in the checkpoint, not on the heap.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.streaming.statefulOperator.allowMultiple", "false")
    # sessions of a user are merged where they are read, before they meet in one task
    session.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return session


def stream_counts(
    events: DataFrame, bound: str = "5 seconds", width: str = "1 minute"
) -> DataFrame:
    """Counts of closed windows; state is one number per open window and key."""
    window = F.window("event_ts", width)
    return (
        with_dimensions(events.withWatermark("event_ts", bound))
        .groupBy(window.alias("window"), *DIMENSIONS)
        .agg(F.count("*").alias("event_count"))
        .withColumns({
            "window_start": F.col("window.start"),
            "window_end": F.col("window.end"),
            "revenue": F.lit(0.0),
        })
        .select(*METRIC_COLUMNS)
    )


def stream_salted_counts(
    events: DataFrame, salts: int = 16, bound: str = "5 seconds", width: str = "1 minute"
) -> DataFrame:
    """First phase of the counts of hot keys: each key is kept in ``salts`` rows of state.

    The state of one hot campaign then lies in as many state partitions as its salts fall
    into, each of which takes a part of its updates.  All rows of a window are handed out by
    the batch that closes it, whatever their salt.
    """
    salt = F.pmod(F.xxhash64("event_id", "user_id", "ingest_ts"), F.lit(salts))
    return (
        with_dimensions(events.withWatermark("event_ts", bound))
        .groupBy(F.window("event_ts", width).alias("window"), *DIMENSIONS, salt.alias("salt"))
        .agg(F.count("*").alias("part"))
    )


def merge_salted(partial: DataFrame) -> DataFrame:
    """Second phase, on one batch of the first: since no window is spread over batches, a sum
    over the batch is final and takes no state of its own.

    A second stateful aggregation would need several stateful operators in the query, and
    then rows are judged by an older watermark than the one that closes windows.
    """
    counted = partial.groupBy("window", *DIMENSIONS).agg(F.sum("part").alias("event_count"))
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *DIMENSIONS, "event_count", F.lit(0.0).alias("revenue"),
    )


def start_two_phase_counts(
    events: DataFrame, hot: str, checkpoint: str, salts: int = 16, **trigger
) -> StreamingQuery:
    """Counts of closed windows in two phases, written to the folder ``hot`` batch by batch.

    ``events`` belongs to a ``stateful_session``.  A repeated batch replaces its folder.
    """
    return (
        stream_salted_counts(events, salts).writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .foreachBatch(lambda partial, batch: write_hot(merge_salted(partial), hot, batch))
        .start()
    )


def stream_sessions(
    events: DataFrame,
    by: Sequence[str] = ("user_id",),
    gap: str = "30 minutes",
    bound: str = "5 seconds",
) -> DataFrame:
    """Sessions by inactivity, each handed out once the watermark has passed its gap."""
    sessions = (
        events.withWatermark("event_ts", bound)
        .groupBy(*by, F.session_window("event_ts", gap).alias("session"))
        .agg(
            F.min("event_ts").alias("session_start"),
            F.max("event_ts").alias("session_end"),
            F.count("*").alias("events"),
            F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        )
    )
    return sessions.withColumn(
        "duration_ms", millis("session_end") - millis("session_start")
    ).drop("session")
