"""Replays of late events onto the tables of a streaming job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewindow.contract import EVENT_COLUMNS
from tidewindow.operators.metrics import merge_by_sum, windowed_counts
from tidewindow.operators.quality import parse_json_events, split_poison
from tidewindow.operators.repair import not_applied
from tidewindow.session import pin
from tidewindow.sinks.tables import Tables, path_exists
from tidewindow.sources.tables import read_hot, read_late, read_poison, read_replayed


def replay_late_table(
    spark: SparkSession, tables: Tables, replay_id: int, late: DataFrame | None = None
) -> None:
    """Apply the late events that no earlier replay applied, under ``replay_id``.

    Rows of a repeated batch are replaced, those of a replay are added; so replays
    keep their own table.  One write per replay: it is applied as a whole or not, and
    running it again replaces its own rows.
    """
    applied = read_replayed(spark, tables).where(F.col("replay_id") < replay_id)
    candidates = (read_late(spark, tables) if late is None else late).select(*EVENT_COLUMNS)
    not_applied(candidates, applied).write.mode("overwrite").parquet(
        f"{tables.replayed}/replay_id={replay_id}"
    )


def late_from_topic(messages: DataFrame) -> DataFrame:
    """Late events from the JSON messages of their topic (``kafka_table``)."""
    return split_poison(parse_json_events(messages))[0].select(*EVENT_COLUMNS)


LEDGER_SCHEMA = "topic string, partition int, until long, replay_id long"


def ledger(spark: SparkSession, tables: Tables) -> DataFrame:
    """Positions that replays have read of topics: before ``until``, by replay."""
    if not path_exists(spark, tables.ledger):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(tables.ledger)


def read_up_to(spark: SparkSession, tables: Tables) -> dict[str, dict[int, int]]:
    """Per topic and partition the first position that no replay has read.

    In JSON this is where ``kafka_table`` begins, so that what was applied is not even read.
    """
    upto: dict[str, dict[int, int]] = {}
    for row in ledger(spark, tables).groupBy("topic", "partition").agg(F.max("until").alias("until")).collect():
        upto.setdefault(row["topic"], {})[row["partition"]] = row["until"]
    return upto


def replay_topic(
    spark: SparkSession,
    tables: Tables,
    messages: DataFrame,
    decode: Callable[[DataFrame], DataFrame] = parse_json_events,
) -> int:
    """Apply the messages of a topic that no replay has read yet; returns the replay's id.

    ``messages`` has ``topic``, ``partition``, ``offset`` and ``value``, as a batch read of topics
    has.  A message is known by its place, so a second read of the topic adds nothing,
    also where events have no id, and two messages that are alike count twice, as they were
    sent.  Messages that cannot be decoded are read but not applied.

    The ledger is written last: a replay that broke off is not in it, and the next one takes its
    id and replaces its rows.
    """
    done = ledger(spark, tables)
    replay_id = (done.agg(F.max("replay_id")).first()[0] or 0) + 1
    # a row for each partition of a topic
    upto = done.groupBy("topic", "partition").agg(F.max("until").alias("_until"))
    fresh = messages.join(F.broadcast(pin(upto)), ["topic", "partition"], "left").where(
        F.col("offset") >= F.coalesce("_until", F.lit(0))
    ).drop("_until")
    once = fresh.dropDuplicates(["topic", "partition", "offset"])
    good = split_poison(decode(once))[0].select(*EVENT_COLUMNS)
    good.write.mode("overwrite").parquet(f"{tables.topic_replays}/replay_id={replay_id}")
    ends = fresh.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("until"))
    ends.write.mode("overwrite").parquet(f"{tables.ledger}/replay_id={replay_id}")
    return replay_id


def reread_poison(
    spark: SparkSession, tables: Tables, decode: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """``(good, poison)``: stored poison through a decoder that may know more by now.

    ``decode`` gets the raw bytes as ``value`` and gives event columns and the
    ``decoded`` column of ``operators.quality``.
    The good rows can be given to ``replay_late_table`` as ``late``.
    """
    raw = read_poison(spark, tables).select(F.col("raw").alias("value"))
    return split_poison(decode(raw))


def served_metrics(spark: SparkSession, tables: Tables) -> DataFrame:
    """Closed windows of the job plus the counts of everything replayed."""
    return merge_by_sum(
        read_hot(spark, tables), windowed_counts(read_replayed(spark, tables))
    )
