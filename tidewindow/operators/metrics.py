"""Windowed counts and other grouped figures.

All of them aggregate before they shuffle, so what crosses the network is one row
per group and task, however many events a group holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewindow.contract import DIMENSIONS, METRIC_KEY
from tidewindow.functions.dims import millis, shift, window_start, with_dimensions

METRIC_COLUMNS = ["window_start", "window_end", *DIMENSIONS, "event_count", "revenue"]


def purchase_revenue() -> Column:
    """Summed in decimals of six places, so that the order of rows does not matter."""
    value = F.when(F.col("event_type") == "purchase", F.col("value").cast("decimal(24,6)"))
    return F.coalesce(F.sum(value), F.lit(0)).cast("double")


def windowed_counts(
    events: DataFrame, width_seconds: int = 60, with_revenue: bool = False
) -> DataFrame:
    """Events per window, campaign, geo and device.

    ``revenue`` is the constant 0.0 unless ``with_revenue`` asks for the sum of
    ``value`` over purchases.
    """
    keyed = with_dimensions(events).withColumn(
        "window_start", window_start("event_ts", width_seconds)
    )
    totals = [F.count("*").alias("event_count")]
    if with_revenue:
        totals.append(purchase_revenue().alias("revenue"))
    counted = keyed.where(F.col("window_start").isNotNull()).groupBy(*METRIC_KEY).agg(*totals)
    if not with_revenue:
        counted = counted.withColumn("revenue", F.lit(0.0))
    return finish(counted, width_seconds)


def finish(counted: DataFrame, width_seconds: int = 60) -> DataFrame:
    """Add the window end and put the columns in table order."""
    return counted.withColumn("window_end", shift("window_start", width_seconds)).select(
        *METRIC_COLUMNS
    )


def salted_counts(events: DataFrame, salts: int = 16, width_seconds: int = 60) -> DataFrame:
    """The same counts in two explicit steps, for keys whose state must be split.

    The batch plan of ``windowed_counts`` already combines before the shuffle; this
    form bounds the rows of one key per task also where that is not enough.
    """
    salt = F.pmod(F.xxhash64("event_id", "user_id", "ingest_ts"), F.lit(salts))
    keyed = with_dimensions(events).withColumns(
        {"window_start": window_start("event_ts", width_seconds), "salt": salt}
    )
    partial = (
        keyed.where(F.col("window_start").isNotNull())
        .groupBy(*METRIC_KEY, "salt")
        .agg(F.count("*").alias("part"))
    )
    counted = partial.groupBy(*METRIC_KEY).agg(F.sum("part").alias("event_count"))
    return finish(counted.withColumn("revenue", F.lit(0.0)), width_seconds)


def roll_up(metrics: DataFrame, width_seconds: int) -> DataFrame:
    """Wider windows from narrower ones; the wider width must be a multiple."""
    counted = (
        metrics.withColumn("window_start", window_start("window_start", width_seconds))
        .groupBy(*METRIC_KEY)
        .agg(F.sum("event_count").alias("event_count"), F.sum("revenue").alias("revenue"))
    )
    return finish(counted, width_seconds)


def merge_by_sum(*tables: DataFrame) -> DataFrame:
    """Add up metric rows of the same key, as for partial counts."""
    merged = tables[0].select(*METRIC_COLUMNS)
    for table in tables[1:]:
        merged = merged.unionByName(table.select(*METRIC_COLUMNS))
    return (
        merged.groupBy("window_start", "window_end", *DIMENSIONS)
        .agg(F.sum("event_count").alias("event_count"), F.sum("revenue").alias("revenue"))
        .select(*METRIC_COLUMNS)
    )


def _span() -> list[Column]:
    return [F.min("event_ts").alias("first_event"), F.max("event_ts").alias("last_event")]


def _purchases() -> Column:
    return F.count_if(F.col("event_type") == "purchase").alias("purchases")


def user_stats(events: DataFrame) -> DataFrame:
    """Per user, from per-session rows: a hot user shrinks to its sessions first."""
    sessions = events.groupBy("user_id", "session_id").agg(
        F.count("*").alias("n"), _purchases(), *_span()
    )
    return sessions.groupBy("user_id").agg(
        F.sum("n").alias("events"),
        F.count("session_id").alias("sessions"),
        F.sum("purchases").alias("purchases"),
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
    )


def session_stats(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("session_id")
        .agg(F.count("*").alias("events"), _purchases(), *_span())
        .withColumn("duration_ms", millis("last_event") - millis("first_event"))
    )


def source_stats(events: DataFrame) -> DataFrame:
    """Per producer.  Users are counted from (source, user) rows, not from events."""
    pairs = events.groupBy("source", "user_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("campaign_id").isNull()).alias("no_campaign"),
        *_span(),
    )
    return pairs.groupBy("source").agg(
        F.sum("n").alias("events"),
        F.count("user_id").alias("users"),
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
        F.round(F.sum("no_campaign") / F.sum("n"), 6).alias("null_campaign_share"),
    )
