"""Session summaries by inactivity gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewindow.functions.dims import millis

GAP_SECONDS = 30 * 60


def session_summary(
    events: DataFrame, by: Sequence[str] = ("user_id",), gap_seconds: int = GAP_SECONDS
) -> DataFrame:
    """One row per session; a new one starts when the gap is larger than the limit.

    Two events in one epoch-aligned block no wider than the gap are always in the
    same session, so events are first folded into blocks, before any shuffle.  The
    ordered step then sees at most one row per key and block, also for a key that
    holds a third of all events.
    """
    by = list(by)
    gap_ms = gap_seconds * 1000
    instant = millis("event_ts")
    blocks = (
        events.where(F.col("event_ts").isNotNull())
        .groupBy(*by, (instant - F.pmod(instant, F.lit(gap_ms))).alias("_block"))
        .agg(
            F.min("event_ts").alias("_from"),
            F.max("event_ts").alias("_to"),
            F.count("*").alias("_events"),
            F.count_if(F.col("event_type") == "purchase").alias("_purchases"),
        )
    )
    in_time = Window.partitionBy(*by).orderBy("_block")
    upto = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    silence = millis("_from") - millis(F.lag("_to").over(in_time))
    opens = F.when(silence <= gap_ms, 0).otherwise(1)
    numbered = blocks.withColumn("_opens", opens).withColumn(
        "_session", F.sum("_opens").over(upto)
    )
    return (
        numbered.groupBy(*by, "_session")
        .agg(
            F.min("_from").alias("session_start"),
            F.max("_to").alias("session_end"),
            F.sum("_events").alias("events"),
            F.sum("_purchases").alias("purchases"),
        )
        .withColumn("duration_ms", millis("session_end") - millis("session_start"))
        .drop("_session")
    )
