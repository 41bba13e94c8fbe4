"""Watermarks and late events over a table of events in arrival order.

An event is late when its window is closed on arrival:
``window_end <= max(event_ts of all earlier arrivals) - bound``.

No event-sized sort is needed to decide that.  For each window end W there is one
first arrival with ``event_ts >= W + bound``, the one that closes W; an event is late
exactly when it arrives after the closer of its window.  Closers are a grouped
minimum (one row per minute of event time) and a running minimum over those minutes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewindow.functions.dims import late_payload, millis, shift, window_end, window_start
from tidewindow.operators.ordered import (
    by_day,
    join_sized,
    measured,
    running_max_before,
    running_over_time,
)
from tidewindow.session import pin

# Rows of minutes with a single arrival time, above which keys are folded further.
CROWDED_ROWS = 1_000_000


@dataclass(frozen=True)
class LatePolicy:
    """Out-of-orderness bound, window width, and the columns that give arrival order."""

    bound_seconds: int = 5
    width_seconds: int = 60
    arrival: Sequence[str] = ("ingest_ts", "event_id")

    @property
    def key_columns(self) -> list[str]:
        # event_ts last: copies of one event do not close a window for each other
        return [*self.arrival, "event_ts"]

    def arrival_key(self) -> Column:
        return F.struct(*self.key_columns)


DEFAULT_POLICY = LatePolicy()


def first_arrivals(events: DataFrame, policy: LatePolicy = DEFAULT_POLICY) -> DataFrame:
    """``closes, first``: per window end the smallest arrival key of the events that reach
    ``bound`` beyond it and not beyond the next one.

    A minimum over whole keys has no fixed-width buffer and would sort the events.  So
    the first column of the key is folded first, and whole keys are compared only among
    the rows that hold its minimum.  Where those are many, because a load gave all of
    them one arrival time, the next column is folded the same way if it is a number.
    """
    closes = window_start(shift("event_ts", -policy.bound_seconds), policy.width_seconds)
    rows = events.select(closes.alias("closes"), *policy.key_columns)
    kinds = dict(rows.dtypes)
    for name in policy.key_columns:
        if kinds[name] not in ("bigint", "int", "timestamp", "timestamp_ntz"):
            break
        least = pin(rows.groupBy("closes").agg(
            F.min(name).alias("_least"), F.max(name).alias("_most"), F.count("*").alias("_n")
        ))
        one_value = least.where("_least = _most").agg(F.sum("_n")).first()[0] or 0
        rows = rows.join(measured(least.select("closes", "_least")), "closes").where(
            F.col(name) == F.col("_least")
        ).drop("_least")
        if one_value <= CROWDED_ROWS:
            break
    return rows.groupBy("closes").agg(F.min(policy.arrival_key()).alias("first"))


def window_closers(events: DataFrame, policy: LatePolicy = DEFAULT_POLICY) -> DataFrame:
    """``window_end, closer``: arrival key of the first event that closes each window."""
    width = policy.width_seconds
    firsts = first_arrivals(events, policy).select(
        F.col("closes").alias("edge"), "first", F.lit(False).alias("used")
    )
    ends = events.select(window_end("event_ts", width).alias("edge")).distinct()
    used = ends.select("edge", F.lit(None).cast(firsts.schema["first"].dataType).alias("first"), F.lit(True).alias("used"))
    edges = (
        by_day(firsts.unionByName(used), "edge")
        .groupBy("_day", "edge")
        .agg(F.min("first").alias("first"), F.max("used").alias("used"))
    )
    return (
        running_over_time(edges, "edge", "first", "closer", largest=False)
        .where("used AND closer IS NOT NULL")
        .select(F.col("edge").alias("window_end"), "closer")
    )


def tag_late(events: DataFrame, policy: LatePolicy = DEFAULT_POLICY) -> DataFrame:
    """Add ``window_end`` and ``is_late``.  Every event is kept."""
    dated = events.withColumn("window_end", window_end("event_ts", policy.width_seconds))
    return (
        join_sized(dated, window_closers(events, policy), ["window_end"])
        .withColumn(
            "is_late", F.coalesce(policy.arrival_key() > F.col("closer"), F.lit(False))
        )
        .drop("closer")
    )


def on_time(events: DataFrame, policy: LatePolicy = DEFAULT_POLICY) -> DataFrame:
    return tag_late(events, policy).where(~F.col("is_late")).drop("is_late", "window_end")


def late_only(events: DataFrame, policy: LatePolicy = DEFAULT_POLICY) -> DataFrame:
    return tag_late(events, policy).where("is_late").drop("is_late")


def late_events(events: DataFrame, policy: LatePolicy = DEFAULT_POLICY) -> DataFrame:
    """Late events with every column, the watermark they met, and their text form.

    Put in order are only the late rows and one step per distinct event time, where
    that time first arrived.  Late events never move the watermark and give no steps.
    """
    tagged = tag_late(events, policy)
    late = tagged.where("is_late").drop("is_late")
    names = late.columns
    row = F.struct(*names)
    kinds = dict(late.dtypes)
    order = [f"_o{i}" for i in range(len(policy.key_columns))]
    rows = late.select(
        *[F.col(c).alias(o) for c, o in zip(policy.key_columns, order)],
        row.alias("_row"),
        F.lit(None).cast("timestamp").alias("_reached"),
    )
    steps = (
        tagged.where("NOT is_late")
        .groupBy(F.col("event_ts").alias("_reached"))
        .agg(F.min(F.struct(*policy.arrival)).alias("_first"))
        .select(
            *[F.col("_first")[c].alias(o) for c, o in zip(policy.arrival, order)],
            F.col("_reached").alias(order[-1]),
            F.lit(None).cast(f"struct<{','.join(f'{n}:{kinds[n]}' for n in names)}>").alias("_row"),
            "_reached",
        )
    )
    stamped = running_max_before(rows.unionByName(steps), order, "_reached", "_seen")
    return (
        stamped.where("_row IS NOT NULL")
        .select("_row.*", shift("_seen", -policy.bound_seconds).alias("watermark"))
        .withColumns({
            "late_by_ms": millis("watermark") - millis("window_end"),
            "payload": late_payload(),
        })
    )


def watermark_trace(events: DataFrame, policy: LatePolicy = DEFAULT_POLICY) -> DataFrame:
    """The watermark each event meets on arrival, null for the first one."""
    keys = [*dict.fromkeys(["event_id", "ingest_ts", *policy.key_columns])]
    points = events.select(*keys)
    seen = running_max_before(points, policy.key_columns, "event_ts", "_seen")
    watermark = shift("_seen", -policy.bound_seconds)
    end = window_end("event_ts", policy.width_seconds)
    return seen.select(
        "event_id",
        "ingest_ts",
        "event_ts",
        watermark.alias("watermark"),
        F.coalesce(end <= watermark, F.lit(False)).alias("is_late"),
    )
