"""Batch jobs that replay, rebuild and reconcile."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewindow.contract import DIMENSIONS
from tidewindow.functions.dims import window_start, with_dimensions
from tidewindow.operators.metrics import merge_by_sum, windowed_counts
from tidewindow.operators.quality import dedup_events


def day_range(
    cold: DataFrame, first: dt.date | str, last: dt.date | str, ts: str = "event_ts"
) -> DataFrame:
    """Rows of the days ``first`` to ``last``, both included.

    On a stored history the ``event_date`` bounds prune partitions; the time bounds
    serve row-group statistics and tables without that column.
    """
    first, last = F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")
    kind = dict(cold.dtypes)[ts]
    kept = cold.where(
        (F.col(ts) >= first.cast(kind)) & (F.col(ts) < F.date_add(last, 1).cast(kind))
    )
    if "event_date" in cold.columns:
        kept = kept.where(F.col("event_date").between(first, last))
    return kept


def as_of(cold: DataFrame, batch_id: int) -> DataFrame:
    """History as it was after a given batch."""
    return cold.where(F.col("batch_id") <= batch_id)


def rebuild_from_cold(
    cold: DataFrame,
    first: dt.date | str | None = None,
    last: dt.date | str | None = None,
    width_seconds: int = 60,
) -> DataFrame:
    """Metrics recounted from history, for a range of days or for all."""
    if first is not None and last is not None:
        cold = day_range(cold, first, last)
    return windowed_counts(cold, width_seconds)


def not_applied(candidates: DataFrame, applied: DataFrame, key: str = "event_id") -> DataFrame:
    """Replay candidates that were not applied yet, each once.

    The anti-join comes first, so only rows that are new are folded to one per id.
    """
    known = applied.select(key).distinct()
    return dedup_events(candidates.join(known, key, "left_anti"), key)


def replay_late(
    hot: DataFrame, candidates: DataFrame, applied: DataFrame, width_seconds: int = 60
) -> DataFrame:
    """Metrics after a replay: served rows plus the counts of what is newly applied."""
    needed = ("event_id", "ingest_ts", "event_ts", *DIMENSIONS)
    partial = windowed_counts(not_applied(candidates.select(*needed), applied), width_seconds)
    return merge_by_sum(hot, partial)


def reconcile_tagged(tagged: DataFrame) -> DataFrame:
    """``reconcile`` where all three come from one table with ``is_late``: a single pass."""
    counted = (
        with_dimensions(tagged)
        .groupBy(window_start("event_ts").alias("window_start"), *DIMENSIONS)
        .agg(
            F.count_if(~F.col("is_late")).alias("hot_count"),
            F.count("*").alias("cold_count"),
            F.count_if("is_late").alias("late_count"),
        )
    )
    return _differing(counted)


def _differing(counted: DataFrame) -> DataFrame:
    return counted.withColumn(
        "unexplained", F.col("cold_count") - F.col("late_count") - F.col("hot_count")
    ).where((F.col("cold_count") != F.col("hot_count")) | (F.col("unexplained") != 0))


def reconcile(hot: DataFrame, cold: DataFrame, late: DataFrame) -> DataFrame:
    """Keys where served counts differ from history, and how far late rows explain it.

    All three are counted per key already or here; adding up signed counts of one
    union takes a single shuffle and treats a missing side as zero.
    """
    parts = None
    for name, table in (
        ("hot_count", hot),
        ("cold_count", windowed_counts(cold)),
        ("late_count", windowed_counts(late)),
    ):
        part = table.select(
            "window_start",
            *DIMENSIONS,
            *[
                (F.col("event_count") if other == name else F.lit(0).cast("long")).alias(other)
                for other in ("hot_count", "cold_count", "late_count")
            ],
        )
        parts = part if parts is None else parts.unionByName(part)
    return _differing(
        parts.groupBy("window_start", *DIMENSIONS).agg(
            *[F.sum(n).alias(n) for n in ("hot_count", "cold_count", "late_count")]
        )
    )
