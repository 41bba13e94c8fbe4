"""Reconciliation of served counts with history by stored digests, from the top down.

Each minute of each table has a digest: the hashes of its rows' keys, summed over events.  Sums do
not depend on the order of rows or batches, and they add up: hot, open and late digests of a minute,
an hour or a day are together those of its history if no event was lost or counted twice.
Digests are taken of the stored tables, once for each committed batch, and kept.

A reconciliation adds the signed digests up by day, then only for days that differ by hour, then
by minute, and reads the tables themselves for those minutes alone.  Where nothing differs it
reads digests only.  Two different sets of events have equal digests with a chance of about
one in 2^64.

A digest says what a table held when it was taken: ``update_digests(again=…)`` takes those of
batches anew that were repaired since.  Open windows count as served.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewindow.contract import DIMENSIONS, EVENT_SCHEMA, METRIC_SCHEMA
from tidewindow.functions.dims import window_start, with_dimensions
from tidewindow.operators.ordered import measured
from tidewindow.operators.repair import reconcile
from tidewindow.session import pin
from tidewindow.sinks.tables import Tables, folders_in, path_exists
from tidewindow.sources.tables import read_cold, read_hot, read_late, read_progress

DIGEST_SCHEMA = "minute timestamp, digest decimal(38,0), n long, side string, batch_id long, through long"


def digest_of(rows: DataFrame, side: str, *by: str) -> DataFrame:
    """``minute``, ``digest`` and ``n`` of metric rows, per ``by``; history and late rows are
    metric rows of one event each."""
    key = F.xxhash64(F.unix_seconds("window_start"), *DIMENSIONS).cast("decimal(20,0)")
    events = F.col("event_count").cast("decimal(18,0)")
    return rows.groupBy(*by, F.col("window_start").alias("minute")).agg(
        F.sum((key * events).cast("decimal(38,0)")).cast("decimal(38,0)").alias("digest"),
        F.sum("event_count").alias("n"),
    ).withColumn("side", F.lit(side))


def as_metrics(events: DataFrame, *more: str) -> DataFrame:
    """Metric rows of single events; they are summed with the digests."""
    return with_dimensions(events).select(
        window_start("event_ts").alias("window_start"), *DIMENSIONS,
        F.lit(1).cast("long").alias("event_count"), *more,
    )


def _through(spark: SparkSession, tables: Tables) -> list[int]:
    """Runs of ``update_digests``, by the last batch of each."""
    if not path_exists(spark, tables.digests):
        return []
    names = [f for f in folders_in(spark, tables.digests) if f.startswith("through=")]
    done = [f for f in names if path_exists(spark, f"{tables.digests}/{f}/_SUCCESS")]
    return sorted(int(f.removeprefix("through=")) for f in done)


def _take(spark: SparkSession, tables: Tables, chosen: Column, through: int) -> None:
    parts = [
        digest_of(read_hot(spark, tables).where(chosen), "hot", "batch_id"),
        digest_of(as_metrics(read_cold(spark, tables).where(chosen), "batch_id"), "cold", "batch_id"),
        digest_of(as_metrics(read_late(spark, tables).where(chosen), "batch_id"), "late", "batch_id"),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    rows.write.mode("overwrite").parquet(f"{tables.digests}/through={through}")


def update_digests(spark: SparkSession, tables: Tables, again: Iterable[int] = ()) -> int | None:
    """Take the digests of batches committed since the last run; returns the last batch.

    With ``again`` the runs that hold one of these batches are taken anew.
    """
    runs = _through(spark, tables)
    bounds = dict(zip(runs, [-1, *runs]))
    for through in {min((r for r in runs if r >= b), default=None) for b in again} - {None}:
        _take(spark, tables, F.col("batch_id").between(bounds[through] + 1, through), through)
    last = read_progress(spark, tables).agg(F.max("batch_id")).first()[0]
    before = runs[-1] if runs else -1
    if last is not None and last > before:
        _take(spark, tables, F.col("batch_id").between(before + 1, last), last)
    return last


def _open(spark: SparkSession, tables: Tables, last: int) -> DataFrame:
    """Counts of windows that are not closed yet; none for tables that no job wrote."""
    place = tables.open_windows(last)
    if not path_exists(spark, place):
        return spark.createDataFrame([], METRIC_SCHEMA)
    return spark.read.schema(METRIC_SCHEMA).parquet(place)


def differing_minutes(spark: SparkSession, tables: Tables) -> DataFrame | None:
    """``minute`` of what is not explained, pinned; None if there is nothing."""
    last = update_digests(spark, tables)
    if last is None:
        return None
    stored = spark.read.schema(DIGEST_SCHEMA).parquet(tables.digests).select("minute", "digest", "n", "side")
    every = stored.unionByName(digest_of(_open(spark, tables, last), "open"))
    sign = F.when(F.col("side") == "cold", 1).otherwise(-1).cast("decimal(1,0)")
    signed = every.select(
        "minute", (sign * F.col("digest")).cast("decimal(38,0)").alias("digest"),
        (sign.cast("long") * F.col("n")).alias("n"),
    )

    def differing(level: str) -> DataFrame:
        return signed.groupBy(F.date_trunc(level, "minute").alias("at")).agg(
            F.sum("digest").alias("digest"), F.sum("n").alias("n")
        ).where("digest <> 0 OR n <> 0").select("at")

    for level in ("day", "hour"):
        branches = pin(differing(level))
        if branches.isEmpty():
            return None
        inside = F.date_trunc(level, "minute") == F.col("at")
        signed = signed.join(measured(branches), inside, "left_semi")
    return pin(differing("minute").withColumnRenamed("at", "minute"))


def reconcile_changed(spark: SparkSession, tables: Tables) -> DataFrame:
    """Keys whose served counts are not history without its late events: those rows of
    ``reconcile`` that are unexplained, from the minutes that differ."""
    minutes = differing_minutes(spark, tables)
    if minutes is None:
        nothing = spark.createDataFrame([], METRIC_SCHEMA)
        events = spark.createDataFrame([], EVENT_SCHEMA)
        return reconcile(nothing, events, events)
    days = [r[0] for r in minutes.select(F.to_date("minute")).distinct().collect()]
    last = read_progress(spark, tables).agg(F.max("batch_id")).first()[0]
    own = measured(minutes)

    def of(rows: DataFrame, start: Column) -> DataFrame:
        return rows.join(own, start == F.col("minute"), "left_semi")

    hot = of(read_hot(spark, tables).where(F.col("window_date").isin(days)), F.col("window_start"))
    still = of(_open(spark, tables, last), F.col("window_start"))
    cold = of(read_cold(spark, tables).where(F.col("event_date").isin(days)), window_start("event_ts"))
    late = of(read_late(spark, tables), window_start("event_ts"))
    names = METRIC_SCHEMA.names
    served = hot.select(*names).unionByName(still.select(*names))
    return reconcile(served, cold, late).where("unexplained <> 0")
