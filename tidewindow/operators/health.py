"""Health figures: rates, lag, delay quantiles, files, and batch durations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewindow.functions.dims import millis, shift, window_start
from tidewindow.operators.lateness import DEFAULT_POLICY, LatePolicy, tag_late
from tidewindow.operators.ordered import by_day, exact_quantiles, running_over_time

# Alert thresholds and backpressure bands.
LATE_RATE_ALERT = 0.1
WATERMARK_LAG_ALERT_MS = 60_000
CONSUMER_LAG_ALERT = 10_000
BUSY_WARN, BUSY_HIGH = 0.5, 0.8


def _per_second(count: str) -> Column:
    return F.round(F.col(count) / 60, 6)


def _by_arrival_minute(events: DataFrame, policy: LatePolicy) -> DataFrame:
    return (
        tag_late(events, policy)
        .groupBy(window_start("ingest_ts").alias("arrival_minute"))
        .agg(F.count("*").alias("records_in"), F.count_if("is_late").alias("late_out"))
    )


def throughput(events: DataFrame, policy: LatePolicy = DEFAULT_POLICY) -> DataFrame:
    """Records in, records on to the counts, and both rates, per arrival minute."""
    return (
        _by_arrival_minute(events, policy)
        .withColumn("records_out", F.col("records_in") - F.col("late_out"))
        .select(
            "arrival_minute",
            "records_in",
            "records_out",
            _per_second("records_in").alias("in_per_s"),
            _per_second("records_out").alias("out_per_s"),
        )
    )


def late_rate(
    events: DataFrame, policy: LatePolicy = DEFAULT_POLICY, limit: float = LATE_RATE_ALERT
) -> DataFrame:
    return _by_arrival_minute(events, policy).select(
        "arrival_minute",
        "late_out",
        _per_second("late_out").alias("late_per_s"),
        (F.col("late_out") / 60 > limit).alias("alert"),
    )


def watermark_lag(events: DataFrame, policy: LatePolicy = DEFAULT_POLICY) -> DataFrame:
    """Lag of the watermark behind the clock at the end of each arrival minute.

    Sampled at minutes with arrivals; the alert looks at the average of the samples
    in the last five minutes.
    """
    minutes = events.groupBy(window_start("ingest_ts").alias("arrival_minute")).agg(
        F.max("event_ts").alias("newest")
    )
    dated = by_day(minutes, "arrival_minute")
    lag = running_over_time(dated, "arrival_minute", "newest", "seen", largest=True).select(
        "arrival_minute",
        shift("seen", -policy.bound_seconds).alias("watermark"),
        (
            millis("arrival_minute") + F.lit(60_000) - millis("seen")
            + F.lit(policy.bound_seconds * 1000)
        ).alias("lag_ms"),
    )
    # each sample counts for its own minute and the four after it
    minute = F.expr("INTERVAL 1 MINUTE")
    counts_for = F.sequence("arrival_minute", shift("arrival_minute", 240), minute)
    spread = lag.select("*", F.posexplode(counts_for))
    own = F.col("pos") == 0
    return (
        spread.groupBy(F.col("col").alias("arrival_minute"))
        .agg(
            F.max(F.when(own, F.col("watermark"))).alias("watermark"),
            F.max(F.when(own, F.col("lag_ms"))).alias("lag_ms"),
            F.round(F.avg("lag_ms"), 6).alias("avg_lag_5m_ms"),
        )
        .where("lag_ms IS NOT NULL")
        .withColumn("alert", F.col("avg_lag_5m_ms") > WATERMARK_LAG_ALERT_MS)
    )


def episodes(
    samples: DataFrame, at: str, value: str, alert: str = "alert",
    gap_seconds: int = 300, hold_seconds: int = 0,
) -> DataFrame:
    """Runs of alerting samples: start, end, samples, peak, and whether the run is still open.

    ``samples`` has one row per minute at most.  A run goes on over minutes without a sample, but
    not over ``gap_seconds`` of them, and ends before a sample that does not alert.  Runs
    shorter than ``hold_seconds``, from the first minute to the end of the last, are left out.
    A run is open if its last sample is the newest one.

    Runs are numbered within each day; what is ordered as a whole is one row per day, with its
    last sample and its number of runs.
    """
    dated = by_day(samples.select(at, value, F.coalesce(alert, F.lit(False)).alias("_on")), at)
    in_day = Window.partitionBy("_day").orderBy(at)
    before = F.struct(F.col(at).alias("at"), F.col("_on").alias("on"))
    told = dated.withColumn("_own", F.lag(before).over(in_day))
    days = Window.orderBy("_day")
    last = dated.groupBy("_day").agg(F.max_by(before, at).alias("_last"))
    carried = last.select(
        "_day", F.lag("_last").over(days).alias("_earlier"),
        F.last("_last").over(days.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))["at"].alias("_newest"),
    )
    previous = F.coalesce("_own", "_earlier")
    goes_on = (
        F.coalesce(previous["on"], F.lit(False))
        & (millis(at) - millis(previous["at"]) <= gap_seconds * 1000)
    )
    begun = told.join(carried, "_day").where("_on").withColumn(
        "_begins", F.when(goes_on, 0).otherwise(1)
    )
    numbered = begun.withColumn("_run", F.sum("_begins").over(in_day))
    upto = numbered.groupBy("_day").agg(F.sum("_begins").alias("_runs")).select(
        "_day",
        F.coalesce(F.sum("_runs").over(days.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
    )
    runs = numbered.join(upto, "_day").groupBy((F.col("_offset") + F.col("_run")).alias("_number")).agg(
        F.min(at).alias("started"), F.max(at).alias("ended"),
        F.count("*").alias("samples"), F.max(value).alias("peak"), F.max("_newest").alias("_newest"),
    )
    lasted = millis("ended") - millis("started") + F.lit(60_000)
    return runs.where(lasted >= hold_seconds * 1000).select(
        "started", "ended", "samples", "peak", (F.col("ended") == F.col("_newest")).alias("is_open")
    )


def ingest_latency(events: DataFrame, by: Sequence[str] = ("arrival_date",)) -> DataFrame:
    """Median, p95 and p99 of arrival time minus event time, per arrival day."""
    delayed = events.select(
        F.date_format("ingest_ts", "yyyy-MM-dd").alias("arrival_date"),
        *[name for name in by if name != "arrival_date"],
        (millis("ingest_ts") - millis("event_ts")).alias("delay_ms"),
    )
    return exact_quantiles(delayed, "delay_ms", by, {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def file_stats(table: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Data files and rows per event day of a file-based table, or of rows with ``file_path``.

    On a stored history the day is a partition value, and no data column is read.
    """
    day = "event_date" if "event_date" in table.columns else ts
    per_file = table.groupBy(
        F.date_format(day, "yyyy-MM-dd").alias("event_date"),
        F.col("file_path" if "file_path" in table.columns else "_metadata.file_path").alias("file_path"),
    ).agg(F.count("*").alias("n"))
    return per_file.groupBy("event_date").agg(
        F.count("file_path").alias("data_files"), F.sum("n").alias("rows")
    )


PROGRESS_JSON = (
    "id string, runId string, batchId long, timestamp string, numInputRows long, "
    "inputRowsPerSecond double, processedRowsPerSecond double, "
    "durationMs struct<triggerExecution: long, walCommit: long, addBatch: long>, "
    "sources array<struct<description: string, metrics: map<string, string>>>"
)


def progress_table(reports: DataFrame) -> DataFrame:
    """Stored reports (``json``), one row per batch: the newest of a repeated one."""
    opened = reports.select(F.from_json("json", PROGRESS_JSON).alias("p"), "json")
    newest = opened.groupBy("p.id", "p.batchId").agg(F.max_by("json", F.coalesce("p.timestamp", F.lit(""))).alias("json"))
    return newest.select(F.from_json("json", PROGRESS_JSON).alias("p")).select("p.*")


def report_rows(spark: SparkSession, progress: Sequence) -> DataFrame:
    """The reports that a query still holds, as rows; the session bounds their number."""
    texts = [(p.json if hasattr(p, "json") else p,) for p in progress]
    return spark.createDataFrame(texts, "json string")


def restarts_of(runs: DataFrame, query: str, run: str) -> DataFrame:
    """Per query how many runs followed its first one."""
    return runs.groupBy(query).agg(
        F.greatest(F.count_distinct(run) - 1, F.lit(0)).alias("restarts")
    )


def batch_figures(written: DataFrame) -> DataFrame:
    """Per committed batch: rows, late and poison rows, their share, and restarts so far.

    ``written`` is the progress table of a job, which holds all batches of all runs.
    A batch that was repeated counts for the run that committed it last.
    """
    return written.join(restarts_of(written, "query_id", "run_id"), "query_id").select(
        "batch_id", "rows", "late_rows", "poison_rows", error_rate(), "restarts"
    )


def error_rate() -> Column:
    total = F.nullif(F.col("rows") + F.col("poison_rows"), F.lit(0))
    return F.round(F.col("poison_rows") / total, 6).alias("error_rate")


def batch_health(
    progress: DataFrame, written: DataFrame, trigger_ms: int = 60_000
) -> DataFrame:
    """Per batch: rows, rates, commit time, busy ratio, errors, restarts, alerts.

    ``progress`` comes from ``progress_table`` over the reports of all runs, ``written``
    is the table of committed batches.  Both have one row per batch.
    """
    behind = F.aggregate(
        "sources",
        F.lit(0).cast("long"),
        lambda most, s: F.greatest(
            most, F.coalesce(s["metrics"]["maxOffsetsBehindLatest"].cast("long"), F.lit(0))
        ),
    )
    runs = restarts_of(progress, "id", "runId")
    busy = F.col("durationMs.triggerExecution") / F.lit(trigger_ms)
    return (
        progress.join(runs, "id")
        .withColumnRenamed("batchId", "batch_id")
        .join(written, "batch_id", "left")
        .select(
            "batch_id",
            F.col("numInputRows").alias("input_rows"),
            F.round("inputRowsPerSecond", 6).alias("input_rows_per_s"),
            F.round("processedRowsPerSecond", 6).alias("processed_rows_per_s"),
            F.col("durationMs.triggerExecution").alias("trigger_ms"),
            F.col("durationMs.walCommit").alias("commit_ms"),
            F.round(busy, 6).alias("busy_ratio"),
            F.when(busy >= BUSY_HIGH, "high").when(busy >= BUSY_WARN, "warn").otherwise("ok")
            .alias("backpressure"),
            behind.alias("rows_behind"),
            (behind > CONSUMER_LAG_ALERT).alias("lag_alert"),
            "rows",
            "late_rows",
            "poison_rows",
            error_rate(),
            "restarts",
        )
    )
