"""The registered queries: each takes a session and a data folder.

Every query reads the whole ``events`` table of the folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewindow import contract as C
from tidewindow.functions import dims, envelope
from tidewindow.operators import (
    health,
    lateness,
    metrics,
    quality,
    repair,
    serving,
    sessions,
    sketches,
)
from tidewindow.session import run_folder
from tidewindow.sinks import compaction, external, versions
from tidewindow.sinks.tables import (
    Tables,
    cold_rows,
    move_folder,
    write_batch,
    write_cold,
    write_hot,
)
from tidewindow.sources.clickstream import (
    CLICKSTREAM_POLICY,
    clickstream,
    read_events,
)
from tidewindow.sources.tables import (
    read_cold,
    read_hot,
    read_late,
    read_latest_windows,
    read_poison,
    read_progress,
)
from tidewindow.sources.topics import file_stream
from tidewindow.streaming import digests
from tidewindow.streaming.job import StreamJob

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

COLD_DAY = "2024-01-15"
REBUILD_DAYS = ("2024-01-05", "2024-01-11")
CAMPAIGN = "camp_3"
FAULT_DAY = "2024-01-10"
SCHEMA_ID = 42


def registered(query: Query) -> Query:
    """Make a query known under its name, with timestamps free of a time zone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dims.plain_timestamps(query(spark, sf_dir))

    QUERIES[query.__name__] = run
    return query


def _late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lateness.late_only(clickstream(spark, sf_dir), CLICKSTREAM_POLICY)


def _on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lateness.on_time(clickstream(spark, sf_dir), CLICKSTREAM_POLICY)


def _resent(events: DataFrame) -> DataFrame:
    """A second copy of every event, one second later."""
    return events.withColumn("ingest_ts", dims.shift("ingest_ts", 1))


# ---- scans, decoding, contract


@registered
def scan_events(spark, sf_dir):
    return clickstream(spark, sf_dir).select(*C.EVENT_COLUMNS)


@registered
def wire_envelope(spark, sf_dir):
    """Wrap each event's payload, damage some by event type, and open them again."""
    kind = F.col("event_type")
    good = envelope.wrap(F.col("props").cast("binary"), SCHEMA_ID)
    value = (
        F.when(kind == "error", F.concat(F.unhex(F.lit("01")), F.expr("substring(good, 2)")))
        .when(kind == "signup", F.substring("good", 1, 3))
        .when(kind == "view", F.lit(None))
        .otherwise(F.col("good"))
    )
    raw = read_events(spark, sf_dir).withColumn("good", good).withColumn("value", value)
    return envelope.unwrap(raw).select(
        "event_id",
        F.hex("value").alias("value_hex"),
        "envelope_status",
        "schema_id",
        F.col("body").cast("string").alias("body"),
    )


@registered
def conform_schema(spark, sf_dir):
    """Events of an older producer: the columns with defaults are not there."""
    old = clickstream(spark, sf_dir).select(*C.REQUIRED_COLUMNS, "campaign_id")
    return C.conform(old)


@registered
def contract_violations(spark, sf_dir):
    """The plain ``events`` table held against the click-event contract."""
    return C.contract_violations(read_events(spark, sf_dir))


@registered
def history_of_versions(spark, sf_dir):
    """Three loads by producers of three versions, read under the newest one."""
    root = run_folder(spark, "versions")
    table, listed = f"{root}/events", f"{root}/versions"
    required = tuple(f for f in C.CLICK_EVENT if f.name in (*C.REQUIRED_COLUMNS, "campaign_id"))
    first = (*required, C.Field("geo", T.StringType(), default="EARTH"))
    second = (*first, C.Field("device", T.StringType(), default="none"))
    for load, (version, left_out) in enumerate(((first, ["geo"]), (second, ["device"]), (C.CLICK_EVENT, []))):
        versions.begin_version(spark, listed, load, version)
        columns = [f.name for f in version if f.name not in left_out]
        day = F.dayofmonth("event_ts") % 3 == load
        write_batch(clickstream(spark, sf_dir).where(day).select(*columns), table, load)
    return versions.read_versions(spark, table, listed)


@registered
def poison_rows(spark, sf_dir):
    """JSON messages, some of them cut short or without a user, decoded and sorted out."""
    kind = F.col("event_type")
    events = clickstream(spark, sf_dir).withColumn(
        "user_id", F.when(kind != "signup", F.col("user_id"))
    )
    text = quality.json_value(C.EVENT_COLUMNS)
    cut = F.expr("left(text, length(text) - 1)")
    raw = events.select("event_type", text.alias("text")).select(
        F.when(kind == "error", cut).otherwise(F.col("text")).alias("value")
    )
    poison = quality.split_poison(quality.parse_json_events(raw))[1]
    return poison.withColumn("raw", F.col("raw").cast("string"))


@registered
def publish_keyed(spark, sf_dir):
    return external.publish_keyed(clickstream(spark, sf_dir), C.EVENT_COLUMNS)


# ---- projections and expressions


@registered
def project_dimensions(spark, sf_dir):
    return dims.with_dimensions(clickstream(spark, sf_dir)).select(
        "event_id", "event_ts", *C.DIMENSIONS
    )


@registered
def cold_events(spark, sf_dir):
    return dims.cold_projection(clickstream(spark, sf_dir)).withColumn(
        "event_date", F.date_format("event_ts", "yyyy-MM-dd")
    )


@registered
def millis_roundtrip(spark, sf_dir):
    return (
        clickstream(spark, sf_dir)
        .select("event_id", dims.millis("event_ts").alias("event_ms"))
        .withColumn("event_ts", dims.from_millis("event_ms"))
    )


@registered
def composite_key(spark, sf_dir):
    counted = (
        dims.with_dimensions(clickstream(spark, sf_dir))
        .groupBy(*C.DIMENSIONS)
        .agg(F.count("*").alias("event_count"))
    )
    return counted.select(dims.composite_key().alias("composite_key"), "event_count")


# ---- windowed and grouped figures


@registered
def metrics_1m(spark, sf_dir):
    return metrics.windowed_counts(clickstream(spark, sf_dir))


@registered
def metrics_1m_revenue(spark, sf_dir):
    return metrics.windowed_counts(clickstream(spark, sf_dir), with_revenue=True)


@registered
def metrics_5m(spark, sf_dir):
    return metrics.windowed_counts(clickstream(spark, sf_dir), 300)


@registered
def metrics_1m_salted(spark, sf_dir):
    return metrics.salted_counts(clickstream(spark, sf_dir))


@registered
def user_stats(spark, sf_dir):
    return metrics.user_stats(clickstream(spark, sf_dir))


@registered
def session_stats(spark, sf_dir):
    return metrics.session_stats(clickstream(spark, sf_dir))


@registered
def source_stats(spark, sf_dir):
    return metrics.source_stats(clickstream(spark, sf_dir))


@registered
def session_summary(spark, sf_dir):
    return sessions.session_summary(clickstream(spark, sf_dir))


# ---- late data


@registered
def watermark_trace(spark, sf_dir):
    return lateness.watermark_trace(clickstream(spark, sf_dir), CLICKSTREAM_POLICY)


@registered
def late_events(spark, sf_dir):
    return lateness.late_events(clickstream(spark, sf_dir), CLICKSTREAM_POLICY).select(
        *C.EVENT_COLUMNS, "window_end", "watermark", "late_by_ms", "payload"
    )


@registered
def late_payload(spark, sf_dir):
    return _late(spark, sf_dir).select("event_id", dims.late_payload().alias("payload"))


@registered
def metrics_1m_ontime(spark, sf_dir):
    return metrics.windowed_counts(_on_time(spark, sf_dir))


# ---- serving


@registered
def hot_latest_by_key(spark, sf_dir):
    """Counts written by one batch, then again without late events by the next."""
    first = metrics_1m(spark, sf_dir).withColumn("batch_id", F.lit(0).cast("long"))
    again = metrics_1m_ontime(spark, sf_dir).withColumn("batch_id", F.lit(1).cast("long"))
    latest = serving.latest_by_key(first.unionByName(again))
    return latest.select(*metrics.METRIC_COLUMNS, "batch_id")


@registered
def latest_windows(spark, sf_dir):
    return serving.latest_windows(metrics_1m(spark, sf_dir))


@registered
def filter_campaign(spark, sf_dir):
    return serving.for_campaign(metrics_1m(spark, sf_dir), CAMPAIGN)


# ---- history and repair


@registered
def cold_scan_day(spark, sf_dir):
    return dims.cold_projection(clickstream(spark, sf_dir, (COLD_DAY, COLD_DAY)))


@registered
def cold_as_of(spark, sf_dir):
    """History after the tenth daily load; the load is told by the arrival day."""
    load = F.datediff(F.to_date("ingest_ts"), F.to_date(F.lit("2024-01-01"))).cast("long")
    loaded = clickstream(spark, sf_dir).withColumn("batch_id", load)
    return repair.as_of(loaded, 9).select(*C.COLD_COLUMNS, "batch_id")


@registered
def cold_file_stats(spark, sf_dir):
    return health.file_stats(read_events(spark, sf_dir), "ts")


def _packed_history(spark: SparkSession, sf_dir: str) -> Tables:
    """History of daily loads whose first weeks were compacted in two goes, and removed."""
    tables = Tables(run_folder(spark, "packed"))
    tables.create(spark)
    load = F.datediff(F.to_date("ingest_ts"), F.to_date(F.lit("2024-01-01"))).cast("long")
    loaded = cold_rows(clickstream(spark, sf_dir), load.alias("batch_id"))
    loaded.write.partitionBy("batch_id", "event_date").parquet(tables.cold, mode="append")
    for part in ("batch_id <= 9", "batch_id <= 19"):
        done = loaded.where(part).agg(
            F.max("event_ts").alias("max_event_ts"), F.max("batch_id").alias("batch_id")
        )
        done.write.partitionBy("batch_id").parquet(tables.progress, mode="append")
        compaction.compact(spark, tables)
    compaction.vacuum(spark, tables)
    return tables


@registered
def cold_packed(spark, sf_dir):
    return read_cold(spark, _packed_history(spark, sf_dir)).select(*C.COLD_COLUMNS, "batch_id")


@registered
def cold_packed_files(spark, sf_dir):
    """Days that were packed have a file for each time they were, others one for each load."""
    return health.file_stats(read_cold(spark, _packed_history(spark, sf_dir), files=True))


@registered
def rebuild_from_cold(spark, sf_dir):
    cold = dims.cold_projection(clickstream(spark, sf_dir, REBUILD_DAYS))
    return repair.rebuild_from_cold(cold)


@registered
def dedup_events(spark, sf_dir):
    events = clickstream(spark, sf_dir).select(*C.EVENT_COLUMNS)
    return quality.dedup_events(events.unionByName(_resent(events)))


@registered
def replay_late(spark, sf_dir):
    """Replay late events together with events that were counted in time already."""
    tagged = lateness.tag_late(clickstream(spark, sf_dir), CLICKSTREAM_POLICY)
    in_time = tagged.where(~F.col("is_late"))
    candidates = tagged.where("is_late").unionByName(_resent(in_time))
    served = metrics.windowed_counts(in_time)
    return repair.replay_late(served, candidates, in_time)


@registered
def reconcile_hot_cold(spark, sf_dir):
    tagged = lateness.tag_late(clickstream(spark, sf_dir), CLICKSTREAM_POLICY)
    return repair.reconcile_tagged(tagged)


@registered
def reconcile_changed(spark, sf_dir):
    """Stored tables with two faults in the served counts, found from digests: some windows of a
    campaign counted one event too many, and those of a region and a day were lost."""
    tables = Tables(run_folder(spark, "faults"))
    tables.create(spark)
    tagged = lateness.tag_late(clickstream(spark, sf_dir), CLICKSTREAM_POLICY)
    served = metrics.windowed_counts(tagged.where("NOT is_late"))
    lost = (F.col("geo") == "EU") & (F.to_date("window_start") == FAULT_DAY)
    doubled = (F.col("campaign_id") == CAMPAIGN) & (F.minute("window_start") % 5 == 0)
    faulty = served.where(~lost).withColumn(
        "event_count", F.col("event_count") + F.when(doubled, 1).otherwise(0)
    )
    write_hot(faulty, tables.hot, 0)
    write_cold(tagged, tables.cold, 0)
    write_batch(tagged.where("is_late").select(*C.EVENT_COLUMNS), tables.late, 0)
    write_batch(tagged.agg(F.max("event_ts").alias("max_event_ts")), tables.progress, 0)
    return digests.reconcile_changed(spark, tables)


# ---- health


@registered
def throughput_1m(spark, sf_dir):
    return health.throughput(clickstream(spark, sf_dir), CLICKSTREAM_POLICY)


@registered
def late_rate_1m(spark, sf_dir):
    return health.late_rate(clickstream(spark, sf_dir), CLICKSTREAM_POLICY)


@registered
def watermark_lag_1m(spark, sf_dir):
    return health.watermark_lag(clickstream(spark, sf_dir), CLICKSTREAM_POLICY)


@registered
def late_rate_episodes(spark, sf_dir):
    """Times in which every minute with arrivals had late ones."""
    rates = health.late_rate(clickstream(spark, sf_dir), CLICKSTREAM_POLICY, limit=0)
    return health.episodes(rates, "arrival_minute", "late_per_s", gap_seconds=3600)


@registered
def watermark_lag_episodes(spark, sf_dir):
    """Times in which the lag alert held for five minutes or more."""
    lag = health.watermark_lag(clickstream(spark, sf_dir), CLICKSTREAM_POLICY)
    return health.episodes(lag, "arrival_minute", "avg_lag_5m_ms", gap_seconds=600, hold_seconds=300)


@registered
def ingest_latency(spark, sf_dir):
    return health.ingest_latency(clickstream(spark, sf_dir))


@registered
def latency_sketch_ranks(spark, sf_dir):
    """Delay quantiles of each day from sketches by day and region, merged: whether their ranks
    are as near as stated."""
    delayed = sketches.delays(clickstream(spark, sf_dir))
    path = run_folder(spark, "sketches")
    sketches.write_sketches(delayed, ["arrival_date", "geo"], path, 0)
    found = sketches.merged_quantiles(sketches.read_sketches(spark, path), ["arrival_date"])
    errors = sketches.rank_errors(delayed, found, ["arrival_date"])
    return errors.select("arrival_date", "events", *[
        (F.col(f"{p}_error") <= sketches.RANK_ERROR).alias(f"{p}_near") for p in sketches.PROBABILITIES
    ])


@registered
def ingest_latency_by_campaign(spark, sf_dir):
    """Events without a campaign are a group of their own."""
    return health.ingest_latency(clickstream(spark, sf_dir), ("campaign_id",))


# ---- the streaming job

_jobs: dict[tuple[str, str], Tables] = {}
ROWS_PER_SENT_FILE = 200_000


def stream_weeks(spark: SparkSession, sf_dir: str, root: str) -> Tables:
    """The events through the job, one batch for each week, each in a run of its own.

    Events that took time to arrive were held back by their producer and come with the
    batch of the next week, so most of them are late.  Events of type ``error`` come
    without a user and are poison.
    """
    events = clickstream(spark, sf_dir).withColumn(
        "user_id", F.when(F.col("event_type") != "error", F.col("user_id"))
    )
    held_back = F.col("ingest_ts") > F.col("event_ts")
    days = F.datediff(F.to_date("ingest_ts"), F.to_date(F.lit("2024-01-01")))
    week = F.floor(days / 7) + F.when(held_back, 1).otherwise(0)
    sent = events.select(*C.EVENT_COLUMNS, week.alias("week"))
    tables = Tables(f"{root}/tables")
    # Written once for all weeks; a large week is several files, so that a batch has many tasks.
    sent.hint("rebalance", "week").write.option("maxRecordsPerFile", ROWS_PER_SENT_FILE).partitionBy(
        "week"
    ).parquet(f"{root}/sent")
    for (number,) in sorted(sent.select("week").distinct().collect()):  # a row for each week
        move_folder(spark, f"{root}/sent/week={number}", f"{root}/in/week={number}")
        # all files that are new since the last run are one batch
        StreamJob(tables, CLICKSTREAM_POLICY).start(
            file_stream(spark, f"{root}/in/*"), f"{root}/checkpoint", availableNow=True
        ).awaitTermination()
        # out of the way, so that a run lists the files of its own week only
        move_folder(spark, f"{root}/in/week={number}", f"{root}/done/week={number}")
    return tables


def _streamed(spark: SparkSession, sf_dir: str) -> Tables:
    """The tables of that job; one job serves all queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _jobs:
        _jobs[key] = stream_weeks(spark, sf_dir, run_folder(spark, "weeks"))
    return _jobs[key]


@registered
def stream_hot(spark, sf_dir):
    return read_hot(spark, _streamed(spark, sf_dir)).select(*metrics.METRIC_COLUMNS, "batch_id")


@registered
def latest_windows_stored(spark, sf_dir):
    """The newest closed windows of the job's table, from its newest batch folders."""
    return read_latest_windows(spark, _streamed(spark, sf_dir), folders=1).select(
        *metrics.METRIC_COLUMNS, "batch_id"
    )


@registered
def stream_late(spark, sf_dir):
    return read_late(spark, _streamed(spark, sf_dir)).select(
        *C.EVENT_COLUMNS, "window_end", "watermark", "late_by_ms", "payload", "batch_id"
    )


@registered
def stream_cold(spark, sf_dir):
    return read_cold(spark, _streamed(spark, sf_dir)).select(*C.COLD_COLUMNS, "batch_id")


@registered
def stream_poison(spark, sf_dir):
    return read_poison(spark, _streamed(spark, sf_dir)).select(
        F.get_json_object(F.col("raw").cast("string"), "$.event_id").alias("event_id"),
        "reason", "batch_id",
    )


@registered
def batch_health(spark, sf_dir):
    """What the job's own table says of its batches, over all its runs."""
    return health.batch_figures(read_progress(spark, _streamed(spark, sf_dir)))


@registered
def batch_reports(spark, sf_dir):
    """Figures of stored progress reports, as a query that takes a day in a batch would leave
    them: durations and rows behind grow with the rows of the day, and every ten days it was
    started again."""
    days = clickstream(spark, sf_dir).groupBy(
        F.datediff(F.to_date("ingest_ts"), F.to_date(F.lit("2024-01-01"))).alias("batch_id")
    ).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("poison_rows"))
    report = F.to_json(F.struct(
        F.lit("q").alias("id"), F.concat(F.lit("run-"), F.floor(F.col("batch_id") / 10)).alias("runId"),
        F.col("batch_id").alias("batchId"), F.col("n").alias("numInputRows"),
        (F.col("n") / 60).alias("inputRowsPerSecond"), (F.col("n") / 30).alias("processedRowsPerSecond"),
        F.struct(
            (F.col("n") * 1000 % 60_000).alias("triggerExecution"), (F.col("n") % 7).alias("walCommit")
        ).alias("durationMs"),
        F.array(F.struct(F.lit("topic").alias("description"), F.create_map(
            F.lit("maxOffsetsBehindLatest"), (F.col("n") * 30).cast("string")
        ).alias("metrics"))).alias("sources"),
    ))
    reports = health.progress_table(days.select(report.alias("json")))
    written = days.select(
        F.col("batch_id").cast("long").alias("batch_id"), (F.col("n") - F.col("poison_rows")).alias("rows"),
        F.lit(0).cast("long").alias("late_rows"), "poison_rows",
    )
    return health.batch_health(reports, written)
