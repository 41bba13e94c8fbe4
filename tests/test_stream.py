"""The streaming job on known batches: one file is one batch."""

import os
import random
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL, at, event, offset
from pyspark.sql import types as T

from tidewindow.contract import DECODED, EVENT_COLUMNS, EVENT_SCHEMA
from tidewindow.operators import health, metrics
from tidewindow.plans.catalog import stream_weeks
from tidewindow.sinks.tables import Tables
from tidewindow.sources import tables as reads
from tidewindow.sources.clickstream import CLICKSTREAM_POLICY, clickstream
from tidewindow.sources.topics import file_stream
from tidewindow.streaming import main, native
from tidewindow.streaming.job import StreamJob
from tidewindow.streaming.replay import replay_late_table, reread_poison, served_metrics

ARROW = pa.schema([
    (f.name, pa.timestamp("us", tz="UTC") if f.name.endswith("_ts") else pa.string())
    for f in EVENT_SCHEMA
])


class Run:
    """Input files, tables and checkpoint of one job."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)
        self.input = f"{self.folder}/in"
        os.mkdir(self.input)
        self.files = 0
        self.tables = Tables(f"{self.folder}/tables")

    def add(self, rows):
        path = f"{self.input}/{self.files:05d}.parquet"
        pq.write_table(pa.Table.from_pylist(rows, schema=ARROW), path)
        os.utime(path, (1000 + self.files, 1000 + self.files))
        self.files += 1

    def stream(self, spark=None):
        return file_stream(spark or self.spark, self.input, files_per_trigger=1)

    def job(self, job=None):
        query = (job or StreamJob(self.tables)).start(
            self.stream(), f"{self.folder}/checkpoint", availableNow=True
        )
        query.awaitTermination(300)
        return query

    def native(self, frame, name):
        out = f"{self.folder}/{name}"
        query = (
            frame.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", f"{self.folder}/checkpoint_{name}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(300)
        return self.spark.read.parquet(out)

    def hot(self):
        return counted(reads.read_hot(self.spark, self.tables))

    def progress(self):
        return reads.read_progress(self.spark, self.tables).orderBy("batch_id").collect()


def counted(df):
    rows = df.collect()
    found = {
        (offset(r.window_start), r.campaign_id, r.geo, r.device): r.event_count for r in rows
    }
    assert len(found) == len(rows)
    return found


@pytest.fixture
def run(spark, tmp_path):
    return Run(spark, tmp_path)


def late_scenario(run):
    run.add([
        event(f"f{i}", 120 + i, 0, user_id="user_future", campaign_id="camp_future")
        for i in range(200)
    ])
    run.add([
        event(f"v{i}", -300 + i, 0, user_id="user_verify_late", campaign_id="camp_verify_dropped")
        for i in range(5)
    ])
    key = ("camp_future", "US", "mobile")
    return {(120, *key): 60, (180, *key): 60, (240, *key): 60}


def test_late_scenario(spark, run):
    """A watermark far ahead, then five old events: counted nowhere, kept as late."""
    closed = late_scenario(run)
    run.job()
    assert run.hot() == closed
    served = reads.read_hot(spark, run.tables)
    assert served.where("campaign_id = 'camp_verify_dropped'").count() == 0
    late = reads.read_late(spark, run.tables).collect()
    assert {r.event_id for r in late} == {f"v{i}" for i in range(5)}
    assert {offset(r.watermark) for r in late} == {314}
    assert {r.payload for r in late} == {"LATE: (camp_verify_dropped,US,mobile,dummy,1,0)"}
    assert reads.read_cold(spark, run.tables).count() == 205
    open_windows = spark.read.parquet(run.tables.open_windows(1))
    assert counted(open_windows) == {(300, "camp_future", "US", "mobile"): 20}
    assert [(p.rows, p.late_rows, p.poison_rows) for p in run.progress()] == [(200, 0, 0), (5, 5, 0)]


def test_native_counts_of_late_scenario(spark, run):
    closed = late_scenario(run)
    session = native.stateful_session(spark)
    assert counted(run.native(native.stream_counts(run.stream(session)), "counts")) == closed


def test_replay_adds_late_events_once(spark, run):
    closed = late_scenario(run)
    run.job()
    replay_late_table(spark, run.tables, 1)
    replay_late_table(spark, run.tables, 1)
    replay_late_table(spark, run.tables, 2)
    old = {(-300, "camp_verify_dropped", "US", "mobile"): 5}
    assert counted(served_metrics(spark, run.tables)) == {**closed, **old}


def by_batches(batches, bound=5, width=60):
    """Closed counts, late ids per the watermark of earlier batches, by a loop."""
    seen, open_counts, late = None, {}, set()
    for rows in batches:
        mark = None if seen is None else seen - bound
        for r in rows:
            ts = offset(r["event_ts"].replace(tzinfo=None))
            start = ts // width * width
            if mark is not None and start + width <= mark:
                late.add(r["event_id"])
                continue
            key = (start, r["campaign_id"] or "organic", r["geo"], r["device"])
            open_counts[key] = open_counts.get(key, 0) + 1
        newest = max(offset(r["event_ts"].replace(tzinfo=None)) for r in rows)
        seen = newest if seen is None else max(seen, newest)
    closed = {k: n for k, n in open_counts.items() if k[0] + width <= seen - bound}
    return closed, late


def arrivals(spark, take):
    """Rows of the clickstream in arrival order, as event dictionaries."""
    rows = (
        clickstream(spark, SF_SMALL)
        .orderBy(*CLICKSTREAM_POLICY.arrival)
        .limit(take)
        .select(*EVENT_COLUMNS)
        .collect()
    )
    return [
        {n: at(offset(v)) if n.endswith("_ts") else v for n, v in r.asDict().items()} for r in rows
    ]


def test_job_native_and_loop_agree(spark, run):
    """Both streaming forms on delayed events, against the rule applied batch by batch."""
    rng = random.Random(6)
    rows = [
        event(
            f"{i:03d}",
            max(0, i * 6 - (rng.randrange(10, 300) if rng.random() < 0.3 else 0)),
            i * 6,
            campaign_id=rng.choice([None, "camp_1", "camp_2"]),
        )
        for i in range(120)
    ]
    batches = [rows[i : i + 15] for i in range(0, len(rows), 15)]
    for batch in batches:
        run.add(batch)
    closed, late = by_batches(batches)
    assert late
    run.job()
    assert run.hot() == closed
    assert {r.event_id for r in reads.read_late(spark, run.tables).collect()} == late
    assert reads.read_cold(spark, run.tables).count() == len(rows)
    assert sum(p.rows for p in run.progress()) == len(rows)
    assert sum(p.late_rows for p in run.progress()) == len(late)
    session = native.stateful_session(spark)
    assert counted(run.native(native.stream_counts(run.stream(session)), "counts")) == closed


def test_clickstream_in_batches(spark, run):
    rows = arrivals(spark, 160)
    batches = [rows[i : i + 40] for i in range(0, len(rows), 40)]
    for batch in batches:
        run.add(batch)
    run.job()
    closed, late = by_batches(batches)
    assert run.hot() == closed
    assert {r.event_id for r in reads.read_late(spark, run.tables).collect()} == late


@pytest.mark.parametrize("place", ["write_hot", "_commit"])
def test_restart_after_a_failure(spark, run, monkeypatch, place):
    """A batch that fails half way is run again and leaves no second copy."""
    from tidewindow.streaming import job as module

    closed = late_scenario(run)
    owner = module if place == "write_hot" else StreamJob
    intact, calls = getattr(owner, place), []

    def fails_once(*args):
        calls.append(1)
        if len(calls) == 2:
            if place == "write_hot":
                intact(*args)
            raise RuntimeError("lost")
        return intact(*args)

    monkeypatch.setattr(owner, place, fails_once)
    with pytest.raises(Exception, match="lost"):
        run.job()
    run.job()
    assert run.hot() == closed
    assert reads.read_cold(spark, run.tables).count() == 205
    assert reads.read_late(spark, run.tables).count() == 5
    assert [p.batch_id for p in run.progress()] == [0, 1]


def test_repeated_batch_replaces_itself(spark, run, events_of):
    job = StreamJob(run.tables)
    run.tables.create(spark)
    first = [event(i, i * 20) for i in range(10)]
    second = [event(f"x{i}", 100 + i * 20) for i in range(10)] + [event("old", 0, 300)]
    for rows, batch_id in ((first, 0), (first, 0), (second, 1), (second, 1)):
        job.process(events_of(rows), batch_id)
    closed, late = by_batches([first, second])
    assert late == {"old", "x0"}
    assert run.hot() == closed
    assert reads.read_cold(spark, run.tables).count() == 21
    assert {r.event_id for r in reads.read_late(spark, run.tables).collect()} == late


def test_foreign_tables_are_refused(spark, run, events_of):
    run.tables.create(spark)
    with pytest.raises(RuntimeError, match="do not belong"):
        StreamJob(run.tables).process(events_of([event(1, 0)]), 4)


def test_new_checkpoint_on_old_tables_is_refused(spark, run, events_of):
    """Batch 0 of another stream would replace what is there, batch by batch."""
    closed = late_scenario(run)
    run.job()
    with pytest.raises(RuntimeError, match="do not belong"):
        StreamJob(run.tables).start(run.stream(), f"{run.folder}/other", availableNow=True)
    for batch_id in (0, 2):
        with pytest.raises(RuntimeError, match="do not belong"):
            StreamJob(run.tables).process(events_of([event("a", 0)]), batch_id)
    run.job()
    assert run.hot() == closed and reads.read_cold(spark, run.tables).count() == 205


def test_dropping_copies_does_not_depend_on_the_batch(spark, run):
    """A copy has the id and the event day; an event from long ago changes nothing."""
    day = 86_400
    run.add([event(1, 0), event(2, 2 * day)])
    run.add([event(1, 0, 5), event(2, 3 * day), event(3, -900 * day), event(3, -900 * day, 1)])
    run.job(StreamJob(run.tables, dedup=True))
    cold = reads.read_cold(spark, run.tables).select("event_id", "batch_id").collect()
    assert sorted(map(tuple, cold)) == [("1", 0), ("2", 0), ("2", 1), ("3", 1)]


def test_sinks_that_get_the_batch(spark, run):
    run.add([event(1, 0), event(2, 1, user_id=None)])
    cold, poison = [], []
    run.job(StreamJob(
        run.tables,
        cold_sinks=(lambda df, batch: cold.append((batch, df.count())),),
        poison_sinks=(lambda df, batch: poison.append((batch, df.count())),),
        catalog_table="job_history",
    ))
    try:
        assert cold == [(0, 1)] and poison == [(0, 1)]
        assert [r.event_id for r in spark.table("job_history").collect()] == ["1"]
    finally:
        spark.sql("DROP TABLE job_history")


def test_history_of_two_runs(spark, run):
    """Batches and restarts of all runs are known from the stored tables."""
    run.add([event(1, 0)])
    run.job()
    run.add([event(2, 100)])
    run.job()
    figures = health.batch_figures(reads.read_progress(spark, run.tables)).orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows, r.restarts) for r in figures] == [(0, 1, 1), (1, 1, 1)]
    for _ in range(60):
        reports = reads.read_reports(spark, run.tables)
        if reports.count() == 2:
            break
        time.sleep(0.5)
    rows = health.batch_health(health.progress_table(reports), reads.read_progress(spark, run.tables))
    assert sorted((r.batch_id, r.input_rows, r.restarts) for r in rows.collect()) == [(0, 1, 1), (1, 1, 1)]


def test_stream_without_a_required_column_is_refused(spark, run):
    run.add([event(1, 0)])
    with pytest.raises(ValueError, match="session_id"):
        StreamJob(run.tables).start(run.stream().drop("session_id"), f"{run.folder}/checkpoint")


def test_poison_goes_its_own_way(spark, run):
    run.add([
        event(1, 0),
        event(2, 1, user_id=None),
        event(3, 2, geo=None, campaign_id=None, device=None),
        event(4, None, 3),
    ])
    run.job()
    poison = reads.read_poison(spark, run.tables).collect()
    assert sorted(r.reason for r in poison) == ["null_event_ts", "null_user_id"]
    assert all(b'"event_id":' in r.raw for r in poison)
    cold = {r.event_id: r for r in reads.read_cold(spark, run.tables).collect()}
    assert set(cold) == {"1", "3"}
    assert (cold["3"].geo, cold["3"].device, cold["3"].campaign_id) == ("unknown", "unknown", None)
    assert [(p.rows, p.poison_rows) for p in run.progress()] == [(2, 2)]


@pytest.mark.parametrize("name, values", [
    ("value", [1.5, None, 2.0]),
    ("value", ["domain", "domain", None]),
    ("reason", ["refund", None, "gift"]),
])
def test_columns_named_like_parts_of_a_message(spark, run, name, values):
    """A business column ``value`` or ``reason`` is neither the message nor its error."""
    kind = "double" if isinstance(values[0], float) else "string"
    rows = [event(1, 0), event(2, 1, user_id=None), event(3, 2)]
    stated = T.StructType([*EVENT_SCHEMA.fields]).add(name, kind)
    data = [tuple(r[n] for n in EVENT_COLUMNS) + (v,) for r, v in zip(rows, values)]
    spark.createDataFrame(data, stated).coalesce(1).write.mode("overwrite").parquet(run.input)
    stream = file_stream(spark, run.input, stated)
    StreamJob(run.tables).start(stream, f"{run.folder}/checkpoint", availableNow=True).awaitTermination(300)
    poison = reads.read_poison(spark, run.tables).collect()
    assert [r.reason for r in poison] == ["null_user_id"]
    assert b'"event_id":"2"' in bytes(poison[0].raw)
    assert {r.event_id for r in reads.read_cold(spark, run.tables).collect()} == {"1", "3"}


def test_decoded_column_of_another_kind_is_refused(spark, run):
    run.add([event(1, 0)])
    from pyspark.sql import functions as F

    stream = run.stream().withColumn(DECODED, F.lit("x"))
    with pytest.raises(ValueError, match=DECODED):
        StreamJob(run.tables).start(stream, f"{run.folder}/checkpoint")


def test_batch_of_poison_keeps_the_watermark(spark, run):
    run.add([event(1, 200)])
    run.add([event(2, 900, event_type=None)])
    run.add([event(3, 0), event(4, 400)])
    run.job()
    assert [offset(p.max_event_ts) for p in run.progress()] == [200, 200, 400]
    assert [r.event_id for r in reads.read_late(spark, run.tables).collect()] == ["3"]


@pytest.mark.parametrize("dedup, expected", [(False, 5), (True, 3)])
def test_copies_count_twice_unless_dropped(spark, run, dedup, expected):
    run.add([event(1, 0), event(1, 0, arrives=1), event(2, 1)])
    run.add([event(2, 1, arrives=2), event(3, 30), event(9, 200)])
    run.job(StreamJob(run.tables, dedup=dedup))
    assert run.hot() == {(0, "camp_1", "US", "mobile"): expected}
    assert reads.read_cold(spark, run.tables).count() == expected + 1


def test_poison_is_kept_as_bytes_and_read_again(spark, run):
    """Messages that a decoder could not read yet go through a better one later."""
    from pyspark.sql import functions as F

    from tidewindow.operators.quality import json_value, parse_json_events

    raw = bytes([0, 0, 0, 0, 9, 255])
    events = run.stream().select(
        json_value(EVENT_COLUMNS).alias("text")
    ).withColumn("value", F.concat(F.lit(raw), F.col("text").cast("binary")))
    run.add([event(1, 0), event(2, 200)])
    decoded = parse_json_events(events.select("value"))
    StreamJob(run.tables).start(decoded, f"{run.folder}/checkpoint", availableNow=True).awaitTermination(300)
    stored = reads.read_poison(spark, run.tables).collect()
    assert len(stored) == 2 and all(bytes(r.raw).startswith(raw) for r in stored)

    def better(messages):
        return parse_json_events(messages.withColumn("value", F.expr("substring(value, 7)")))

    good, left = reread_poison(spark, run.tables, better)
    assert sorted(r.event_id for r in good.collect()) == ["1", "2"] and left.isEmpty()
    replay_late_table(spark, run.tables, 1, good)
    assert sum(counted(served_metrics(spark, run.tables)).values()) == 2


def test_as_of_and_rebuild(spark, run):
    from tidewindow.operators import repair

    late_scenario(run)
    run.job()
    cold = reads.read_cold(spark, run.tables)
    assert repair.as_of(cold, 0).count() == 200
    rebuilt = counted(repair.rebuild_from_cold(cold))
    assert sum(rebuilt.values()) == 205
    assert rebuilt[(-300, "camp_verify_dropped", "US", "mobile")] == 5
    first_day = repair.rebuild_from_cold(cold, "2024-01-01", "2024-01-01")
    assert sum(counted(first_day).values()) == 200


def test_sinks_beside_the_tables(spark, run):
    closed = late_scenario(run)
    hot, late = [], []
    job = StreamJob(
        run.tables,
        hot_sinks=(lambda df: hot.extend(df.collect()),),
        late_sinks=(lambda df: late.extend(df.collect()),),
    )
    run.job(job)
    assert {offset(r.window_start): r.event_count for r in hot} == {k[0]: n for k, n in closed.items()}
    assert len(late) == 5


def test_command_line(spark, run):
    closed = late_scenario(run)
    args = main.arguments([
        "--files", run.input, "--files-per-trigger", "1", "--available-now",
        "--tables", run.tables.root, "--checkpoint", f"{run.folder}/checkpoint",
    ])
    main.start(spark, args).awaitTermination(300)
    assert run.hot() == closed
    topic = ["--tables", "t", "--checkpoint", "c", "--servers", "b:1", "--writer-schema", "1=x.avsc"]
    assert main.arguments(topic).topic == "events.raw.v1"
    with pytest.raises(SystemExit):
        main.arguments(["--tables", "t", "--checkpoint", "c"])


def test_native_sessions(spark, run):
    run.add([event(1, 0), event(2, 1800), event(3, 3600.001), event(4, 20_000)])
    session = native.stateful_session(spark)
    found = run.native(native.stream_sessions(run.stream(session)), "sessions").collect()
    assert sorted((offset(r.session_start), offset(r.session_end), r.events) for r in found) == [
        (0, 1800, 2),
        (3600.001, 3600.001, 1),
    ]


def test_health_of_a_run(spark, run):
    late_scenario(run)
    query = run.job()
    progress = health.progress_table(health.report_rows(spark, query.recentProgress))
    rows = health.batch_health(progress, reads.read_progress(spark, run.tables)).collect()
    assert sorted((r.batch_id, r.input_rows, r.late_rows) for r in rows) == [(0, 200, 0), (1, 5, 5)]
    assert all(r.restarts == 0 and not r.lag_alert for r in rows)


def test_health_alerts(spark):
    def record(batch, run_id, busy_ms, behind):
        return (
            f'{{"id": "q", "runId": "{run_id}", "batchId": {batch}, "numInputRows": 10, '
            f'"durationMs": {{"triggerExecution": {busy_ms}, "walCommit": 3}}, "sources": '
            f'[{{"description": "t", "metrics": {{"maxOffsetsBehindLatest": "{behind}"}}}}]}}'
        )

    class Report:
        def __init__(self, text):
            self.json = text

    reports = [Report(record(0, "a", 6_000, 10_000)), Report(record(1, "a", 30_000, 10_001)), Report(record(2, "b", 48_000, 0))]
    written = spark.createDataFrame(
        [(0, 8, 0, 2), (1, 10, 0, 0), (2, 0, 0, 0)],
        "batch_id long, rows long, late_rows long, poison_rows long",
    )
    rows = health.batch_health(health.progress_table(health.report_rows(spark, reports)), written).orderBy("batch_id").collect()
    assert [r.backpressure for r in rows] == ["ok", "warn", "high"]
    assert [r.lag_alert for r in rows] == [False, True, False]
    assert [r.error_rate for r in rows] == [0.2, 0.0, None]
    assert {r.restarts for r in rows} == {1}


def test_counts_of_history_and_job_agree(spark, run):
    """Closed windows of the job are the batch counts of what was not late."""
    rows = arrivals(spark, 60)
    for i in range(0, len(rows), 20):
        run.add(rows[i : i + 20])
    run.job()
    late = reads.read_late(spark, run.tables).select("event_id")
    kept = reads.read_cold(spark, run.tables).join(late, "event_id", "left_anti")
    batch = counted(metrics.windowed_counts(kept))
    assert run.hot().items() <= batch.items()


def test_few_counts_make_one_file_and_listeners_end(spark, run):
    def listeners():
        return len(spark._jsparkSession.streams().listListeners())

    before = listeners()
    run.add([event(n, 60, campaign_id=f"camp_{n}") for n in range(40)])
    run.job()
    written = os.listdir(run.tables.open_windows(0))
    assert len([name for name in written if name.endswith(".parquet")]) == 1
    assert spark.read.parquet(run.tables.open_windows(0)).count() == 40
    until = time.time() + 30
    while listeners() > before and time.time() < until:
        time.sleep(0.1)
    assert listeners() <= before


def test_weeks_are_sent_once(spark, tmp_path):
    """All weeks are written in one go, and a run finds its own week only."""
    tables = stream_weeks(spark, SF_SMALL, str(tmp_path))
    assert os.listdir(tmp_path / "in") == []
    weeks = {name for name in os.listdir(tmp_path / "done") if name.startswith("week=")}
    assert len(weeks) == reads.read_progress(spark, tables).count() > 3
    sent = spark.read.parquet(f"{tmp_path}/done")
    assert sent.count() == clickstream(spark, SF_SMALL).count()
