"""The index of seen ids, and counts in two phases with their state."""

import random

import pytest
from conftest import event
from test_stream import Run, by_batches, counted, late_scenario

from tidewindow.sinks.tables import Tables
from tidewindow.sources import tables as reads
from tidewindow.streaming import native, seen
from tidewindow.streaming.job import StreamJob

DAY = 86_400


@pytest.fixture
def run(spark, tmp_path):
    return Run(spark, tmp_path)


def test_same_rows_as_a_plain_set(spark, run, events_of, monkeypatch):
    """Copies within and across batches, folds on the way, a batch that runs twice."""
    monkeypatch.setattr(seen, "FOLD_EVERY", 2)
    monkeypatch.setattr(seen, "BUCKET_IDS", 4)
    run.tables.create(spark)
    job, rng, met = StreamJob(run.tables, dedup=True), random.Random(2), set()
    for batch in range(6):
        rows = [
            event(f"e{rng.randrange(60)}", rng.randrange(2) * DAY + batch * 10 + i / 100, campaign_id="c")
            for i in range(25)
        ]
        if batch == 4:
            rows.append({**event("poison", 0), "user_id": None})
        for _ in range(2 if batch in (2, 3) else 1):
            job.process(events_of(rows), batch)
        met |= {(r["event_id"], r["event_ts"].date()) for r in rows if r["user_id"]}
    cold = reads.read_cold(spark, run.tables).selectExpr("event_id", "to_date(event_ts) AS d").collect()
    assert sorted(map(tuple, cold)) == sorted(met) and len(met) > 60
    listed = seen.SeenIds(spark, run.tables).listed()
    assert listed.version >= 2 and max(d.buckets for d in listed.days.values()) >= 8


def test_history_without_an_index(spark, run, events_of):
    """A job that begins to drop copies knows what was written before."""
    run.tables.create(spark)
    StreamJob(run.tables).process(events_of([event(1, 0), event(1, 1), event(2, 2)]), 0)
    StreamJob(run.tables, dedup=True).process(events_of([event(1, 3), event(3, 4)]), 1)
    StreamJob(run.tables).process(events_of([event(4, 5)]), 2)
    StreamJob(run.tables, dedup=True).process(events_of([event(4, 6), event(2, 7), event(5, 8)]), 3)
    ids = sorted(r.event_id for r in reads.read_cold(spark, run.tables).collect())
    assert ids == ["1", "1", "2", "3", "4", "5"]


def test_a_batch_opens_its_own_buckets(spark, tmp_path, monkeypatch):
    """What three ids read does not depend on how many ids their day has."""
    monkeypatch.setattr(seen, "FOLD_EVERY", 1)
    monkeypatch.setattr(seen, "BUCKET_IDS", 32)
    read = {}
    for size in (200, 3000):
        index = seen.SeenIds(spark, Tables(f"{tmp_path}/{size}"))
        ids = spark.range(size).selectExpr("concat('id-', id) AS event_id", "timestamp'2024-01-01 10:00:00' AS event_ts")
        index.add(ids, 0)
        assert index.fold(1)
        asked = spark.createDataFrame([("id-1",), ("id-199",), ("new",)], "event_id string").selectExpr(
            "event_id", "date'2024-01-01' AS event_date"
        )
        known = index.known(asked, 1)
        assert len(index.opened) <= 3
        read[size] = known.count()
        found = known.join(asked, ["event_id", "event_date"]).select("event_id").collect()
        assert sorted(r.event_id for r in found) == ["id-1", "id-199"]
    assert max(read.values()) <= 3 * 2 * 32


def test_a_fold_that_breaks_off_is_done_again(spark, run, events_of, monkeypatch):
    monkeypatch.setattr(seen, "FOLD_EVERY", 1)
    run.tables.create(spark)
    job = StreamJob(run.tables, dedup=True)
    job.process(events_of([event(1, 0)]), 0)
    keep = seen.SeenIds._remove
    monkeypatch.setattr(seen.SeenIds, "_remove", lambda self, paths: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        job.process(events_of([event(1, 1), event(2, 2)]), 1)
    monkeypatch.setattr(seen.SeenIds, "_remove", keep)
    job.process(events_of([event(1, 1), event(2, 2)]), 1)
    job.process(events_of([event(1, 3), event(2, 4), event(3, 5)]), 2)
    assert sorted(r.event_id for r in reads.read_cold(spark, run.tables).collect()) == ["1", "2", "3"]


# ---- two phases


def two_phase(run, salts):
    session = native.stateful_session(run.spark)
    query = native.start_two_phase_counts(
        run.stream(session), run.tables.hot, f"{run.folder}/two", salts, availableNow=True
    )
    query.awaitTermination(300)
    return run.hot()


def test_two_phases_on_the_late_scenario(spark, run):
    """Late rows of a batch are judged by the watermark that closes windows, as in one phase."""
    closed = late_scenario(run)
    assert two_phase(run, 8) == closed


def test_two_phases_batch_by_batch(spark, run):
    rng = random.Random(9)
    rows = [
        event(f"{i:03d}", max(0, i * 6 - (rng.randrange(10, 300) if rng.random() < 0.3 else 0)), i * 6,
              campaign_id=rng.choice([None, "camp_1"]))
        for i in range(90)
    ]
    batches = [rows[i : i + 15] for i in range(0, len(rows), 15)]
    for batch in batches:
        run.add(batch)
    closed, late = by_batches(batches)
    assert late and two_phase(run, 4) == closed


def test_state_of_a_hot_campaign_is_spread(spark, run):
    """One campaign in one window: its state lies in all state partitions, not in one."""
    run.add([event(i, i / 100, i) for i in range(4000)])
    assert two_phase(run, 256) == {}
    state = spark.read.format("statestore").load(f"{run.folder}/two")
    per = sorted(r["count"] for r in state.groupBy("partition_id").count().collect())
    assert sum(per) == 256 and len(per) == 8 and per[-1] <= 2 * 256 / 8
    parts = state.selectExpr("sum(value.count) AS n").first().n
    assert parts == 4000
