"""Compaction of the history: what readers see before, during and after."""

import datetime as dt

import pytest
from conftest import event

from tidewindow.operators.repair import as_of, day_range
from tidewindow.sinks import compaction
from tidewindow.sinks.tables import Tables, folders_in
from tidewindow.sources.tables import read_cold, read_cold_days
from tidewindow.streaming.job import StreamJob

DAY = 86_400
FIRST = dt.date(2024, 1, 1)


@pytest.fixture
def history(spark, tmp_path, events_of):
    """Six batches of two days each, late events of the first day in all of them."""
    tables = Tables(f"{tmp_path}/tables")
    tables.create(spark)
    job = StreamJob(tables)
    for batch in range(6):
        rows = [event(f"{batch}-{i}", batch * DAY // 2 + i * 3_000, campaign_id=f"camp_{i % 3}") for i in range(20)]
        job.process(events_of([*rows, event(f"late-{batch}", 5)]), batch)
    return tables, job


def state(spark, tables):
    """Everything that readers ask of the history."""
    cold = read_cold(spark, tables)
    days = [read_cold_days(spark, tables, FIRST + dt.timedelta(d), FIRST + dt.timedelta(d)) for d in range(4)]
    asked = [cold, *(as_of(cold, b) for b in (0, 2, 4)), *days]
    return [sorted(map(tuple, df.select(sorted(cold.columns)).collect()), key=repr) for df in asked]


def test_readers_see_the_same(spark, history, events_of, monkeypatch):
    tables, job = history
    before = state(spark, tables)
    assert len(before[0]) == 126

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(compaction, "publish", lost)
        with pytest.raises(RuntimeError, match="lost"):
            compaction.compact(spark, tables, FIRST)
    assert state(spark, tables) == before and compaction.generations(spark, tables) == []
    assert compaction.compact(spark, tables, FIRST) == (1, FIRST, 5)
    assert state(spark, tables) == before
    assert compaction.vacuum(spark, tables) == 0  # readers may still use the batch folders
    earlier = read_cold(spark, tables)
    second = compaction.compact(spark, tables)
    assert second.generation == 2 and second.last_day > FIRST
    assert state(spark, tables) == before
    folders = len([d for b in folders_in(spark, tables.cold) for d in folders_in(spark, f"{tables.cold}/{b}")])
    assert compaction.vacuum(spark, tables) == 6  # the first day, of each batch
    assert state(spark, tables) == before and earlier.count() == len(before[0])
    left = len([d for b in folders_in(spark, tables.cold) for d in folders_in(spark, f"{tables.cold}/{b}")])
    assert left == folders - 6
    assert compaction.compact(spark, tables) is None
    job.process(events_of([event("new", 3 * DAY + 100), event("late-6", 7)]), 6)
    assert read_cold(spark, tables).count() == len(before[0]) + 2
    compaction.compact(spark, tables)
    compaction.vacuum(spark, tables, keep=0)
    after = read_cold(spark, tables)
    assert after.count() == len(before[0]) + 2 and as_of(after, 5).count() == len(before[0])
    ids = [r.event_id for r in read_cold_days(spark, tables, FIRST, FIRST).collect()]
    assert len(ids) == len(set(ids)) and {f"late-{i}" for i in range(7)} <= set(ids)


def test_packed_days_are_one_folder(spark, history):
    tables, _ = history
    compaction.compact(spark, tables)
    compaction.vacuum(spark, tables, keep=0)
    files = day_range(read_cold(spark, tables, files=True), FIRST, FIRST).select("file_path").distinct().collect()
    assert len(files) == 1 and "event_date=2024-01-01" in files[0].file_path


def test_nothing_to_pack(spark, tmp_path, events_of):
    tables = Tables(f"{tmp_path}/tables")
    tables.create(spark)
    assert compaction.compact(spark, tables) is None and compaction.vacuum(spark, tables, 0) == 0
    StreamJob(tables).process(events_of([event(1, 0)]), 0)
    done = compaction.compact(spark, tables)
    assert done.last_day < FIRST and read_cold(spark, tables).count() == 1


def test_copies_of_packed_events_are_known(spark, tmp_path, events_of):
    tables = Tables(f"{tmp_path}/tables")
    tables.create(spark)
    job = StreamJob(tables, dedup=True)
    job.process(events_of([event(1, 0), event(2, 2 * DAY)]), 0)
    compaction.compact(spark, tables)
    compaction.vacuum(spark, tables, keep=0)
    job.process(events_of([event(1, 0, 9), event(2, 2 * DAY, 2 * DAY + 9), event(3, 0)]), 1)
    assert sorted(r.event_id for r in read_cold(spark, tables).collect()) == ["1", "2", "3"]
