"""Digests, the replay ledger, the newest windows of the stored table, and alert episodes."""

import json
import random

import pytest
from conftest import at, event, offset
from pyspark.sql import functions as F
from test_stream import counted

from tidewindow.contract import EVENT_COLUMNS
from tidewindow.operators import health, repair
from tidewindow.operators.quality import json_value
from tidewindow.sinks.tables import Tables, write_cold, write_hot
from tidewindow.sources import tables as reads
from tidewindow.sources.topics import starting_offsets
from tidewindow.streaming import digests, replay
from tidewindow.streaming.job import StreamJob


@pytest.fixture
def written(spark, tmp_path, events_of):
    """Three batches with late rows, open windows at the end."""
    tables = Tables(f"{tmp_path}/tables")
    tables.create(spark)
    job, rng = StreamJob(tables), random.Random(3)
    for batch in range(3):
        rows = [
            event(f"{batch}-{i}", batch * 3600 + i * 20 - (400 if rng.random() < 0.2 else 0), batch * 3600 + i * 20,
                  campaign_id=rng.choice([None, "a", "b"]))
            for i in range(80)
        ]
        job.process(events_of([*rows, event(f"old-{batch}", 0)]), batch)
    return tables, job


def full_pass(spark, tables, last):
    hot = reads.read_hot(spark, tables).drop("batch_id", "window_date").unionByName(
        spark.read.parquet(tables.open_windows(last))
    )
    found = repair.reconcile(hot, reads.read_cold(spark, tables), reads.read_late(spark, tables))
    return sorted(map(tuple, found.where("unexplained <> 0").collect()))


def test_digests_of_sound_tables_are_all_that_is_read(spark, written, monkeypatch):
    tables, _ = written
    assert reads.read_late(spark, tables).count() > 0
    digests.update_digests(spark, tables)

    def read(*args):
        raise AssertionError("a table was read")

    for name in ("read_hot", "read_cold", "read_late", "reconcile"):
        monkeypatch.setattr(digests, name, read)
    assert digests.differing_minutes(spark, tables) is None


def test_changed_rows_are_found(spark, written, events_of):
    tables, job = written
    digests.update_digests(spark, tables)
    assert digests.reconcile_changed(spark, tables).count() == 0
    # a batch whose served counts doubled, and one that lost part of its history
    hot = reads.read_hot(spark, tables).where("batch_id = 1").drop("batch_id", "window_date")
    kept = [r for r in hot.collect()]
    doubled = spark.createDataFrame(kept, hot.schema).withColumn(
        "event_count", F.col("event_count") + F.when(F.col("campaign_id") == "a", 1).otherwise(0)
    )
    write_hot(doubled, tables.hot, 1)
    lost = [r for r in reads.read_cold(spark, tables).where("batch_id = 2").collect() if r.event_id != "2-7"]
    write_cold(spark.createDataFrame(lost, reads.read_cold(spark, tables).schema), tables.cold, 2)
    digests.update_digests(spark, tables, again=[1, 2])
    found = sorted(map(tuple, digests.reconcile_changed(spark, tables).collect()))
    assert found == full_pass(spark, tables, 2) and {r[-1] for r in found} == {-1}
    job.process(events_of([event("later", 9 * 3600)]), 3)
    assert sorted(map(tuple, digests.reconcile_changed(spark, tables).collect())) == full_pass(spark, tables, 3)


def test_no_batches_no_differences(spark, tmp_path):
    tables = Tables(f"{tmp_path}/none")
    tables.create(spark)
    assert digests.reconcile_changed(spark, tables).count() == 0


def messages(events_of, rows, partitions=2):
    sent = events_of(rows).select(json_value(EVENT_COLUMNS).alias("value"), F.col("event_id").cast("long").alias("n"))
    return sent.select(
        F.lit("late").alias("topic"), (F.col("n") % partitions).cast("int").alias("partition"),
        F.floor(F.col("n") / partitions).alias("offset"), "value",
    )


def test_a_topic_is_replayed_once(spark, tmp_path, events_of, monkeypatch):
    """Read twice, after a restart, after a replay that broke off, and after new messages."""
    tables = Tables(f"{tmp_path}/tables")
    tables.create(spark)
    first = [event(i, 10 + i) for i in range(7)]
    topic = messages(events_of, first)
    bad = topic.where("partition = 0 AND offset = 0").withColumns({"value": F.lit("{no"), "partition": F.lit(5)})
    assert replay.replay_topic(spark, tables, topic.unionByName(bad)) == 1
    once = counted(replay.served_metrics(spark, tables))
    assert sum(once.values()) == 7
    assert replay.replay_topic(spark, tables, topic.unionByName(bad)) == 2
    assert counted(replay.served_metrics(spark, tables)) == once
    replay.replay_late_table(spark, tables, 1)  # has ids of its own
    assert counted(replay.served_metrics(spark, tables)) == once
    assert replay.read_up_to(spark, tables) == {"late": {0: 4, 1: 3, 5: 1}}
    more = messages(events_of, [*first, *(event(i, 10 + i) for i in range(7, 12))])
    with monkeypatch.context() as broken:
        broken.setattr(replay, "split_poison", lambda rows: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            replay.replay_topic(spark, tables, more)
    replay.replay_topic(spark, tables, more)
    replay.replay_topic(spark, tables, more.unionByName(more))
    assert sum(counted(replay.served_metrics(spark, tables)).values()) == 12
    assert json.loads(starting_offsets(replay.read_up_to(spark, tables)["late"], 3)) == {"0": 6, "1": 6, "2": -2}


def test_newest_windows_open_few_folders(spark, tmp_path, events_of):
    tables = Tables(f"{tmp_path}/tables")
    tables.create(spark)
    job = StreamJob(tables)
    for batch in range(6):
        job.process(events_of([event(f"{batch}-{i}", batch * 600 + i * 60) for i in range(4)]), batch)
    everything = reads.read_hot(spark, tables)
    for n in (1, 5, 9, 100):
        newest = reads.read_latest_windows(spark, tables, n, folders=1)
        want = everything.orderBy(F.col("window_start").desc(), "campaign_id", "geo", "device").limit(n)
        assert [tuple(r) for r in newest.collect()] == [tuple(r) for r in want.collect()]
    opened = reads.read_latest_windows(spark, tables, 4, folders=1)
    batches = {f.split("batch_id=")[1].split("/")[0] for f in opened.inputFiles()}
    plan = opened._jdf.queryExecution().optimizedPlan().toString()
    assert "batch_id" in plan and opened.count() == 4 and batches


def test_episodes(spark):
    """Across midnight, over missing minutes, broken by a sample, still open at the end."""
    rows = [(m, v, v > 5) for m, v in (
        (0, 9), (1, 8), (2, 1), (3, 7), (20, 7), (1438, 6), (1439, 7), (1440, 9), (1441, 6), (1442, 0),
        (1450, 6), (1453, 6), (2 * 1440, 8), (2 * 1440 + 1, 9),
    )] + [(2 * 1440 + 2, 7, None), (4 * 1440, 10, True)]
    samples = spark.createDataFrame([(at(m * 60), float(v), a) for m, v, a in rows], "t timestamp, v double, alert boolean")
    def found(**options):
        out = health.episodes(samples, "t", "v", **options).orderBy("started").collect()
        return [(offset(r.started) / 60, offset(r.ended) / 60, r.samples, r.peak, r.is_open) for r in out]

    assert found() == [
        (0, 1, 2, 9, False), (3, 3, 1, 7, False), (20, 20, 1, 7, False), (1438, 1441, 4, 9, False),
        (1450, 1453, 2, 6, False), (2880, 2881, 2, 9, False), (5760, 5760, 1, 10, True),
    ]
    assert found(hold_seconds=180) == [(1438, 1441, 4, 9, False), (1450, 1453, 2, 6, False)]
    assert [e[:2] for e in found(gap_seconds=120)][4:6] == [(1450, 1450), (1453, 1453)]
    assert health.episodes(samples.limit(0), "t", "v").count() == 0
