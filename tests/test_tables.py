"""File tables, connectors, and the shape of plans."""

import glob
import re

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL, event, offset
from pyspark.sql import functions as F

from tidewindow.contract import COLD_COLUMNS, EVENT_COLUMNS
from tidewindow.functions import dims
from tidewindow.operators import health, lateness, metrics, repair, serving
from tidewindow.plans.catalog import QUERIES
from tidewindow.sinks import external
from tidewindow.sinks.tables import (
    Tables,
    create_cold_table,
    register_batch,
    write_cold,
    write_hot,
)
from tidewindow.sources import tables as reads
from tidewindow.sources import topics
from tidewindow.sources.clickstream import CLICKSTREAM_POLICY, clickstream


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    tables = Tables(str(tmp_path_factory.mktemp("stored")))
    events = clickstream(spark, SF_SMALL).orderBy(F.hash("event_id"))
    write_cold(events, tables.cold, 3)
    write_hot(metrics.windowed_counts(events), tables.hot, 3)
    return tables


def test_cold_table_holds_every_event(spark, stored):
    cold = reads.read_cold(spark, stored)
    expected = dims.cold_projection(clickstream(spark, SF_SMALL))
    assert cold.columns == [*COLD_COLUMNS, "batch_id", "event_date"]
    assert sorted(cold.select(*COLD_COLUMNS).collect(), key=repr) == sorted(
        expected.collect(), key=repr
    )


def test_files_are_sorted_by_time(stored):
    files = glob.glob(f"{stored.cold}/batch_id=3/event_date=*/*.parquet")
    assert len(files) == 30
    for file in files:
        times = pq.ParquetFile(file).read(columns=["event_ts"]).column(0).to_pylist()
        assert times == sorted(times)


def test_day_scan_prunes(spark, stored):
    days = reads.read_cold_days(spark, stored, "2024-01-10", "2024-01-11")
    text = plan(days.select("event_id"))
    pruned = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "event_date" in pruned and "2024-01-10" in pruned
    assert "GreaterThanOrEqual(event_ts" in text
    assert re.search(r"ReadSchema: struct<event_id:string,event_ts:timestamp>", text)
    files = days.select(F.col("_metadata.file_path")).distinct().collect()
    assert len(files) == 2


def test_campaign_filter_reaches_the_hot_files(spark, stored):
    text = plan(serving.for_campaign(reads.read_hot(spark, stored), "camp_verify_dropped"))
    assert "EqualTo(campaign_id,camp_verify_dropped)" in text
    assert serving.for_campaign(reads.read_hot(spark, stored), "camp_verify_dropped").count() == 0


def test_hot_table_read_with_sql(spark, stored):
    serving.metrics_view(reads.read_hot(spark, stored).drop("window_date", "batch_id"))
    rows = spark.sql(
        "SELECT * FROM metrics_1m ORDER BY window_start DESC, campaign_id, geo, device LIMIT 5"
    )
    assert "TakeOrderedAndProject" in plan(rows)
    assert rows.collect() == serving.latest_windows(spark.table("metrics_1m")).collect()


def test_rewritten_batch_replaces_its_rows(spark, tmp_path, events_of):
    path = str(tmp_path / "cold")
    for _ in range(2):
        write_cold(events_of([event(1, 0), event(2, 90_000)]), path, 0)
    write_cold(events_of([event(3, 0)]), path, 1)
    rows = spark.read.parquet(path).collect()
    assert sorted((r.event_id, r.batch_id) for r in rows) == [("1", 0), ("2", 0), ("3", 1)]
    # an attempt that writes fewer days leaves none of the earlier ones
    write_cold(events_of([event(1, 0)]), path, 0)
    rows = spark.read.parquet(path).collect()
    assert sorted((r.event_id, r.batch_id) for r in rows) == [("1", 0), ("3", 1)]


def test_catalog_table_is_created_once(spark, stored):
    for _ in range(2):
        create_cold_table(spark, "cold_history", stored.cold)
    try:
        assert spark.table("cold_history").where("event_date = '2024-01-10'").count() == (
            clickstream(spark, SF_SMALL, ("2024-01-10", "2024-01-10")).count()
        )
    finally:
        spark.sql("DROP TABLE cold_history")


def test_catalog_table_follows_batches(spark, tmp_path, events_of):
    path = str(tmp_path / "cold")
    write_cold(events_of([event(1, 0), event(2, 90_000)]), path, 0)
    create_cold_table(spark, "cold_batches", path)
    try:
        for rows, batch in (([event(3, 0)], 1), ([event(1, 0)], 0)):
            write_cold(events_of(rows), path, batch)
            register_batch(spark, "cold_batches", path, batch)
        found = spark.table("cold_batches").select("event_id", "batch_id").collect()
        assert sorted(map(tuple, found)) == [("1", 0), ("3", 1)]
    finally:
        spark.sql("DROP TABLE cold_batches")


def test_file_growth(spark, stored):
    stats = {r.event_date: (r.data_files, r.rows) for r in health.file_stats(reads.read_cold(spark, stored)).collect()}
    assert len(stats) == 30 and {files for files, _ in stats.values()} == {1}
    assert sum(rows for _, rows in stats.values()) == 1000


def test_published_messages_keep_user_order(spark, tmp_path):
    path = str(tmp_path / "messages")
    external.publish_keyed(clickstream(spark, SF_SMALL), EVENT_COLUMNS).write.parquet(path)
    seen = []
    for file in sorted(glob.glob(f"{path}/part-*.parquet")):
        table = pq.ParquetFile(file).read()
        for key, value in zip(table.column("key").to_pylist(), table.column("value").to_pylist()):
            seen.append((key, int(re.search(r'"event_ts":(\d+)', value).group(1))))
    assert len(seen) == 1000 and seen == sorted(seen)


def test_scan_reads_only_needed_columns(spark):
    text = plan(metrics.windowed_counts(clickstream(spark, SF_SMALL)))
    read = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"ts", "user_id", "props"}
    days = plan(clickstream(spark, SF_SMALL, ("2024-01-02", "2024-01-03")).select("event_id"))
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in days


def test_counts_shuffle_once(spark):
    events = clickstream(spark, SF_SMALL)
    assert plan(metrics.windowed_counts(events)).count("Exchange hashpartitioning") == 1
    counted = metrics.windowed_counts(events)
    assert plan(repair.reconcile(counted, events, events)).count("Join") == 0


ONE_ROW_PER_TASK_OR_DAY = (
    "contract_violations", "watermark_lag_1m", "late_events", "watermark_trace",
    "late_rate_episodes", "watermark_lag_episodes",
)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_event_goes_to_a_single_task(spark, name):
    """Global steps see only per-day, per-slice or top-k rows, and nothing is crossed."""
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text
    for line in text.splitlines():
        if "Exchange SinglePartition" in line:
            assert name in ONE_ROW_PER_TASK_OR_DAY, line


def test_late_flag_needs_no_shuffle_of_events(spark):
    """Tagging joins a broadcast table: the events stay where they were read."""
    tagged = lateness.tag_late(clickstream(spark, SF_SMALL), CLICKSTREAM_POLICY)
    text = plan(tagged.select("event_id", "is_late"))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text and "Sort " not in text


def test_closers_fold_before_any_sort(spark):
    """Below the first exchange of each step events are neither sorted nor folded by sort."""
    events = clickstream(spark, SF_SMALL)
    rows = events.select("ingest_ts", "arrival_seq", "event_ts")
    first = lateness.first_arrivals(events, CLICKSTREAM_POLICY)
    text = plan(first)
    assert "BroadcastHashJoin" in text  # only rows with the smallest arrival are compared whole
    joined = text[text.index("BroadcastHashJoin"):]
    assert "Sort" not in joined
    text = plan(rows.groupBy("event_ts").agg(F.min("ingest_ts"), F.max("ingest_ts"), F.count("*")))
    assert "HashAggregate" in text and "Sort" not in text


def test_dedup_folds_by_hash(spark):
    from tidewindow.operators import quality

    text = plan(quality.dedup_events(clickstream(spark, SF_SMALL)))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_topic_options():
    read = topics.kafka_options("b1:9092", topics.RAW_TOPIC, 500)
    assert read["subscribe"] == "events.raw.v1" and read["startingOffsets"] == "earliest"
    assert read["maxOffsetsPerTrigger"] == "500"
    assert "maxOffsetsPerTrigger" not in topics.kafka_options("b1:9092", topics.RAW_TOPIC)
    write = external.kafka_sink_options("b1:9092", topics.LATE_TOPIC)
    assert (write["topic"], write["kafka.acks"]) == ("events.late.v1", "all")
    jdbc = external.jdbc_sink_options("jdbc:x", "metrics_1m", user="u")
    assert (jdbc["batchsize"], jdbc["dbtable"], jdbc["user"]) == ("100", "metrics_1m", "u")


def test_keyed_messages(events_of):
    row = external.keyed_messages(events_of([event(1, 0.5, campaign_id=None)]), EVENT_COLUMNS).first()
    assert row.key == "user_1" and offset(row.event_ts) == 0.5
    assert '"campaign_id":null' in row.value and '"event_ts":1704067200500' in row.value
