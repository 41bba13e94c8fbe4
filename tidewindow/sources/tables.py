"""Reads of the tables the streaming job writes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewindow.contract import (
    LATE_SCHEMA,
    METRIC_SCHEMA,
    POISON_SCHEMA,
    PROGRESS_SCHEMA,
    REPORT_SCHEMA,
)
from tidewindow.operators.repair import day_range
from tidewindow.operators.serving import latest_windows
from tidewindow.sinks.compaction import read_live
from tidewindow.sinks.tables import HOT_SCHEMA, REPLAYED_SCHEMA, Tables, folders_in, path_exists


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_cold(spark: SparkSession, tables: Tables, files: bool = False) -> DataFrame:
    """The whole history, packed or not; with ``files`` also the ``file_path`` of each row."""
    return read_live(spark, tables, files)


def read_cold_days(
    spark: SparkSession, tables: Tables, first: dt.date | str, last: dt.date | str
) -> DataFrame:
    """History of a range of days; other days are not listed for reading."""
    return day_range(read_cold(spark, tables), first, last)


def read_hot(spark: SparkSession, tables: Tables) -> DataFrame:
    """Closed windows, one row per key, with the batch that closed them."""
    return _read(spark, tables.hot, HOT_SCHEMA)


def read_latest_windows(
    spark: SparkSession, tables: Tables, n: int = 5, folders: int = 8
) -> DataFrame:
    """The ``n`` newest closed windows, from the newest batch folders alone.

    A batch closes windows that end after the watermark of the batch before it, so no window of
    an older folder is newer than one of a later folder.  Folders are read from the newest one
    on, ``folders`` at a time, until they hold ``n`` rows.
    """
    numbers = sorted(
        (int(f.removeprefix("batch_id=")) for f in folders_in(spark, tables.hot) if f.startswith("batch_id=")),
        reverse=True,
    )
    some = spark.createDataFrame([], HOT_SCHEMA)
    newest = spark.read.schema(HOT_SCHEMA).option("basePath", tables.hot)
    for upto in range(folders, len(numbers) + folders, folders):
        # other folders are not listed
        some = newest.parquet(*[f"{tables.hot}/batch_id={number}" for number in numbers[:upto]])
        if some.limit(n).count() == n:
            break
    return latest_windows(some, n)


def read_late(spark: SparkSession, tables: Tables) -> DataFrame:
    return _read(spark, tables.late, LATE_SCHEMA)


def read_poison(spark: SparkSession, tables: Tables) -> DataFrame:
    return _read(spark, tables.poison, POISON_SCHEMA)


def read_progress(spark: SparkSession, tables: Tables) -> DataFrame:
    return _read(spark, tables.progress, PROGRESS_SCHEMA)


def read_reports(spark: SparkSession, tables: Tables) -> DataFrame:
    """Progress reports of all runs, as JSON."""
    return _read(spark, tables.reports, REPORT_SCHEMA)


def read_replayed(spark: SparkSession, tables: Tables) -> DataFrame:
    """Events that were applied by replays, of the late table or of topics."""
    replayed = _read(spark, tables.replayed, REPLAYED_SCHEMA)
    if not path_exists(spark, tables.topic_replays):
        return replayed
    return replayed.unionByName(_read(spark, tables.topic_replays, REPLAYED_SCHEMA))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str = "window_start",
    bounds: tuple[str, str] | None = None,
    partitions: int = 32,
    **options: str,
) -> DataFrame:
    """Metrics served by a database, read in ``partitions`` parallel ranges of time."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if bounds:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=partitions,
        )
    return reader.load().select(*METRIC_SCHEMA.names)
