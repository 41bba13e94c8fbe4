"""Compaction of closed days of the history, behind a published list.

The job leaves one folder for each batch and day.  A compaction moves the rows of all days up to
``last_day``, of all batches up to ``up_to_batch``, into one folder for each day; both bounds only
ever grow, so the last one alone says which rows of the batch folders are packed already.  Rows keep
their batch id, so history as of a batch is what it was.

Writing goes in two steps, as batches do: the packed rows of a generation, then its row in the list.
Readers take the newest row of the list, the generations up to it, and what its bounds leave in
the batch folders.  A compaction that breaks off before the list is written has changed nothing
that is read, and is replaced by the next one.  Batch folders are removed by ``vacuum`` one
generation later, so a reader that opened the list before still finds what it saw.

Late events of a packed day come in later batches; they are read from there until the next
compaction packs them into a folder of their own generation.

Days without rows give no folders; without committed batches nothing is packed; only committed
batches are, so a batch that is run again is never a packed one.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewindow.contract import COLD_SCHEMA, PROGRESS_SCHEMA
from tidewindow.sinks.tables import ROWS_PER_FILE, Tables, folders_in, path_exists

LIST_SCHEMA = T.StructType([
    T.StructField("last_day", T.DateType()),
    T.StructField("up_to_batch", T.LongType()),
    T.StructField("generation", T.LongType()),
])
PACKED_SCHEMA = T.StructType([*COLD_SCHEMA.fields, T.StructField("generation", T.LongType())])


class Generation(NamedTuple):
    """A published compaction: days and batches up to these are packed."""

    generation: int
    last_day: dt.date
    up_to_batch: int


def generations(spark: SparkSession, tables: Tables) -> list[Generation]:
    """The published compactions, oldest first: one row for each run of ``compact``."""
    if not path_exists(spark, tables.cold_list):
        return []
    rows = spark.read.schema(LIST_SCHEMA).parquet(tables.cold_list).orderBy("generation").collect()
    return [Generation(r["generation"], r["last_day"], r["up_to_batch"]) for r in rows]


def _unpacked(spark: SparkSession, tables: Tables, last: Generation | None) -> DataFrame:
    """Rows that are in batch folders alone; both bounds prune folders."""
    raw = spark.read.schema(COLD_SCHEMA).parquet(tables.cold)
    if last is None:
        return raw
    packed = (F.col("event_date") <= F.lit(last.last_day)) & (F.col("batch_id") <= last.up_to_batch)
    return raw.where(~packed)


def read_live(spark: SparkSession, tables: Tables, files: bool = False) -> DataFrame:
    """The history: packed days, and the rows of batch folders that are not packed.

    ``files`` adds ``file_path``, which cannot be asked of the union itself.
    """
    place = [F.col("_metadata.file_path").alias("file_path")] if files else []
    published = generations(spark, tables)
    last = published[-1] if published else None
    rest = _unpacked(spark, tables, last).select("*", *place)
    if last is None:
        return rest
    packed = spark.read.schema(PACKED_SCHEMA).parquet(tables.packed).select("*", *place).where(
        F.col("generation") <= last.generation
    )
    return packed.drop("generation").unionByName(rest)


def _committed(spark: SparkSession, tables: Tables, bound_seconds: int) -> tuple[int, dt.date] | None:
    """The last committed batch, and the last day that its watermark has closed."""
    progress = spark.read.schema(PROGRESS_SCHEMA).parquet(tables.progress)
    row = progress.agg(
        F.max("batch_id").alias("batch"),
        F.date_sub(F.to_date(F.max("max_event_ts") - F.make_dt_interval(secs=F.lit(bound_seconds))), 1).alias("day"),
    ).first()
    return None if row["batch"] is None or row["day"] is None else (row["batch"], row["day"])


def compact(
    spark: SparkSession, tables: Tables, last_day: dt.date | None = None, bound_seconds: int = 5
) -> Generation | None:
    """Pack the closed days up to ``last_day``, by default all; None if that changes nothing."""
    committed = _committed(spark, tables, bound_seconds)
    if committed is None:
        return None
    up_to_batch, closed = committed
    published = generations(spark, tables)
    last = published[-1] if published else None
    day = closed if last_day is None else min(last_day, closed)
    if last:
        day = max(day, last.last_day)
        if (day, up_to_batch) == (last.last_day, last.up_to_batch):
            return None
    new = Generation(last.generation + 1 if last else 1, day, up_to_batch)
    rows = _unpacked(spark, tables, last).where(
        (F.col("event_date") <= F.lit(day)) & (F.col("batch_id") <= up_to_batch)
    )
    (
        rows.hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "event_ts")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("event_date")
        .parquet(f"{tables.packed}/generation={new.generation}")
    )
    publish(spark, tables, new)
    return new


def publish(spark: SparkSession, tables: Tables, new: Generation) -> None:
    """One row, written last: a compaction counts as done when it is there."""
    row = spark.range(1, numPartitions=1).select(
        F.lit(new.last_day).alias("last_day"), F.lit(new.up_to_batch).cast("long").alias("up_to_batch")
    )
    row.write.mode("overwrite").parquet(f"{tables.cold_list}/generation={new.generation}")


def vacuum(spark: SparkSession, tables: Tables, keep: int = 1) -> int:
    """Remove batch folders of packed days; returns how many.

    Those of the last ``keep`` compactions stay, for readers that began before them.  A catalog
    table over the batch folders would lose the rows: read such a history by ``read_live``.
    """
    published = generations(spark, tables)
    if len(published) <= keep:
        return 0
    done = published[len(published) - 1 - keep]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    system = hadoop.Path(tables.cold).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = 0
    for batch in folders_in(spark, tables.cold):
        number = batch.removeprefix("batch_id=")
        if not number.isdigit() or int(number) > done.up_to_batch:
            continue
        days = folders_in(spark, f"{tables.cold}/{batch}")
        packed = [d for d in days if d.removeprefix("event_date=") <= done.last_day.isoformat()]
        for day in packed:
            system.delete(hadoop.Path(f"{tables.cold}/{batch}/{day}"), True)
        removed += len(packed)
        if len(packed) == len(days):
            system.delete(hadoop.Path(f"{tables.cold}/{batch}"), True)
    return removed
