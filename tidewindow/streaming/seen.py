"""Index of the event ids in history, so that a batch finds copies without reading whole days.

Ids are dealt by a 64-bit digest into the buckets of their event day.  A day has as many buckets as
keep each at ``BUCKET_IDS`` ids or fewer on average, a power of two, so what a batch reads is
bounded by its own rows times the size of a bucket, however large its days have become.  A batch
opens the buckets its own ids fall into, and compares whole ids: equal digests alone are no copy.

Ids of new batches lie in a tail, one folder for each batch.  Every ``FOLD_EVERY`` batches the tail
is folded into the buckets of the days it touches; a day that outgrew its buckets is dealt anew.
The list of days, their buckets and folders is written last, and only then is what it replaced
removed, so a fold that breaks off is done again.  Only the job itself reads the index.

A tail with gaps, as of a job that dropped copies only later, is built anew from history.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewindow.sinks.tables import Tables, folders_in, path_exists
from tidewindow.sources.tables import read_cold

#: Ids of a bucket, on average at most.
BUCKET_IDS = 1 << 16
#: Batches between two folds.
FOLD_EVERY = 60

ID_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_date", T.DateType()),
])
LIST_SCHEMA = T.StructType([
    T.StructField("event_date", T.DateType()),
    T.StructField("buckets", T.IntegerType()),
    T.StructField("generation", T.LongType()),
    T.StructField("up_to_batch", T.LongType()),
])


class Day(NamedTuple):
    buckets: int
    generation: int


class Listed(NamedTuple):
    """What the newest list says: its number, the batches folded, and the days."""

    version: int
    up_to_batch: int
    days: dict[dt.date, Day]


def bucket_of(buckets: dict[dt.date, int]) -> Column:
    """The bucket of a row, given how many its day has; null for other days."""
    entries = [F.lit(x) for day, n in sorted(buckets.items()) for x in (day, n)]
    count = F.try_element_at(F.create_map(*entries), F.col("event_date"))
    return F.pmod(F.xxhash64("event_id"), count).cast("int")


class SeenIds:
    """The index beside the tables of a job."""

    def __init__(self, spark: SparkSession, tables: Tables):
        self.spark, self.tables, self.root = spark, tables, tables.seen
        #: Folders that the last ``known`` opened.
        self.opened: list[str] = []

    def _tail(self, batch_id: int) -> str:
        return f"{self.root}/tail/batch_id={batch_id}"

    def _day(self, day: dt.date, generation: int) -> str:
        return f"{self.root}/days/generation={generation}/event_date={day.isoformat()}"

    def listed(self) -> Listed:
        place = f"{self.root}/list"
        if not path_exists(self.spark, place):
            return Listed(0, -1, {})
        done = [
            int(name.removeprefix("version=")) for name in folders_in(self.spark, place)
            if path_exists(self.spark, f"{place}/{name}/_SUCCESS")
        ]
        if not done:
            return Listed(0, -1, {})
        rows = self.spark.read.schema(LIST_SCHEMA).parquet(f"{place}/version={max(done)}").collect()
        days = {r["event_date"]: Day(r["buckets"], r["generation"]) for r in rows if r["event_date"]}
        return Listed(max(done), rows[0]["up_to_batch"], days)

    def add(self, events: DataFrame, batch_id: int) -> None:
        """Keep the ids of a batch; a repeated batch replaces them."""
        ids = events.select("event_id", F.to_date("event_ts").alias("event_date"))
        ids.write.mode("overwrite").parquet(self._tail(batch_id))

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], ID_SCHEMA)
        return self.spark.read.schema(ID_SCHEMA).parquet(*paths)

    def _read_days(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], ID_SCHEMA)
        reader = self.spark.read.schema(ID_SCHEMA).option("basePath", f"{self.root}/days")
        return reader.parquet(*paths).select(*ID_SCHEMA.names)

    def known(self, dated: DataFrame, batch_id: int) -> DataFrame:
        """Ids and days of earlier batches, of the buckets that the rows of ``dated`` fall into."""
        listed = self.listed()
        # a row for each day of the batch, with the buckets of that day that it needs
        buckets = {day: entry.buckets for day, entry in listed.days.items()}
        bucket = bucket_of(buckets) if buckets else F.lit(None).cast("int")
        needed = dated.groupBy("event_date").agg(F.collect_set(bucket).alias("buckets")).collect()
        self.opened = []
        for row in needed:
            if row["event_date"] not in listed.days:
                continue
            place = self._day(row["event_date"], listed.days[row["event_date"]].generation)
            own = {f"bucket={number}" for number in row["buckets"]}
            self.opened += [f"{place}/{name}" for name in folders_in(self.spark, place) if name in own]
        tail = self._read([self._tail(b) for b in range(listed.up_to_batch + 1, batch_id)])
        return self._read_days(self.opened).unionByName(tail)

    def fold(self, batch_id: int) -> bool:
        """Before a batch: move the tail into the buckets if it is long enough."""
        listed = self.listed()
        tail = list(range(listed.up_to_batch + 1, batch_id))
        whole = all(path_exists(self.spark, self._tail(b)) for b in tail)
        if whole and len(tail) < FOLD_EVERY:
            return False
        if whole:
            new = self._read([self._tail(b) for b in tail])
        else:
            listed = Listed(listed.version, -1, {})
            stored = read_cold(self.spark, self.tables).where(F.col("batch_id") < batch_id)
            new = stored.select(*ID_SCHEMA.names)
        touched = [r["event_date"] for r in new.select("event_date").distinct().collect()]
        old = [self._day(day, listed.days[day].generation) for day in touched if day in listed.days]
        rows = self._read_days(old).unionByName(new)
        buckets = {
            r["event_date"]: 1 << max(0, (r["n"] - 1) // BUCKET_IDS).bit_length()
            for r in rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).collect()
        }
        version = listed.version + 1
        if buckets:
            (
                rows.withColumn("bucket", bucket_of(buckets))
                .repartition("event_date", "bucket")
                .write.mode("overwrite")
                .partitionBy("event_date", "bucket")
                .parquet(f"{self.root}/days/generation={version}")
            )
        days = {**listed.days, **{day: Day(n, version) for day, n in buckets.items()}}
        table = [(day, entry.buckets, entry.generation, batch_id - 1) for day, entry in sorted(days.items())]
        # without days the list says only how far it goes
        self.spark.createDataFrame(table or [(None, 0, 0, batch_id - 1)], LIST_SCHEMA).coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.root}/list/version={version}")
        self._remove([*old, *(self._tail(b) for b in tail), f"{self.root}/list/version={version - 1}"])
        return True

    def _remove(self, paths: list[str]) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            place = hadoop.Path(path)
            place.getFileSystem(conf).delete(place, True)
