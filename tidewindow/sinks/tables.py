"""File tables of the job.  Every write replaces the folder of its own batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewindow.contract import (
    COLD_SCHEMA,
    EVENT_SCHEMA,
    METRIC_KEY,
    METRIC_SCHEMA,
)
from tidewindow.functions.dims import cold_projection

# about 128 MB of history rows
ROWS_PER_FILE = 1_500_000

HOT_SCHEMA = T.StructType([
    *METRIC_SCHEMA.fields,
    T.StructField("batch_id", T.LongType()),
    T.StructField("window_date", T.DateType()),
])
REPLAYED_SCHEMA = T.StructType([
    *EVENT_SCHEMA.fields,
    T.StructField("replay_id", T.LongType()),
])


@dataclass(frozen=True)
class Tables:
    """Where the tables of one job live."""

    root: str

    @property
    def hot(self) -> str:
        return f"{self.root}/metrics_1m"

    @property
    def cold(self) -> str:
        return f"{self.root}/cold_events"

    @property
    def packed(self) -> str:
        """Days of the history that were compacted."""
        return f"{self.root}/cold_packed"

    @property
    def cold_list(self) -> str:
        """What of the history is packed."""
        return f"{self.root}/cold_list"

    @property
    def seen(self) -> str:
        """Index of the ids in the history, of a job that drops copies."""
        return f"{self.root}/seen_ids"

    @property
    def digests(self) -> str:
        """Digests by minute of hot, late and history rows of committed batches."""
        return f"{self.root}/digests"

    @property
    def ledger(self) -> str:
        """Topic positions that replays have read."""
        return f"{self.root}/replay_ledger"

    @property
    def late(self) -> str:
        return f"{self.root}/late_events"

    @property
    def poison(self) -> str:
        return f"{self.root}/poison_rows"

    @property
    def progress(self) -> str:
        return f"{self.root}/progress"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    @property
    def replayed(self) -> str:
        return f"{self.root}/replayed_events"

    @property
    def topic_replays(self) -> str:
        """Events replayed from topics, which have ids of their own."""
        return f"{self.root}/topic_replays"

    def open_windows(self, batch_id: int) -> str:
        """Two places in turn: a batch reads one and replaces the other."""
        return f"{self.root}/open_windows/{batch_id % 2}"

    def without_copies(self, batch_id: int) -> str:
        """The batch itself after dropping copies, replaced by the one after the next."""
        return f"{self.root}/without_copies/{batch_id % 2}"

    def create(self, spark: SparkSession) -> None:
        """Make sure every table can be read before the first batch wrote to it."""
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in (
            self.hot, self.cold, self.late, self.poison, self.progress, self.replayed,
            self.reports,
        ):
            folder = hadoop.Path(path)
            folder.getFileSystem(conf).mkdirs(folder)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders of one batch: a few days."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)
    return [f.getPath().getName() for f in found if f.isDirectory()]


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; the folder that ``to`` lies in is made if it is missing."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place, new = hadoop.Path(path), hadoop.Path(to)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(new.getParent())
    if not system.rename(place, new):
        raise OSError(f"{path} cannot be renamed to {to}")


def create_cold_table(spark: SparkSession, name: str, location: str) -> None:
    """Register the history as a catalog table partitioned by batch and day.

    Batches written later are added by ``register_batch``.
    """
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in COLD_SCHEMA.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY (batch_id, event_date) LOCATION '{location}'"
    )
    spark.catalog.recoverPartitions(name)


def register_batch(spark: SparkSession, name: str, location: str, batch_id: int) -> None:
    """Make the days of one batch known to the catalog, and no others of it."""
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (batch_id = {batch_id})")
    days = [
        f"PARTITION (batch_id = {batch_id}, event_date = '{folder.removeprefix('event_date=')}')"
        for folder in folders_in(spark, f"{location}/batch_id={batch_id}")
        if folder.startswith("event_date=")
    ]
    if days:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(days)}")


def replace_batch(df: DataFrame, path: str, batch_id: int, *parts: str) -> None:
    """Replace the folder of a batch as a whole, so nothing of an earlier attempt stays."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*parts)
        .parquet(f"{path}/batch_id={batch_id}")
    )


def cold_rows(events: DataFrame, *more: Column) -> DataFrame:
    """History rows laid out for writing, with ``more`` columns.

    Rebalancing brings the rows of a day together, splits a day that is larger than
    the advised partition size, and joins small ones; sorting inside a file gives
    row-group bounds on event time.
    """
    return (
        cold_projection(events, *more)
        .withColumn("event_date", F.to_date("event_ts"))
        .hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "event_ts")
    )


def write_cold(events: DataFrame, path: str, batch_id: int) -> None:
    replace_batch(cold_rows(events), path, batch_id, "event_date")


def write_hot(metrics: DataFrame, path: str, batch_id: int) -> None:
    """Metrics in table order, so that files carry bounds on the window start."""
    rows = (
        metrics.withColumn("window_date", F.to_date("window_start"))
        .hint("rebalance", "window_date")
        .sortWithinPartitions("window_date", *METRIC_KEY)
    )
    replace_batch(rows, path, batch_id, "window_date")


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Replace the one directory of this batch, also when it has no rows."""
    replace_batch(df, path, batch_id)
