"""The streaming job: counts, late events and history from one micro-batch each.

Within a batch every event takes exactly one way: poison, late, or counted.  All
good events, late ones too, go to history.  A batch is judged by the watermark of the
batches before it, which the progress table holds, so a repeated batch comes to the
same result and replaces what its first run left behind.

The progress table also holds whose batches these are.  A stream with another checkpoint
would begin with batch 0 again and replace them one by one, so it is refused.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewindow.contract import (
    DECODED,
    DECODED_TYPE,
    EVENT_COLUMNS,
    METRIC_SCHEMA,
    PROGRESS_SCHEMA,
    REQUIRED_COLUMNS,
    conform,
    poison_reason,
)
from tidewindow.functions.dims import late_payload, millis, window_end
from tidewindow.operators.lateness import LatePolicy
from tidewindow.operators.metrics import merge_by_sum, windowed_counts
from tidewindow.operators.quality import dedup_events, json_value
from tidewindow.sinks.tables import (
    Tables,
    create_cold_table,
    path_exists,
    register_batch,
    write_batch,
    write_cold,
    write_hot,
)
from tidewindow.sources.tables import read_progress
from tidewindow.streaming.reports import keep_reports
from tidewindow.streaming.seen import SeenIds

MICROS = 1_000_000


def side_by_side(spark: SparkSession, writes: list[Callable[[], None]]) -> None:
    """Run independent writes at once; the first failure is raised after all ended."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inherit(write)) for write in writes]:
            done.result()


Sink = Callable[[DataFrame], None]
BatchSink = Callable[[DataFrame, int], None]


def stream_ids(spark: SparkSession) -> tuple[str | None, str | None]:
    """Query and run that the current batch belongs to; none outside a stream."""
    context = spark.sparkContext
    query = context.getLocalProperty("sql.streaming.queryId")
    return query, context.getLocalProperty("spark.jobGroup.id") if query else None


def check_decoded(stream: DataFrame) -> None:
    """Refuse a stream whose column ``DECODED`` is not what a decoder of the library adds."""
    if DECODED in stream.columns:
        kind = stream.schema[DECODED].dataType
        if kind.simpleString() != DECODED_TYPE.simpleString():
            raise ValueError(f"{DECODED} is {kind.simpleString()}, not what a decoder adds")


@dataclass(frozen=True)
class StreamJob:
    """Tables to write, rules to apply, and sinks beside the tables.

    ``hot_sinks`` get the windows a batch closes and ``late_sinks`` its late events.
    A repeated batch calls them again, so a hot sink has to replace by key.
    ``cold_sinks`` and ``poison_sinks`` get the rows and the batch id, to guard
    against the repetition themselves.  ``catalog_table`` names the history in the
    catalog; each batch is added to it.

    With ``dedup`` a copy is a row with the id and the event day of an earlier one.
    """

    tables: Tables
    policy: LatePolicy = field(default_factory=LatePolicy)
    dedup: bool = False
    hot_sinks: tuple[Sink, ...] = ()
    late_sinks: tuple[Sink, ...] = ()
    cold_sinks: tuple[BatchSink, ...] = ()
    poison_sinks: tuple[BatchSink, ...] = ()
    catalog_table: str | None = None

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Run ``stream`` through the job; by default one batch a minute.

        ``stream`` has event columns, and from a decoder the column ``DECODED``, with
        the raw message and the reason, null for a good row.  Other columns are left out.
        """
        check_decoded(stream)
        missing = [name for name in REQUIRED_COLUMNS if name not in stream.columns]
        if missing:
            raise ValueError(f"the stream lacks required columns: {', '.join(missing)}")
        spark = stream.sparkSession
        self.tables.create(spark)
        if not path_exists(spark, f"{checkpoint}/metadata") and not read_progress(
            spark, self.tables
        ).isEmpty():
            raise RuntimeError(
                f"{self.tables.progress} has batches, but {checkpoint} is new: "
                "these tables do not belong to this checkpoint"
            )
        if self.catalog_table:
            create_cold_table(spark, self.catalog_table, self.tables.cold)
        query = (
            stream.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"}))
            .foreachBatch(self.process)
            .start()
        )
        keep_reports(spark, query, self.tables.reports)
        return query

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        owner, run = stream_ids(spark)
        before = self._reached_before(spark, batch_id, owner)
        tagged = self._tag(batch, before)
        if self.dedup:
            # written before the index of ids is, since that was read for it
            place = self.tables.without_copies(batch_id)
            once = self._without_copies(tagged, batch_id)
            once.write.mode("overwrite").parquet(place)
            tagged = spark.read.schema(once.schema).parquet(place)
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = self._figures(tagged)
            known = [t for t in (before, seen["newest"]) if t is not None]
            reached = max(known, default=None)
            good = tagged.where("reason IS NULL")
            closed, still_open = self._counts(spark, good.where("NOT is_late"), reached, batch_id)
            writes = [
                lambda: self._write_cold(good, batch_id),
                lambda: self._write_closed(closed, batch_id),
                lambda: still_open.write.mode("overwrite").parquet(self.tables.open_windows(batch_id)),
            ]
            writes += [lambda sink=sink: sink(good, batch_id) for sink in self.cold_sinks]
            if self.dedup:
                writes.append(lambda: SeenIds(spark, self.tables).add(good, batch_id))
            if seen["late_rows"]:
                late = self._late_rows(good.where("is_late"), before)
                writes.append(lambda: write_batch(late, self.tables.late, batch_id))
                writes += [lambda sink=sink: sink(late) for sink in self.late_sinks]
            if seen["poison_rows"]:
                poison = tagged.where("reason IS NOT NULL").select("raw", "reason")
                writes.append(lambda: write_batch(poison, self.tables.poison, batch_id))
                writes += [lambda sink=sink: sink(poison, batch_id) for sink in self.poison_sinks]
            side_by_side(spark, writes)
            self._commit(spark, batch_id, reached, seen, owner, run)
        finally:
            tagged.unpersist()

    # ---- watermark

    def _write_cold(self, good: DataFrame, batch_id: int) -> None:
        write_cold(good, self.tables.cold, batch_id)
        if self.catalog_table:
            register_batch(good.sparkSession, self.catalog_table, self.tables.cold, batch_id)

    def _reached_before(self, spark: SparkSession, batch_id: int, owner: str | None) -> int | None:
        """Newest event time of all earlier batches, in microseconds."""
        foreign = RuntimeError(
            f"{self.tables.progress} holds batches of another stream: "
            "these tables do not belong to this checkpoint"
        )
        if batch_id == 0:
            others = (F.col("batch_id") > 0) | ~F.col("query_id").eqNullSafe(F.lit(owner))
            if path_exists(spark, self.tables.progress) and not read_progress(
                spark, self.tables
            ).where(others).isEmpty():
                raise foreign
            return None
        path = f"{self.tables.progress}/batch_id={batch_id - 1}"
        try:
            committed = spark.read.schema(PROGRESS_SCHEMA).parquet(path)
            last = committed.select(F.unix_micros("max_event_ts").alias("t"), "query_id").first()
        except AnalysisException as missing:
            raise RuntimeError(
                f"batch {batch_id - 1} left no progress in {self.tables.progress}: "
                "these tables do not belong to this checkpoint"
            ) from missing
        if last["query_id"] != owner:
            raise foreign
        return last["t"]

    def _watermark(self, reached: int | None) -> Column:
        if reached is None:
            return F.lit(None).cast("timestamp")
        return F.timestamp_micros(F.lit(reached - self.policy.bound_seconds * MICROS))

    # ---- the ways of an event

    def _tag(self, batch: DataFrame, before: int | None) -> DataFrame:
        """Event columns, ``reason`` and ``raw`` for poison, ``window_end``, ``is_late``."""
        events = conform(batch, keep=(DECODED,))
        reason, raw = poison_reason(), json_value(EVENT_COLUMNS).cast("binary")
        if DECODED in events.columns:
            reason = F.coalesce(F.col(f"{DECODED}.reason"), reason)
            raw = F.col(f"{DECODED}.raw")
        end = window_end("event_ts", self.policy.width_seconds)
        return events.select(
            *EVENT_COLUMNS,
            reason.alias("reason"),
            F.when(reason.isNotNull(), raw).alias("raw"),
            end.alias("window_end"),
            F.coalesce(end <= self._watermark(before), F.lit(False)).alias("is_late"),
        )

    def _without_copies(self, tagged: DataFrame, batch_id: int) -> DataFrame:
        """Drop copies of events in this batch or in history; poison rows stay.

        A copy has the id and the event day of an earlier row, so what is dropped does
        not depend on what else is in the batch.  Of the index of ids only the buckets
        that ids of the batch fall into are read.
        """
        good, poison = tagged.where("reason IS NULL"), tagged.where("reason IS NOT NULL")
        dated = good.withColumn("event_date", F.to_date("event_ts"))
        seen = SeenIds(tagged.sparkSession, self.tables)
        seen.fold(batch_id)
        once = dedup_events(dated, ["event_date", "event_id"]).join(
            seen.known(dated, batch_id), ["event_date", "event_id"], "left_anti"
        )
        return once.select(*tagged.columns).unionByName(poison)

    def _late_rows(self, late: DataFrame, before: int | None) -> DataFrame:
        return (
            late.select(*EVENT_COLUMNS, "window_end")
            .withColumn("watermark", self._watermark(before))
            .withColumn("late_by_ms", millis("watermark") - millis("window_end"))
            .withColumn("payload", late_payload())
        )

    def _figures(self, tagged: DataFrame) -> Row:
        usable = F.col("reason").isNull()
        return tagged.agg(
            F.max(F.when(usable, F.unix_micros("event_ts"))).alias("newest"),
            F.count_if(usable).alias("rows"),
            F.count_if(usable & F.col("is_late")).alias("late_rows"),
            F.count_if(~usable).alias("poison_rows"),
        ).first()

    # ---- counts and commit

    def _counts(
        self, spark: SparkSession, in_time: DataFrame, reached: int | None, batch_id: int
    ) -> tuple[DataFrame, DataFrame]:
        """The open windows and the batch added up: windows it closes, and those it leaves open.

        Only windows ahead of the watermark are carried from batch to batch.  What is asked of
        a window's end is asked of its events before they are counted, so either table counts
        its own events and the number of partitions follows their size.
        """
        counts = windowed_counts(in_time, self.policy.width_seconds)
        if batch_id > 0:
            carried = spark.read.schema(METRIC_SCHEMA).parquet(
                self.tables.open_windows(batch_id - 1)
            )
            counts = merge_by_sum(carried, counts)
        closed = F.coalesce(F.col("window_end") <= self._watermark(reached), F.lit(False))
        return counts.where(closed), counts.where(~closed)

    def _write_closed(self, closed: DataFrame, batch_id: int) -> None:
        if not self.hot_sinks:
            return write_hot(closed, self.tables.hot, batch_id)
        closed = closed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_hot(closed, self.tables.hot, batch_id)
            for sink in self.hot_sinks:
                sink(closed)
        finally:
            closed.unpersist()

    def _commit(
        self, spark: SparkSession, batch_id: int, reached: int | None, seen: Row,
        owner: str | None, run: str | None,
    ) -> None:
        """One progress row, written last: a batch counts as done when it is there."""
        row = spark.range(1, numPartitions=1).select(
            F.timestamp_micros(F.lit(reached).cast("long")).alias("max_event_ts"),
            *[
                F.lit(seen[name]).cast("long").alias(name)
                for name in ("rows", "late_rows", "poison_rows")
            ],
            F.lit(owner).cast("string").alias("query_id"),
            F.lit(run).cast("string").alias("run_id"),
        )
        write_batch(row, self.tables.progress, batch_id)
