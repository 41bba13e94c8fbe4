"""Click events derived from a plain ``events`` table (FIXTURES.md, section 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewindow.operators.lateness import LatePolicy
from tidewindow.operators.repair import day_range

# event_id of this table is a number and orders arrivals of the same millisecond
CLICKSTREAM_POLICY = LatePolicy(arrival=("ingest_ts", "arrival_seq"))


def as_clickstream(events: DataFrame) -> DataFrame:
    """The 11 event columns, ``value`` for the revenue extension, and ``arrival_seq``.

    One row in ten arrives 10 to 300 s after its event time.
    """
    dated = events.withColumns({
        "event_ts": F.date_trunc("millisecond", "ts"),
        "k": F.get_json_object("props", "$.k").cast("int"),
    })
    delay_ms = F.expr(
        "CASE WHEN event_id * 7919 % 10 = 0 THEN 10000 + event_id * 104729 % 291 * 1000 ELSE 0 END"
    )
    return dated.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.expr("concat('user_', user_id)").alias("user_id"),
        F.expr("concat('sess_user_', user_id, '_', 1 + event_id % 10)").alias("session_id"),
        "event_type",
        "event_ts",
        F.timestamp_millis(F.unix_millis("event_ts") + delay_ms).alias("ingest_ts"),
        F.lit("events").alias("source"),
        F.expr("CASE WHEN k < 50 THEN concat('camp_', k % 10) END").alias("campaign_id"),
        F.expr("elt(1 + user_id % 3, 'mobile', 'desktop', 'tablet')").alias("device"),
        F.expr("elt(1 + user_id div 3 % 3, 'US', 'EU', 'APAC')").alias("geo"),
        F.lit("v1").alias("schema_version"),
        "value",
        F.col("event_id").alias("arrival_seq"),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def clickstream(
    spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None
) -> DataFrame:
    """The view over ``events.parquet``; ``days`` limits the scan itself."""
    events = read_events(spark, sf_dir)
    if days:
        events = day_range(events, *days, ts="ts")
    return as_clickstream(events)
