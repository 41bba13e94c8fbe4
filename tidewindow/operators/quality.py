"""Duplicates and records that cannot be used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewindow.contract import DECODED, REQUIRED_COLUMNS, poison_reason
from tidewindow.operators.ordered import total_order

# Wire form of an event in JSON: times are epoch milliseconds.
JSON_EVENT = (
    "event_id string, user_id string, session_id string, event_type string, "
    "event_ts long, ingest_ts long, source string, campaign_id string, "
    "device string, geo string, schema_version string, _corrupt string"
)


def dedup_events(
    events: DataFrame, key: str | Sequence[str] = "event_id", arrival: str = "ingest_ts"
) -> DataFrame:
    """Keep the earliest arrival per ``key``, and every row without a key.

    The first pass folds one number per row: the arrival, and below it a hash of the
    whole row that decides ties.  It is as wide for any row, so it is a hash aggregate
    that folds copies where they are read.  Rows are joined to it by key and number, so
    those of a hot key do not meet in one task; exact copies are left to ``distinct``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = events.columns
    number = total_order(F.unix_micros(arrival), names)
    with_key = F.lit(True)
    for name in keys:
        with_key = with_key & F.col(name).isNotNull()
    numbered = events.where(with_key).withColumn("_number", number)
    first = numbered.groupBy(*keys).agg(F.min("_number").alias("_number"))
    once = numbered.join(first, [*keys, "_number"], "left_semi").drop("_number").distinct()
    return once.unionByName(events.where(~with_key))


def decoded(raw: Column, reason: Column) -> Column:
    """The column a decoder adds: the message as bytes, and why it is poison or null."""
    return F.struct(raw.cast("binary").alias("raw"), reason.alias("reason")).alias(DECODED)


def parse_json_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Decode JSON text to event columns and the ``decoded`` column; other columns stay.

    A column of ``raw`` that has the name of an event column gives way to it.
    """
    event = F.from_json(
        F.col(value).cast("string"),
        JSON_EVENT,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )
    names = [part.split()[0] for part in JSON_EVENT.split(", ")]
    message = F.col(value).cast("binary").alias("_message")
    others = [F.col(name) for name in raw.columns if name not in (value, DECODED, *names)]
    # inline() keeps the parser from being repeated for every column that uses it
    opened = raw.select(*others, message, F.inline(F.array(event))).withColumns({
        "event_ts": F.timestamp_millis("event_ts"),
        "ingest_ts": F.timestamp_millis("ingest_ts"),
    })
    reason = (
        F.when(F.col("_message").isNull(), "missing")
        .when(F.col("_corrupt").isNotNull(), "malformed")
        .otherwise(poison_reason(REQUIRED_COLUMNS))
    )
    return opened.withColumn(DECODED, decoded(F.col("_message"), reason)).drop("_corrupt", "_message")


def json_value(columns: list[str]) -> Column:
    """Event as JSON text, nulls written out, times as epoch milliseconds."""
    fields = [
        F.unix_millis(F.col(name)).alias(name) if name in ("event_ts", "ingest_ts") else F.col(name)
        for name in columns
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def split_poison(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, poison)`` of what a decoder gave; a poison row is its raw bytes and the reason."""
    reason = F.col(f"{DECODED}.reason")
    poison = tagged.where(reason.isNotNull()).select(f"{DECODED}.raw", f"{DECODED}.reason")
    return tagged.where(reason.isNull()).drop(DECODED), poison
