"""The click-event contract: columns, defaults, compatibility, and contract checks."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    dtype: T.DataType
    required: bool = True
    default: str | None = None

    @property
    def has_default(self) -> bool:
        return not self.required or self.default is not None


# Column names, types, defaults and order of a click event.
CLICK_EVENT = (
    Field("event_id", T.StringType()),
    Field("user_id", T.StringType()),
    Field("session_id", T.StringType()),
    Field("event_type", T.StringType()),
    Field("event_ts", T.TimestampType()),
    Field("ingest_ts", T.TimestampType()),
    Field("source", T.StringType(), default="unknown"),
    Field("campaign_id", T.StringType(), required=False),
    Field("device", T.StringType(), default="unknown"),
    Field("geo", T.StringType(), default="unknown"),
    Field("schema_version", T.StringType(), default="v1"),
)

EVENT_COLUMNS = [field.name for field in CLICK_EVENT]
REQUIRED_COLUMNS = [field.name for field in CLICK_EVENT if not field.has_default]
DIMENSIONS = ["campaign_id", "geo", "device"]
METRIC_KEY = ["window_start", *DIMENSIONS]
COLD_COLUMNS = [
    "event_id", "user_id", "event_type", "event_ts", "campaign_id", "geo", "device",
]
#: What a decoder says of a message, beside the event columns.  One column under a name that
#: no event column has, so that business columns like ``value`` or ``reason`` stay what they are.
DECODED = "_decoded"
DECODED_TYPE = T.StructType([
    T.StructField("raw", T.BinaryType()),
    T.StructField("reason", T.StringType()),
])

EVENT_SCHEMA = T.StructType([T.StructField(f.name, f.dtype) for f in CLICK_EVENT])
METRIC_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("geo", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("revenue", T.DoubleType()),
])
COLD_SCHEMA = T.StructType([
    *[EVENT_SCHEMA[name] for name in COLD_COLUMNS],
    T.StructField("batch_id", T.LongType()),
    T.StructField("event_date", T.DateType()),
])
LATE_SCHEMA = T.StructType([
    *EVENT_SCHEMA.fields,
    T.StructField("window_end", T.TimestampType()),
    T.StructField("watermark", T.TimestampType()),
    T.StructField("late_by_ms", T.LongType()),
    T.StructField("payload", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
POISON_SCHEMA = T.StructType([
    T.StructField("raw", T.BinaryType()),
    T.StructField("reason", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
PROGRESS_SCHEMA = T.StructType([
    T.StructField("max_event_ts", T.TimestampType()),
    T.StructField("rows", T.LongType()),
    T.StructField("late_rows", T.LongType()),
    T.StructField("poison_rows", T.LongType()),
    T.StructField("query_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
REPORT_SCHEMA = T.StructType([
    T.StructField("json", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])


def avro_schema(contract: tuple[Field, ...] = CLICK_EVENT) -> str:
    """Reader schema in JSON.  Times are plain longs on the wire."""
    fields = []
    for f in contract:
        kind = "long" if isinstance(f.dtype, T.TimestampType) else f.dtype.typeName()
        entry = {"name": f.name, "type": kind if f.required else ["null", kind]}
        if f.has_default:
            entry["default"] = f.default
        fields.append(entry)
    return json.dumps({"type": "record", "name": "ClickEvent", "fields": fields})


def conform(
    df: DataFrame,
    contract: tuple[Field, ...] = CLICK_EVENT,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Read ``df`` with the contract: cast what is there, fill what is missing.

    A missing column takes its default; a missing required column becomes null, so
    that the poison check can name it.  Columns in ``keep`` stay when present.
    """
    present = set(df.columns)
    fields = [
        (F.col(f.name) if f.name in present else F.lit(f.default))
        .cast(f.dtype)
        .alias(f.name)
        for f in contract
    ]
    return df.select(*fields, *[name for name in keep if name in present])


# Type changes a reader of the old schema survives.
PROMOTIONS = {
    ("int", "bigint"), ("int", "float"), ("int", "double"),
    ("bigint", "float"), ("bigint", "double"), ("float", "double"),
    ("string", "binary"), ("binary", "string"),
}


def breaking_changes(
    old: tuple[Field, ...], new: tuple[Field, ...]
) -> list[tuple[str, str]]:
    """``(column, rule)`` for every change that breaks backward compatibility.

    Optional columns may come and go.  A required column may be neither dropped nor
    added, and a type may only be widened.
    """
    before = {f.name: f for f in old}
    after = {f.name: f for f in new}
    broken = [
        (name, "dropped_required")
        for name, f in before.items()
        if name not in after and not f.has_default
    ]
    broken += [
        (name, "added_required")
        for name, f in after.items()
        if name not in before and not f.has_default
    ]
    for name in before.keys() & after.keys():
        change = (before[name].dtype.simpleString(), after[name].dtype.simpleString())
        if change[0] != change[1] and change not in PROMOTIONS:
            broken.append((name, "changed_type"))
    return sorted(broken)


def contract_violations(
    df: DataFrame, contract: tuple[Field, ...] = CLICK_EVENT
) -> DataFrame:
    """``column_name, rule, rows``: how many rows of a table break which rule.

    One pass with one aggregate row, then unpivoted.
    """
    types = {field.name: field.dataType for field in df.schema.fields}
    checks = []
    for f in contract:
        if f.name not in types:
            if not f.has_default:
                checks.append((f.name, "missing_required", F.lit(True)))
            continue
        if types[f.name] != f.dtype:
            checks.append((f.name, "changed_type", F.lit(True)))
        if f.required:
            checks.append((f.name, "null_in_required", F.col(f.name).isNull()))
    if not checks:
        return df.sparkSession.createDataFrame([], "column_name string, rule string, rows long")
    counts = df.agg(*[F.count_if(broken).alias(f"c{i}") for i, (_, _, broken) in enumerate(checks)])
    entries = ", ".join(
        f"'{name}', '{rule}', c{i}" for i, (name, rule, _) in enumerate(checks)
    )
    return counts.selectExpr(
        f"stack({len(checks)}, {entries}) AS (column_name, rule, rows)"
    ).filter("rows > 0")


def poison_reason(columns: list[str] = REQUIRED_COLUMNS) -> Column:
    """Null for a good row, else which required column is null first."""
    return F.coalesce(*[
        F.when(F.col(name).isNull(), F.lit(f"null_{name}")) for name in columns
    ])
