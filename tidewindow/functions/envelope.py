"""Registry wire envelope: one zero byte, a 4-byte big-endian schema id, the body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER_BYTES = 5


def wrap(body: Column, schema_id: int | Column) -> Column:
    """Put ``body`` (binary) behind the envelope header."""
    number = F.lit(schema_id) if isinstance(schema_id, int) else schema_id
    header = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(number.cast("long")), 8, "0")))
    return F.concat(header, body)


def status(value: str) -> Column:
    """``ok``, or why the envelope cannot be opened."""
    raw = F.col(value)
    return (
        F.when(raw.isNull(), "missing")
        .when(F.octet_length(raw) < HEADER_BYTES, "too_short")
        .when(F.hex(F.substring(raw, 1, 1)) != "00", "bad_magic")
        .otherwise("ok")
    )


def unwrap(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``envelope_status``, ``schema_id`` and ``body``; the last two only when ok."""
    ok = F.col("envelope_status") == "ok"
    number = F.conv(F.hex(F.substring(F.col(value), 2, 4)), 16, 10).cast("long")
    body = F.expr(f"substring(`{value}`, {HEADER_BYTES + 1})")
    return df.withColumn("envelope_status", status(value)).withColumns(
        {"schema_id": F.when(ok, number), "body": F.when(ok, body)}
    )
