"""Column expressions and projections on click events; all of them stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewindow.contract import COLD_COLUMNS

# What a missing dimension is counted under.
DIMENSION_DEFAULTS = {"campaign_id": "organic", "geo": "unknown", "device": "unknown"}


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def dimension(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(DIMENSION_DEFAULTS[name]))


def with_dimensions(df: DataFrame) -> DataFrame:
    """Replace null dimensions by the names they are counted under."""
    return df.withColumns({name: dimension(name) for name in DIMENSION_DEFAULTS})


def cold_projection(df: DataFrame, *more: Column) -> DataFrame:
    """The seven history columns, and ``more``.  A null campaign stays null; geo and device do not."""
    kept = df.withColumns({name: dimension(name) for name in ("geo", "device")})
    return kept.select(*COLD_COLUMNS, *more)


def window_start(ts: str | Column, seconds: int = 60) -> Column:
    """Start of the epoch-aligned window ``[start, start + seconds)`` that holds ``ts``."""
    instant = F.unix_seconds(_col(ts))
    return F.timestamp_seconds(instant - F.pmod(instant, F.lit(seconds)))


def shift(ts: str | Column, seconds: int) -> Column:
    return _col(ts) + F.make_dt_interval(secs=F.lit(seconds))


def window_end(ts: str | Column, seconds: int = 60) -> Column:
    return shift(window_start(ts, seconds), seconds)


def millis(ts: str | Column) -> Column:
    return F.unix_millis(_col(ts))


def from_millis(value: str | Column) -> Column:
    return F.timestamp_millis(_col(value))


def composite_key() -> Column:
    """Display form of the grouping key; grouping itself uses the three columns."""
    return F.concat_ws("|", *[dimension(name) for name in DIMENSION_DEFAULTS])


def late_payload() -> Column:
    """Text form of a late record.  The last three values are constants of the format."""
    parts = F.concat_ws(",", *[dimension(name) for name in DIMENSION_DEFAULTS])
    return F.concat(F.lit("LATE: ("), parts, F.lit(",dummy,1,0)"))


def plain_timestamps(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as other engines hand them out."""
    return df.select(*[
        F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
        for name, kind in df.dtypes
    ])
