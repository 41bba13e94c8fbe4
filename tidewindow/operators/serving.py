"""Reads of the metrics table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewindow.contract import DIMENSIONS, METRIC_KEY
from tidewindow.operators.ordered import total_order


def latest_by_key(
    rows: DataFrame, key: Sequence[str] = tuple(METRIC_KEY), version: str = "batch_id"
) -> DataFrame:
    """The row of the highest ``version`` per key: replace-by-key at read time.

    One ``max_by`` per column keeps fixed-width buffers, hence hash aggregation.  All
    columns follow one total order, so they come from one row, also if two rows of a key
    have the same version.
    """
    rest = [name for name in rows.columns if name not in key and name != version]
    order = total_order(F.col(version), rest)
    return rows.groupBy(*key).agg(
        *[F.max_by(name, order).alias(name) for name in rest],
        F.max(version).alias(version),
    )


def latest_windows(metrics: DataFrame, n: int = 5) -> DataFrame:
    """Newest windows first; the dimensions make the order total."""
    return metrics.orderBy(F.col("window_start").desc(), *DIMENSIONS).limit(n)


def for_campaign(metrics: DataFrame, campaign: str) -> DataFrame:
    return metrics.where(F.col("campaign_id") == campaign)


def metrics_view(metrics: DataFrame, name: str = "metrics_1m") -> None:
    """Make the metrics readable by SQL under ``name``."""
    metrics.createOrReplaceTempView(name)
