"""Delay quantiles from stored sketches: one small row per batch and group, merged when read.

A sketch takes some kilobytes however many events it stands for.  Sketches of batches are merged
into those of days, or of any coarser group, without reading an event again.  What they give is a value
whose rank is near the one asked for; ``RANK_ERROR`` is about three times the error that 99 of
100 sketches of ``SKETCH_K`` stay below.  Up to ``SKETCH_K`` values a sketch is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewindow.functions.dims import millis
from tidewindow.sinks.tables import write_batch

SKETCH_K = 800
RANK_ERROR = 0.01
PROBABILITIES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def delays(events: DataFrame) -> DataFrame:
    """The events with ``arrival_date`` and ``delay_ms``."""
    return events.withColumns({
        "arrival_date": F.date_format("ingest_ts", "yyyy-MM-dd"),
        "delay_ms": millis("ingest_ts") - millis("event_ts"),
    })


def sketches(delayed: DataFrame, by: Sequence[str], value: str = "delay_ms", k: int = SKETCH_K) -> DataFrame:
    """One sketch per group; groups without values have none."""
    return delayed.where(F.col(value).isNotNull()).groupBy(*by).agg(
        F.kll_sketch_agg_bigint(value, k).alias("sketch"), F.max(value).alias("most")
    )


def write_sketches(delayed: DataFrame, by: Sequence[str], path: str, batch_id: int) -> None:
    """Keep the sketches of a batch; a repeated batch replaces its own."""
    write_batch(sketches(delayed, by), path, batch_id)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged_quantiles(
    stored: DataFrame, by: Sequence[str], value: str = "delay_ms", k: int = SKETCH_K,
    probabilities: dict[str, float] = PROBABILITIES,
) -> DataFrame:
    """Quantiles per ``by``, which may be fewer columns than the sketches were taken by."""
    merged = stored.groupBy(*by).agg(
        F.kll_merge_agg_bigint("sketch", k).alias("sketch"), F.max("most").alias(f"max_{value}")
    )
    return merged.select(
        *by,
        F.kll_sketch_get_n_bigint("sketch").alias("events"),
        *[
            F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).alias(f"{name}_{value}")
            for name, p in probabilities.items()
        ],
        f"max_{value}",
    )


def rank_errors(
    delayed: DataFrame, quantiles: DataFrame, by: Sequence[str], value: str = "delay_ms",
    probabilities: dict[str, float] = PROBABILITIES,
) -> DataFrame:
    """How far the rank of each quantile is from the one asked for, measured on all values."""
    names = [f"{name}_{value}" for name in probabilities]
    own = quantiles.select(*by, *names)
    ranked = delayed.where(F.col(value).isNotNull()).join(own, list(by)).groupBy(*by).agg(
        F.count("*").alias("events"),
        *[F.count_if(F.col(value) < F.col(q)).alias(f"_{q}_below") for q in names],
        *[F.count_if(F.col(value) <= F.col(q)).alias(f"_{q}_upto") for q in names],
    )
    errors = []
    for (name, p), q in zip(probabilities.items(), names):
        low, high = F.col(f"_{q}_below") / F.col("events"), F.col(f"_{q}_upto") / F.col("events")
        errors.append(F.greatest(low - F.lit(p), F.lit(p) - high, F.lit(0.0)).alias(f"{name}_error"))
    return ranked.select(*by, "events", *errors)
