"""Running minima and maxima that never order event-sized data in one task."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewindow.session import BROADCAST_BYTES, pin, shuffle_width


def row_bytes(kind: T.DataType, value: Column) -> Column:
    """About the size of a value in a broadcast table."""
    if isinstance(kind, T.StructType):
        parts = (row_bytes(f.dataType, value[f.name]) for f in kind.fields)
        return reduce(lambda a, b: a + b, parts, F.lit(16))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(value), F.lit(0))
    return F.lit(8)


def join_sized(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "left",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Equi-join that broadcasts ``small`` only after measuring it.

    ``small`` is pinned first, so the measure and the join see the same rows.  Above
    the limit the join shuffles and skewed keys are left to AQE.
    """
    return big.join(measured(pin(small), limit), list(on), how)


def measured(pinned: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A pinned table, marked for broadcast if it is at most ``limit`` bytes."""
    size = row_bytes(pinned.schema, F.struct(*pinned.columns))
    fits = (pinned.agg(F.sum(size)).first()[0] or 0) <= limit
    return F.broadcast(pinned) if fits else pinned


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` in which null equals null."""
    own = {name: f"_same_{name}" for name in on}
    matches = [F.col(name).eqNullSafe(F.col(other)) for name, other in own.items()]
    return left.join(right.withColumnsRenamed(own), matches, how).drop(*own.values())


def total_order(first: Column, names: Sequence[str]) -> Column:
    """A number that orders rows by ``first``, a long, and then by a hash of ``names``.

    It has a fixed width, so a minimum or maximum over it is a hash aggregate, and only
    equal rows have equal numbers.
    """
    place = F.coalesce(first, F.lit(-1)).cast("decimal(18,0)")
    return (place * F.expr(f"{2**64}BD") + F.xxhash64(*names)).cast("decimal(38,0)")


def by_day(table: DataFrame, at: str) -> DataFrame:
    """Bring the rows of a day together; meant for tables of a few rows per minute."""
    return table.withColumn("_day", F.unix_date(F.to_date(at))).repartition("_day")


def running_over_time(
    dated: DataFrame, at: str, value: str, out: str, largest: bool
) -> DataFrame:
    """Running maximum in time order, or running minimum in reverse time order.

    ``dated`` comes from ``by_day`` and has one row per minute ``at``, so a day is at
    most 1,440 rows; only the day totals are ordered as a whole.  The running value
    includes the row itself.
    """
    fold, pick = (F.max, F.greatest) if largest else (F.min, F.least)
    order = (lambda c: F.col(c).asc()) if largest else (lambda c: F.col(c).desc())
    earlier_days = Window.orderBy(order("_day")).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        dated.groupBy("_day")
        .agg(fold(value).alias("_day_value"))
        .select("_day", fold("_day_value").over(earlier_days).alias("_carried"))
    )
    in_day = (
        Window.partitionBy("_day")
        .orderBy(order(at))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        dated.join(carried, "_day")
        .withColumn(out, pick(F.col("_carried"), fold(value).over(in_day)))
        .drop("_day", "_carried")
    )


def even_ranges(
    df: DataFrame, order: Sequence[str], number: str = "_number", pinned: bool = True
) -> DataFrame:
    """Range partitions of even size, also when a third of all rows are exact copies.

    Rows equal in ``order`` are told apart by a number given to each row.  The
    numbered rows are pinned, so a task that is run again finds the same numbers;
    rows that come from files in their own order are numbered alike without it.
    """
    numbered = df.withColumn(number, F.monotonically_increasing_id())
    if pinned:
        numbered = pin(numbered)
    return numbered.repartitionByRange(shuffle_width(df.sparkSession), *order, number)


#: Rows of a slice of an order: as many as give each shuffle partition one, within these bounds;
#: more of them only beyond so many slices.
LEAST_ROWS, SLICE_ROWS, MOST_SLICES = 1 << 12, 1 << 20, 1 << 16
#: Rows that are sampled for each slice.
SAMPLES = 8
#: Keys of a block of the search for a slice.
FAN = 32


def _search_key(df: DataFrame, order: Sequence[str]) -> tuple[Column, str]:
    """A struct that orders rows as the columns do, of numbers and strings, and its type."""
    kinds = dict(df.dtypes)
    plain, types = [], []
    for i, name in enumerate(order):
        kind = kinds[name]
        if kind == "timestamp":
            column, kind = F.unix_micros(name), "bigint"
        elif kind == "timestamp_ntz":
            column, kind = F.col(name).cast("string"), "string"  # orders alike
        elif kind == "date":
            column, kind = F.unix_date(name), "int"
        else:
            column = F.col(name)
        plain.append(column.alias(f"k{i}"))
        types.append(f"k{i}:{kind}")
    return F.struct(*plain), f"struct<{','.join(types)}>"


def _constant(value, kind: str) -> Column:
    """A nested value as one literal of the plan."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def keys_below(key: Column, keys: list[dict], kind: str) -> Column:
    """How many of the sorted ``keys`` are less than ``key``: a search through blocks of blocks."""
    levels = [keys]
    while len(levels[-1]) > FAN:
        levels.append([*levels[-1][FAN - 1 :: FAN]])  # the last key of each whole block
    def search(table: Column):
        def within_block(at: Column) -> Column:
            block = F.coalesce(F.get(table, at), F.array().cast(f"array<{kind}>"))
            return at * FAN + F.size(F.filter(block, lambda k: k < key))

        return within_block

    place = F.lit(0)
    for level in reversed(levels):
        blocks = [level[i : i + FAN] for i in range(0, len(level), FAN)]
        # in a lambda, so that the place of the level above is computed once
        table = _constant(blocks, f"array<array<{kind}>>")
        place = F.get(F.transform(F.array(place), search(table)), 0)
    return F.least(place, F.lit(len(keys)))


def slice_of(numbered: DataFrame, order: Sequence[str], number: str, rows: int) -> Column:
    """The slice of each row, as an expression: slices follow one another in the order.

    Bounds come from one sorted sample.  A key that fills several slices, of exact copies, is a
    bound several times; its rows are dealt to those slices by their number.
    """
    even = -(-rows // shuffle_width(numbered.sparkSession))
    size = max(min(SLICE_ROWS, max(LEAST_ROWS, even)), -(-rows // MOST_SLICES))
    single = F.when(F.col(number) < 0, 1).otherwise(0)  # no constant, which a plan would cross
    if rows <= size:
        return single
    key, kind = _search_key(numbered, order)
    some = F.pmod(F.xxhash64(number), F.lit(max(1, size // SAMPLES))) == 0
    # so many rows for each slice
    sample = numbered.where(some).select(key.alias("k")).orderBy("k").collect()
    bounds = [r["k"].asDict() for r in sample[SAMPLES - 1 :: SAMPLES]]
    keys, first, times = [], [], []
    for at, bound in enumerate(bounds):
        if keys and keys[-1] == bound:
            times[-1] += 1
        else:
            keys.append(bound)
            first.append(at)
            times.append(1)
    if not keys:
        return single
    blocks = [keys[i : i + FAN] for i in range(0, len(keys), FAN)]
    table = _constant(blocks, f"array<array<{kind}>>")

    def dealt(place: Column) -> Column:
        bound = F.get(F.get(table, F.floor(place / FAN).cast("int")), place % FAN)
        start = F.get(_constant([*first, len(bounds)], "array<int>"), place)
        spread = F.get(_constant([*times, 0], "array<int>"), place) + 1
        return start + F.when(bound == key, F.pmod(F.xxhash64(number), spread)).otherwise(0).cast("int")

    return F.get(F.transform(F.array(keys_below(key, keys, kind)), dealt), 0)


def running_max_before(
    points: DataFrame, order: Sequence[str], value: str, out: str
) -> DataFrame:
    """For each row the largest ``value`` of all rows before it in ``order``.

    Rows are cut into even slices of the order, so one hot instant spreads over many
    slices, and so does a group of exact copies.  The slice is an expression on the row, so
    the rows cross the network once, to be ordered within their slice; what is carried
    from slice to slice is one row per slice.  Rows equal in the order are told apart by a
    number; the numbered rows are pinned, so that all passes see the same ones.
    """
    numbered = pin(points.withColumn("_number", F.monotonically_increasing_id()))
    sliced = numbered.withColumn("_slice", slice_of(numbered, order, "_number", numbered.count()))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy("_slice")
        .agg(F.max(value).alias("_slice_value"))
        .select("_slice", F.max("_slice_value").over(earlier).alias("_carried"))
    )
    within = (
        Window.partitionBy("_slice")
        .orderBy(*order, "_number")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # one row per slice, at most MOST_SLICES and a few
    return (
        sliced.withColumn("_within", F.max(value).over(within))
        .join(F.broadcast(carried), "_slice")
        .withColumn(out, F.greatest(F.col("_carried"), F.col("_within")))
        .drop("_slice", "_carried", "_within", "_number")
    )


def exact_quantiles(
    df: DataFrame, value: str, by: Sequence[str], probabilities: dict[str, float]
) -> DataFrame:
    """Interpolated quantiles of a whole-number column, with row count and maximum.

    Values are counted first, so a group is its distinct values; these are ranked in
    blocks of 65,536 neighbouring values, and blocks are ranked by their totals.
    """
    by = list(by)
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("long").alias("_v"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_block", F.shiftright("_v", 16))
    )
    earlier_blocks = (
        Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    everything = Window.partitionBy(*by)
    blocks = (
        counted.groupBy(*by, "_block")
        .agg(F.sum("_n").alias("_in_block"))
        .select(
            *by,
            "_block",
            F.coalesce(F.sum("_in_block").over(earlier_blocks), F.lit(0)).alias("_carried"),
            F.sum("_in_block").over(everything).alias("_total"),
        )
    )
    in_block = (
        Window.partitionBy(*by, "_block")
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = join_same(counted, blocks, [*by, "_block"]).withColumn(
        "_upto", F.col("_carried") + F.sum("_n").over(in_block)
    )

    def value_at(rank: Column) -> Column:
        holds = (rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto"))
        return F.max(F.when(holds, F.col("_v")))

    found = {}
    for name, p in probabilities.items():
        place = (F.col("_total") - 1) * F.lit(p)
        found[f"_{name}_low"] = value_at(F.floor(place))
        found[f"_{name}_high"] = value_at(F.ceil(place))
    summary = ranked.groupBy(*by).agg(
        F.sum("_n").alias("events"),
        F.max("_v").alias(f"max_{value}"),
        *[column.alias(name) for name, column in found.items()],
    )
    place = {name: (F.col("events") - 1) * F.lit(p) for name, p in probabilities.items()}
    return summary.select(
        *by,
        "events",
        *[
            F.round(
                F.col(f"_{name}_low")
                + (F.col(f"_{name}_high") - F.col(f"_{name}_low"))
                * (place[name] - F.floor(place[name])),
                6,
            ).alias(f"{name}_{value}")
            for name in probabilities
        ],
        f"max_{value}",
    )
