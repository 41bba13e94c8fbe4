"""Mixing sources to target weights by capped water-filling.

The budget is shared by weight.  A source may not give more than ``max_epochs`` times its
size; what it cannot give goes to the others by weight, until none is above its cap.  That
fixpoint has a closed form: in the order of cap / weight, the first source whose cap lies
above the level that the rest of the budget allows fixes the level for it and all later ones.

A source gives each document ``floor(target / size)`` whole times.  The words still missing
are filled with documents in the order of a seeded hash, up to the one that brings the sum
nearest to the target.  To find that cut without sorting a source in one task, sizes are
added up in 256 ranges of the hash, those of the range with the cut in 256 finer ones, and
only the documents of the last range are put in order.  Each document is then decided by
comparing its hash with its source's cut, so wide rows are never shuffled for the decision.

Defined results: a null text has size 0 and is taken 0 times its words; a null source is a
source of its own and comes last; rows with the same id are taken together; an empty source
has the target 0; no documents give no rows.  Sources are few: they are ordered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewindow.llm.texts import small, whole, word_count
from tidewindow.session import pin

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = 17
#: Hexadecimal digits of the hash that tell its ranges apart, and those added in a level.
RANGE_DIGITS, LEVEL_DIGITS = 4, 2


def seeded_key(doc_id: str, seed: int) -> Column:
    return F.md5(F.concat(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(f":{seed}")
    ).cast("binary"))


def water_fill(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """``_source``, ``source_size`` and ``target`` from ``_source`` and ``source_size``."""
    place = F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())) - 1
    weighed = sources.withColumn(
        "w", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    order = W.orderBy(F.col("cap") / F.col("w"), F.col("_source").asc_nulls_last())
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.lit(budget) * F.sum("source_size").over(everything) - F.coalesce(
        F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    level = left / F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing))
    leveled = weighed.withColumn("level", level).withColumn(
        "level", F.min(F.when(F.col("cap") / F.col("w") > F.col("level"), F.struct(
            (F.col("cap") / F.col("w")).alias("ratio"), F.col("level").alias("level")
        ))).over(everything)["level"]
    )
    return leveled.select(
        "_source", "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(
            F.col("w") * F.col("level"), F.col("cap").cast("double")
        )).alias("target"),
    )


def plan_sources(sized: DataFrame, **fill) -> DataFrame:
    """One row for each source: its size, target, whole repetitions and the cut of the rest.

    ``sized``: rows with ``_source``, ``_size`` and ``_key``.
    """
    filled = water_fill(
        sized.groupBy("_source").agg(F.sum("_size").alias("source_size")), **fill
    ).withColumn(
        "epochs",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0),
    ).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    filled = pin(filled)
    name = filled.withColumnRenamed("_source", "_name")
    same = F.col("_source").eqNullSafe(F.col("_name"))
    running = W.partitionBy("_source").orderBy("_range").rowsBetween(W.unboundedPreceding, 0)
    # The range of each source that holds its cut, and the words before it; narrowed in levels.
    cut = name.select("_name", F.lit("").alias("_at"), F.lit(0).cast("long").alias("_start"), "rest")
    for digits in range(LEVEL_DIGITS, RANGE_DIGITS + 1, LEVEL_DIGITS):
        at = F.substring("_key", 1, digits - LEVEL_DIGITS) == F.col("_at")
        ranges = (
            sized.join(small(cut), same & at)
            .groupBy("_source", F.substring("_key", 1, digits).alias("_range"))
            .agg(F.sum("_size").alias("_words"), F.first("_start").alias("_start"), F.first("rest").alias("rest"))
        )
        upto = F.col("_start") + F.sum("_words").over(running)
        cut = pin(
            ranges.withColumn("_upto", upto)
            .withColumn("_before", F.col("_upto") - F.col("_words"))
            .filter((F.col("_before") < F.col("rest")) & (F.col("_upto") >= F.col("rest")))
            .select(F.col("_source").alias("_name"), F.col("_range").alias("_at"), F.col("_before").alias("_start"), "rest")
        )
    spread = F.substring("_key", 1, RANGE_DIGITS)
    # Equal ids have equal keys and are taken together.
    inside = (
        sized.join(small(cut), same & (spread == F.col("_at")))
        .groupBy("_source", "_at", "_key")
        .agg(F.sum("_size").alias("_words"), F.first("_start").alias("_start"), F.first("rest").alias("rest"))
    )
    upto = F.sum("_words").over(
        W.partitionBy("_source", "_at").orderBy("_key").rowsBetween(W.unboundedPreceding, 0)
    )
    last = (
        inside.withColumn("_upto", F.col("_start") + upto)
        .filter(F.col("_upto") - F.col("_words") / 2 <= F.col("rest"))
        .groupBy("_source", "_at").agg(F.max("_key").alias("_last"))
    )
    cuts = cut.join(
        last.withColumnRenamed("_source", "_s").withColumnRenamed("_at", "_a"),
        F.col("_name").eqNullSafe(F.col("_s")) & (F.col("_at") == F.col("_a")), "left",
    ).select("_name", F.coalesce("_last", F.col("_at")).alias("_cut"))
    # Without a cut the rest is 0: no key is smaller than the empty text.
    return pin(filled.join(cuts, same, "left").select(
        "_source", "source_size", "target", "epochs", F.coalesce("_cut", F.lit("")).alias("_cut")
    ))


def repetitions(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``sized`` with its source's figures and ``copies``, the times each row is taken."""
    by = small(plan).withColumnRenamed("_source", "_name")
    return (
        sized.join(by, F.col("_source").eqNullSafe(F.col("_name")))
        .withColumn("copies", F.col("epochs") + (F.col("_key") <= F.col("_cut")).cast("long"))
        .drop("_name", "epochs", "_cut")
    )


def mix_sources(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
    seed: int = SEED, **fill,
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` of every document."""
    sized = pin(docs.select(
        doc_id, F.col(source).alias("_source"), word_count(whole(text)).alias("_size"),
        seeded_key(doc_id, seed).alias("_key"),
    ))
    return repetitions(sized, plan_sources(sized, **fill)).select(
        doc_id, F.col("_size").alias("size"), "source_size", "target",
        (F.col("_size") * F.col("copies")).alias("taken"),
    )


def mixed(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
    seed: int = SEED, **fill,
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.

    Rows without words have no share in a mix and are left out.
    """
    size, key = word_count(whole(text)), seeded_key(doc_id, seed)
    sized = docs.select(F.col(source).alias("_source"), size.alias("_size"), key.alias("_key"))
    plan = plan_sources(pin(sized), **fill)
    held = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        F.col(source).alias("_source"), size.alias("_size"), key.alias("_key"),
    )
    taken = repetitions(held, plan).filter((F.col("copies") > 0) & (F.col("_size") > 0))
    return taken.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    ).select("_row.*")
