"""Connected components of links between rows, on Spark.

Stars are alternately built from larger and smaller neighbours until nothing changes; the
number of rounds grows with the logarithm of the longest chain.  A round is joins and
minima, so a node with many links is combined before shuffling and split by the planner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewindow.session import pin


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang the larger (or the smaller) neighbours of each node below its smallest one."""
    if larger:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = sides.join(least, "a")
    if larger:
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked to, of all nodes in ``edges``.

    ``edges`` has the columns ``a`` and ``b`` of one orderable type; loops and repeats do
    no harm, rows with a null are dropped.
    """
    held = pin(edges.select("a", "b").dropna().filter(F.col("a") != F.col("b")).distinct())
    state = None
    while True:
        held = pin(_star(_star(held, True), False))
        found = held.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    roots = held.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return held.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
