"""Comparing rows within buckets: which rows meet, and how large buckets are split.

Rows with a ``_key`` are dealt out by it and sorted, and a streaming pass keeps those that
meet another row.  A bucket above ``BLOCK_ROWS`` is cut into blocks of rows; each pair of
blocks is a group of its own, so that every pair of rows meets in some group, no group holds
more than two blocks, and a hot key is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewindow.session import pin, shuffle_width

BLOCK_ROWS = 4096


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of runs of one key that begin with a row flagged ``_first`` and hold two ids.

    Sorted by key, ``_first`` descending and ``_id``; only one row is held back.
    """
    held: pa.RecordBatch | None = None  # first row of the open run
    sent = False
    for batch in batches:
        if not batch.num_rows:
            continue
        carried = held is not None
        if carried:
            batch = pa.concat_batches([held, batch])
        key = batch.column("_key").to_numpy()
        first = batch.column("_first").to_numpy(zero_copy_only=False)
        ids = batch.column("_id").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))
        other = ids != ids[starts][run]
        meets = np.bincount(run, other, len(starts)) > 0
        if carried:
            meets[0] |= sent
        keep = (meets & first[starts])[run]
        # Further rows of the first row's id in a run that does not meet yet add nothing.
        held, last = batch.slice(int(starts[-1]), 1), bool(meets[-1])
        if carried and sent:
            keep[0] = False
        sent = last
        if keep.any():
            yield batch.filter(pa.array(keep))


def meeting_rows(keyed: DataFrame) -> DataFrame:
    """Rows of ``_key``, ``_first``, ``_id`` whose key also has a row with another id.

    ``_first`` marks rows that are indexed: a key without one is dropped.
    """
    dealt = keyed.select("_key", "_first", "_id").repartition(shuffle_width(keyed.sparkSession), "_key")
    ordered = dealt.sortWithinPartitions("_key", F.col("_first").desc(), "_id")
    return ordered.mapInArrow(_meeting, ordered.schema)


def grouped(rows: DataFrame, limit: int = BLOCK_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``_group`` and ``_block``, dealt out and sorted by group.

    ``sizes``: ``_key`` and its number of rows ``_n``, if known; else ``rows`` are counted,
    and read twice.

    ``_block`` is 0 in a small bucket.  In a pair of different blocks it tells the two
    apart, and only pairs across them need to be compared.
    """
    spark = rows.sparkSession
    if sizes is None:
        sizes = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    heavy = pin(sizes.filter(F.col("_n") > limit).withColumn("_blocks", F.ceil(F.col("_n") / limit)).drop("_n"))
    same = rows.withColumn("_group", F.struct(F.col("_key"), F.lit(0).alias("a"), F.lit(0).alias("b")))
    out = same.withColumn("_block", F.lit(0))
    if not heavy.isEmpty():
        light = out.join(heavy, "_key", "left_anti")
        mine = F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int")
        split = (
            rows.join(heavy, "_key")
            .withColumn("_block", mine)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), (F.col("_blocks") - 1).cast("int"))))
            .withColumn("_group", F.struct(
                F.col("_key"),
                F.least("_block", "_other").alias("a"), F.greatest("_block", "_other").alias("b"),
            ))
        )
        out = light.unionByName(split.select(light.columns))
    dealt = out.repartition(shuffle_width(spark), "_group")
    return dealt.sortWithinPartitions("_group", "_block", "_id")


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one ``_group`` at a time, from sorted batches."""
    parts: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        if not batch.num_rows:
            continue
        packed = batch.column("_group")
        at = [packed.field(i).to_numpy() for i in range(3)]
        change = np.zeros(batch.num_rows - 1, bool)
        for column in at:
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            here = tuple(int(c[a]) for c in at)
            if here != name and parts:
                yield pa.Table.from_batches(parts)
                parts = []
            name = here
            parts.append(batch.slice(a, b - a))
    if parts:
        yield pa.Table.from_batches(parts)


class Forest:
    """Union-find over the rows of one group."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def link(self, row: int, others: np.ndarray) -> np.ndarray:
        """Join ``others`` to ``row``; returns one of each set that was not joined before."""
        roots, where = np.unique(self.root[others], return_index=True)
        new = roots != self.root[row]
        if new.any():
            joined = np.isin(self.root, roots)
            self.root[joined] = self.root[row]
        return others[where[new]]
