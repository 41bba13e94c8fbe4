"""Contract versions of a stored table: which batches were written under which.

A version begins with a batch and holds until the next one begins.  A new version is checked
against every earlier one, since history holds rows of all of them: a change that the last
version allows may still break the reading of the first.  History is read version by version,
each with its own columns and defaults, and then brought to the columns asked for.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewindow.contract import Field, breaking_changes, conform
from tidewindow.sinks.tables import path_exists, write_batch

Contract = tuple[Field, ...]
VERSION_SCHEMA = "fields string, batch_id long"


def as_json(contract: Contract) -> str:
    return json.dumps([
        {"name": f.name, "type": f.dtype.jsonValue(), "required": f.required, "default": f.default}
        for f in contract
    ])


def from_json(text: str) -> Contract:
    def kind(value) -> T.DataType:
        column = {"name": "c", "type": value, "nullable": True, "metadata": {}}
        return T.StructField.fromJson(column).dataType

    return tuple(
        Field(f["name"], kind(f["type"]), f["required"], f["default"]) for f in json.loads(text)
    )


def versions(spark: SparkSession, path: str) -> list[tuple[int, Contract]]:
    """First batch and contract of each version, oldest first: a row for each version."""
    if not path_exists(spark, path):
        return []
    rows = spark.read.schema(VERSION_SCHEMA).parquet(path).orderBy("batch_id").collect()
    return [(r["batch_id"], from_json(r["fields"])) for r in rows]


def broken_versions(known: list[tuple[int, Contract]], new: Contract) -> list[tuple[int, str, str]]:
    """``(first batch, column, rule)`` for what ``new`` breaks of any earlier version."""
    return [(batch, *broken) for batch, old in known for broken in breaking_changes(old, new)]


def begin_version(spark: SparkSession, path: str, batch_id: int, contract: Contract) -> bool:
    """Let ``contract`` hold from a batch on; false if it held before.

    Raises an error that names every change which an earlier version does not survive.
    """
    known = [(batch, old) for batch, old in versions(spark, path) if batch < batch_id]
    broken = broken_versions(known, contract)
    if broken:
        raise ValueError("; ".join(f"{column}: {rule} since batch {batch}" for batch, column, rule in broken))
    if known and known[-1][1] == contract:
        return False
    row = spark.range(1, numPartitions=1).select(F.lit(as_json(contract)).alias("fields"))
    write_batch(row, path, batch_id)
    return True


def read_versions(
    spark: SparkSession, table: str, path: str, contract: Contract | None = None
) -> DataFrame:
    """All batches of ``table``, under the newest contract or the one given, with ``batch_id``.

    Where a version has a default and a row of it no value, the row takes that default; columns
    that its version does not know take those of the contract asked for.
    """
    known = versions(spark, path)
    if not known:
        raise ValueError(f"{path} lists no versions")
    contract = contract or known[-1][1]
    ends = [batch for batch, _ in known[1:]] + [None]
    parts = []
    for (first, own), end in zip(known, ends):
        schema = T.StructType([T.StructField(f.name, f.dtype) for f in own])
        rows = spark.read.schema(schema.add("batch_id", "long")).parquet(table)
        # prunes the folders of other versions
        rows = rows.where(F.col("batch_id") >= first if end is None else F.col("batch_id").between(first, end - 1))
        filled = rows.withColumns({
            f.name: F.coalesce(f.name, F.lit(f.default).cast(f.dtype)) for f in own if f.default is not None
        })
        parts.append(conform(filled, contract, keep=("batch_id",)))
    return reduce(DataFrame.unionByName, parts)
