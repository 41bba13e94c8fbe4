"""From raw documents to a training mix, in stages that each read what the one before wrote.

=================  ==================================================================
quality            documents that fail their own rules, or whose host does, go
line_dedup         lines like an earlier line go; documents left without words go
near_dedup         of each group of near-duplicates the smallest id stays
decontaminate      documents that hold benchmark passages go
mix                each source's documents are repeated or left out to meet its target
=================  ==================================================================

Every stage takes the columns of ``documents`` and returns them, with any further columns
of its input.  An empty input passes through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewindow.llm import decontaminate, linededup, mixing, quality, simhash
from tidewindow.session import run_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.without_repeated_lines(docs, length="n_chars", min_bytes=linededup.ALL_LINES)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("decontaminate", benchmark_stage),
    ("mix", mixing_stage),
]

#: Fingerprints and edit distances are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training mix of the ``documents`` in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = run_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
