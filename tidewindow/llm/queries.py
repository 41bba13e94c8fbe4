"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidewindow.llm import (
    centroids,
    chat,
    decontaminate,
    htmltext,
    lattice,
    lexical,
    linededup,
    mixing,
    quality,
    rollups,
    simhash,
    suffixdedup,
    wordbpe,
)
from tidewindow.session import pin, run_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered
def op1_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score_documents(table(spark, sf_dir, "documents"))


@registered
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@registered
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, whose texts are control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.format_conversations(rows.unionByName(more)))


@registered
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@registered
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.remove_repeats(table(spark, sf_dir, "documents"))


@registered
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_classes(table(spark, sf_dir, "documents"))


@registered
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_text(table(spark, sf_dir, "pages"))


@registered
def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: all documents come in under the first tokenizer; those
    not in English are revised to the second one, sent twice; and every document whose text
    an earlier id already has is deleted."""
    first, second = "byte_bpe_50k", "byte_bpe_multi_50k"
    counted = pin(rollups.token_counts(
        table(spark, sf_dir, "documents"),
        f"{rollups.FOLDER}/{first}.tiktoken", f"{rollups.FOLDER}/{second}.tiktoken", "en",
    ))

    def image(name: str, tokens: str):
        return rollups.image(F.col("_source"), F.col("_lang"), F.lit(name), F.col(tokens))

    nothing = F.lit(None).cast(rollups.IMAGE)
    revised = F.col("_second").isNotNull()
    inserts = counted.select(nothing.alias("before"), image(first, "_first").alias("after"))
    upgrades = counted.filter(revised).select(
        image(first, "_first").alias("before"), image(second, "_second").alias("after")
    )
    # Pinned, so that the join has plain exchanges and a text of many copies is split.
    kept = pin(counted.groupBy("_same").agg(
        F.min("_doc").alias("_least"), F.count(F.lit(1)).alias("_n")
    ).filter("_n > 1"))
    copies = counted.join(kept, "_same").filter(F.col("_doc") > F.col("_least")).select(
        F.when(revised, image(second, "_second")).otherwise(image(first, "_first")).alias("before"),
        nothing.alias("after"),
    )
    rollup = rollups.Rollup(spark, run_folder(spark, "token-rollup"))
    for batch, changes in ((1, inserts), (2, upgrades), (3, copies), (2, upgrades)):
        rollup.apply(batch, changes)
    return rollup.totals()


@registered
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@registered
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@registered
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_digests(*centroids.cluster_vectors(table(spark, sf_dir, "embeddings")))


@registered
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of the benchmark as a query against all documents."""
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = wordbpe.read_vocabulary(f"{wordbpe.FOLDER}/word_bpe_49k.json")
    encoded = wordbpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary, ["doc_id"])
    return wordbpe.token_digests(wordbpe.decode_documents(encoded, vocabulary))


@registered
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
