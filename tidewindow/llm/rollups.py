"""Token totals by source, language and tokenizer version, kept up to date by deltas.

A change of a document carries its image before and after: an insert has no before, a
delete no after, a revision has both and may move the document to another group or tokenizer
version.  Each image is one signed row, minus for before and plus for after, and totals are
sums of signed rows, so batches may come in any order.

A batch is reduced to one signed row for each group, written below its id and then
committed by a marker, written last.  A batch that is sent again finds its marker and does
nothing; one that broke off has none, and writing again replaces what it left.  Totals read
committed batches only.  Compaction writes the sum of the committed batches as a snapshot
that lists them.

Defined results: null sources and languages are groups of their own; a null count is 0; a
change without images changes nothing; groups whose documents and tokens are both 0 are
left out of the totals; no batches give no totals.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewindow.llm.arrow import slices, texts

GROUP = ("source", "lang", "tokenizer")
IMAGE = "struct<source:string,lang:string,tokenizer:string,n_tokens:long>"
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
#: Split pattern and files of public tokenizers.
FOLDER = "/opt/tokenizers"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Rollup:
    """Totals in a folder that all executors and later sessions can reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def committed(self, batch: int) -> bool:
        return self._exists(f"{self.folder}/commits/batch={batch}/_SUCCESS")

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Commit a batch of changes with ``before`` and ``after``; false if it was committed."""
        if self.committed(batch):
            return False
        signed_rows(changes).groupBy(*GROUP).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        ).write.mode("overwrite").parquet(f"{self.folder}/deltas/batch={batch}")
        marker = self.spark.range(1).select(F.lit(batch).cast("long").alias("id"))
        marker.write.mode("overwrite").parquet(f"{self.folder}/commits/batch={batch}")
        return True

    def _deltas(self) -> DataFrame:
        """Signed rows of the newest snapshot and the committed batches that it lacks."""
        if not self._exists(f"{self.folder}/commits"):
            return self.spark.createDataFrame([], DELTA)
        commits = self.spark.read.parquet(f"{self.folder}/commits").select(F.col("id").alias("batch"))
        deltas = self.spark.read.schema(f"{DELTA}, batch long").parquet(f"{self.folder}/deltas")
        snapshot = self._newest_snapshot()
        if snapshot is None:
            return deltas.join(commits, "batch", "left_semi").drop("batch")
        listed = self.spark.read.parquet(f"{snapshot}/batches")
        rest = deltas.join(commits.join(listed, "batch", "left_anti"), "batch", "left_semi").drop("batch")
        return rest.unionByName(self.spark.read.parquet(f"{snapshot}/totals"))

    def _newest_snapshot(self) -> str | None:
        """A snapshot counts once its list of batches, written last, is complete."""
        number = 0
        while self._exists(f"{self.folder}/snapshots/{number + 1}/batches/_SUCCESS"):
            number += 1
        return f"{self.folder}/snapshots/{number}" if number else None

    def totals(self) -> DataFrame:
        """``source``, ``lang``, ``tokenizer``, ``n_docs`` and ``n_tokens``."""
        summed = self._deltas().groupBy(*GROUP).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        )
        return summed.filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))

    def compact(self) -> None:
        """Write the totals of all committed batches as one snapshot."""
        last = self._newest_snapshot()
        target = f"{self.folder}/snapshots/{int(last.rsplit('/', 1)[1]) + 1 if last else 1}"
        batches = self.spark.read.parquet(f"{self.folder}/commits").select(F.col("id").alias("batch"))
        # The list is fixed before the sums are taken: a batch committed meanwhile stays out.
        batches.write.mode("overwrite").parquet(f"{target}/listed")
        listed = self.spark.read.parquet(f"{target}/listed")
        deltas = self.spark.read.schema(f"{DELTA}, batch long").parquet(f"{self.folder}/deltas")
        deltas.join(listed, "batch", "left_semi").groupBy(*GROUP).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        ).write.mode("overwrite").parquet(f"{target}/totals")
        listed.write.mode("overwrite").parquet(f"{target}/batches")


def image(source: Column, lang: Column, tokenizer: Column, n_tokens: Column) -> Column:
    return F.struct(
        source.cast("string").alias("source"), lang.cast("string").alias("lang"),
        tokenizer.cast("string").alias("tokenizer"), n_tokens.cast("long").alias("n_tokens"),
    )


def signed_rows(changes: DataFrame) -> DataFrame:
    """One row for each image of each change: -1 document before, +1 after."""
    sides = F.array(
        F.struct(F.lit(-1).cast("long").alias("sign"), F.col("before").cast(IMAGE).alias("of")),
        F.struct(F.lit(1).cast("long").alias("sign"), F.col("after").cast(IMAGE).alias("of")),
    )
    return (
        changes.select(F.explode(sides).alias("x"))
        .filter(F.col("x.of").isNotNull())
        .select(
            "x.of.source", "x.of.lang", "x.of.tokenizer", F.col("x.sign").alias("n_docs"),
            (F.col("x.sign") * F.coalesce("x.of.n_tokens", F.lit(0))).alias("n_tokens"),
        )
    )


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as stored:
        return stored.read()


def encoding_of(ranks: bytes):
    """A byte-level encoding from the lines of a file of ranks."""
    import tiktoken

    pairs = map(bytes.split, ranks.splitlines())
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={}
    )


def load_encoding(path: str):
    return encoding_of(read_ranks(path))


def _counts(shared, own: str):
    def run(batches: Iterator[pa.RecordBatch]):
        encode, other = (encoding_of(ranks).encode_ordinary for ranks in shared.value)
        for batch in slices(batches, "_text"):
            said = texts(batch, "_text")
            lines = [t.decode("utf-8", "replace") for t in said]
            langs = batch.column("_lang").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_doc"), batch.column("_source"), batch.column("_lang"),
                    pa.array([xxhash.xxh3_128_digest(t) for t in said], pa.binary()),
                    pa.array([len(encode(t)) for t in lines], pa.int64()),
                    pa.array([None if g == own else len(other(t)) for t, g in zip(lines, langs)], pa.int64()),
                ],
                ["_doc", "_source", "_lang", "_same", "_first", "_second"],
            )

    return run


def token_counts(
    docs: DataFrame, first: str, second: str, own_lang: str, doc_id: str = "doc_id",
    source: str = "source", lang: str = "lang", text: str = "text",
) -> DataFrame:
    """For each document its tokens by the first tokenizer, and by the second one if its
    language is not ``own_lang``; ``_same`` is equal for equal texts."""
    plain = docs.select(
        F.col(doc_id).alias("_doc"), F.col(source).cast("string").alias("_source"),
        F.col(lang).cast("string").alias("_lang"), F.col(text).cast("binary").alias("_text"),
    )
    kind = docs.schema[doc_id].dataType.simpleString()
    # Read on the driver: executors need not have the files.
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(first), read_ranks(second)))
    return plain.mapInArrow(
        _counts(shared, own_lang),
        f"_doc {kind}, _source string, _lang string, _same binary, _first long, _second long",
    )
