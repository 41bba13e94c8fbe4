"""Benchmark decontamination: a prefix-filtered join of documents with benchmark windows.

A window is a run of ``window`` words of a benchmark item; an item of fewer words is one
window.  A document word inside any occurrence of a window is hit.

Words are ordered by rarity, counted over all documents.  A window must be contained whole,
so the necessary prefix of its word set is one word: its rarest.  Only at document words
that are some window's prefix word is anything compared.  The place of that word in the
window fixes where the window would begin, and the bounds drop it if it would begin before
the document or end after it.  What is left is verified word by word.

The benchmark is a query set that is held against all documents in blocks.  A block is
closed when its words reach ``block_bytes``, and only a block is ever on the driver or broadcast:
it is dropped when its pass is done.  One block is one pass and no shuffle.  With more blocks the
spans of the documents that a pass hit are pinned, and put together by document in the end.

Defined results: a null text or one without words is not hit; a null item or one without
words has no window; equal windows of several items count for each of them; a null item id
reads as the empty string; repeated rows return as often as they occur, each with the same
result; an empty benchmark hits nothing.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewindow.llm.arrow import slices, texts
from tidewindow.session import pin

WINDOW = 13
BLOCK_BYTES = 32 << 20
MIN_SHARE = 20
#: Windows that are compared in one step.
WINDOWS_AT_ONCE = 1 << 20

# Upper case to lower case; what is no digit, letter or non-ASCII byte to a space.
_FOLD = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def split_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class WindowIndex:
    """The windows of one block of items, found by their rarest word."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.items = [name for name, _ in items]
        found: dict[tuple[int, ...], set[int]] = {}
        number = self.vocabulary.setdefault
        for i, (_, words) in enumerate(items):
            ids = [number(w, len(self.vocabulary)) for w in words]
            width = min(window, len(ids))
            for start in range(len(ids) - width + 1):
                found.setdefault(tuple(ids[start : start + width]), set()).add(i)
        self.owners = [sorted(x) for x in found.values()]
        self.length = np.array([len(w) for w in found], np.int64)
        self.ids = np.full((len(found), window), -1, np.int32)
        for row, w in enumerate(found):
            self.ids[row, : len(w)] = w

    def order(self, counts: np.ndarray) -> None:
        """Choose each window's prefix word by the counts of the words in the documents."""
        held = self.ids >= 0
        rarity = np.where(held, counts[np.where(held, self.ids, 0)], np.iinfo(np.int64).max)
        self.place = rarity.argmin(axis=1)
        prefix = self.ids[np.arange(len(self.ids)), self.place]
        self.by_prefix = np.argsort(prefix, kind="stable")
        size = len(self.vocabulary)
        self.first = np.searchsorted(prefix[self.by_prefix], np.arange(size))
        # The last entry stands for all words that are in no window.
        self.fanout = np.append(np.bincount(prefix, minlength=size), 0)

    def numbers(self, docs: list[list[bytes]]) -> np.ndarray:
        """Word numbers of all documents in a row; -1 for words in no window."""
        get = self.vocabulary.get
        total = sum(map(len, docs))
        return np.fromiter((get(w, -1) for d in docs for w in d), np.int32, total)

    def match(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and window numbers of all occurrences; ``ends``: of each word's document."""
        starts_of = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        at = np.flatnonzero(self.fanout[ids])
        found = [(at[:0], at[:0])]
        # A word may begin many windows: places are taken on while their windows fit a step.
        upto = np.cumsum(self.fanout[ids[at]])
        begin = 0
        while begin < len(at):
            before = upto[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, before + WINDOWS_AT_ONCE, "right")))
            found.append(self._match(ids, ends, starts_of, at[begin:end]))
            begin = end
        return tuple(np.concatenate(part) for part in zip(*found))

    def _match(
        self, ids: np.ndarray, ends: np.ndarray, starts_of: np.ndarray, at: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        fanout = self.fanout[ids[at]]
        nth = np.arange(fanout.sum()) - np.repeat(np.cumsum(fanout) - fanout, fanout)
        windows = self.by_prefix[np.repeat(self.first[ids[at]], fanout) + nth]
        at = np.repeat(at, fanout)
        doc = np.searchsorted(ends, at, "right")
        start = at - self.place[windows]
        inside = (start >= starts_of[doc]) & (start + self.length[windows] <= ends[doc])
        start, windows = start[inside], windows[inside]
        for k in range(self.window):
            same = (self.length[windows] <= k) | (
                ids[np.minimum(start + k, len(ids) - 1)] == self.ids[windows, k]
            )
            start, windows = start[same], windows[same]
        return start, windows


def item_blocks(
    benchmark: DataFrame, item_id: str, text: str, window: int, block_bytes: int
) -> Iterator[WindowIndex]:
    """The benchmark in blocks of bounded size, read one partition at a time."""
    rows = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"),
        F.col(text).cast("binary").alias("t"),
    ).filter("t IS NOT NULL")
    items, size = [], 0
    for row in rows.toLocalIterator():
        if words := split_words(bytes(row["t"])):
            items.append((row["i"], words))
            size += len(row["t"])
        if size >= block_bytes:
            yield WindowIndex(items, window)
            items, size = [], 0
    if items:
        yield WindowIndex(items, window)


def _count_words(shared):
    def run(batches):
        index, counts = shared.value, None
        counts = np.zeros(len(index.vocabulary) + 1, np.int64)
        for batch in slices(batches, "t"):
            docs = [split_words(t) for t in texts(batch, "t")]
            counts += np.bincount(index.numbers(docs) + 1, minlength=len(counts))
        at = np.flatnonzero(counts[1:])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[1:][at])], ["w", "n"])

    return run


def _find(shared, carried: list[str], only_hit: bool):
    """Rows of the carried columns, ``n_words``, merged hit spans and item ids."""

    def run(batches):
        index = shared.value if shared else WindowIndex([], WINDOW)
        if not shared:
            index.order(np.zeros(0, np.int64))
        for batch in slices(batches, "t"):
            docs = [split_words(t) for t in texts(batch, "t")]
            n_words = np.fromiter(map(len, docs), np.int64, len(docs))
            ends = np.cumsum(n_words)
            start, windows = index.match(index.numbers(docs), ends)
            spans: list[list[dict]] = [[] for _ in docs]
            items: list[list[str]] = [[] for _ in docs]
            if len(start):
                delta = np.zeros(int(ends[-1]) + 1, np.int32)
                np.add.at(delta, start, 1)
                np.add.at(delta, start + index.length[windows], -1)
                hit = np.concatenate([[False], np.cumsum(delta[:-1]) > 0, [False]])
                # Runs of hit words never join two documents: cut them at the ends.
                bounds = np.unique(np.concatenate([
                    np.flatnonzero(hit[1:] != hit[:-1]), ends[(ends > 0) & (ends < ends[-1])]
                ]))
                doc_of = np.searchsorted(ends, bounds, "right")
                first = ends - n_words
                for a, b, d in zip(bounds[:-1], bounds[1:], doc_of[:-1]):
                    if hit[a + 1]:
                        spans[d].append({"s": int(a - first[d]), "e": int(b - first[d])})
                owned: dict[int, set[int]] = {}
                for d, w in zip(np.searchsorted(ends, start, "right"), windows):
                    owned.setdefault(int(d), set()).update(index.owners[w])
                for d, found in owned.items():
                    items[d] = sorted({index.items[i] for i in found})
            keep = [i for i, s in enumerate(spans) if s or not only_hit]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(keep, pa.int64())) for c in carried] + [
                    pa.array([int(n_words[i]) for i in keep], pa.int64()),
                    pa.array([spans[i] for i in keep], pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                    pa.array([items[i] for i in keep], pa.list_(pa.string())),
                ],
                [*carried, "n_words", "spans", "items"],
            )

    return run


_FOUND = "n_words long, spans array<struct<s:long,e:long>>, items array<string>"


def _hit_words(spans: Column) -> Column:
    """Number of words in spans that may overlap."""
    zero = F.lit(0).cast("long")
    return F.aggregate(
        F.sort_array(spans),
        F.struct(zero.alias("n"), zero.alias("upto")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(zero, x["e"] - F.greatest(x["s"], a["upto"]))).alias("n"),
            F.greatest(a["upto"], x["e"]).alias("upto"),
        ),
        lambda a: a["n"],
    )


def _result(found: DataFrame, carried: list[str]) -> DataFrame:
    names = F.array_sort(F.array_distinct("items"))
    n_hit = _hit_words(F.col("spans"))
    return found.select(
        *(F.col(f"`{c}`") for c in carried), "n_words", n_hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (MIN_SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES, carry: list[str] | None = None,
) -> DataFrame:
    """``doc_id`` (or the ``carry`` columns), ``n_words``, ``n_hit``, ``n_items``,
    ``items_sha256`` and ``contaminated`` of every document."""
    spark = docs.sparkSession
    carried = carry or [doc_id]
    body = F.col(text).cast("binary").alias("t")
    own = [docs.schema[c] for c in carried]
    found_fields = T.StructType.fromDDL(_FOUND).fields
    plain = docs.select(*(F.col(f"`{c}`") for c in carried), body)

    def ordered(index: WindowIndex):
        """The block, broadcast, with its words in the order of their counts in ``docs``."""
        first = spark.sparkContext.broadcast(index)
        counted = docs.select(body).mapInArrow(_count_words(first), "w long, n long")
        counts = np.zeros(len(index.vocabulary), np.int64)
        for row in counted.groupBy("w").agg(F.sum("n").alias("n")).collect():  # the block's words
            counts[row["w"]] = row["n"]
        first.unpersist()
        index.order(counts)
        return spark.sparkContext.broadcast(index)

    blocks = item_blocks(benchmark, item_id, item_text, window, block_bytes)
    index, following = next(blocks, None), next(blocks, None)
    if following is None:
        find = _find(ordered(index) if index else None, carried, False)
        return _result(plain.mapInArrow(find, T.StructType([*own, *found_fields])), carried)
    # Equal rows have equal results, so a row is known by its columns and its text.
    digest = F.sha2(F.coalesce("t", F.lit(b"")), 256).alias("_text")
    keyed = plain.select(*carried, digest, "t")
    schema = T.StructType([*own, T.StructField("_text", T.StringType()), *found_fields])
    one = None
    while index is not None:
        shared = ordered(index)
        hits = keyed.mapInArrow(_find(shared, [*carried, "_text"], True), schema)
        part = pin(hits.select("_text", "spans", "items"))
        shared.unpersist()
        one = part if one is None else one.unionByName(part)
        index, following = following, next(blocks, None)
    joined = one.groupBy("_text").agg(
        F.flatten(F.collect_set("spans")).alias("spans"), F.flatten(F.collect_set("items")).alias("items")
    )
    sized = keyed.mapInArrow(_find(None, [*carried, "_text"], False), schema)
    both = sized.drop("spans", "items").join(joined, "_text", "left")
    empty = F.array().cast("array<struct<s:long,e:long>>"), F.array().cast("array<string>")
    return _result(both.select(
        *carried, "n_words", F.coalesce("spans", empty[0]).alias("spans"),
        F.coalesce("items", empty[1]).alias("items"),
    ), carried)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns only."""
    held = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(text).alias("_body")
    )
    found = find_contamination(held, benchmark, text="_body", carry=["_row"], **options)
    return found.filter(~F.col("contaminated")).select("_row.*")
