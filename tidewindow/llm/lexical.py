"""Ranked lexical search over a length-stratified index.

A document's normaliser m is a whole number that depends on its number of terms alone.  Documents
of equal m are a stratum.  In a stratum the postings of a term are kept by tf, so all
documents of one posting run add the same impact to a score, and impacts are computed once per tf and
not per document.  A large stratum is cut into parts of about ``PART_TERMS`` terms by the number of
the row, so copies of a document, or rows that share an id, do not meet in one part.

A part is one row of the index: its documents in the order of their ids, its terms, and for each
term its document count and its posting runs, tf ascending.  The index holds every term of every document
that has one.  It is written as a table and can be searched again and again.

Search.  Items are taken in blocks of ``BLOCK_BYTES`` of terms, each held against all documents.  The
highest tf of a term in a part bounds what it can add there; summed over an item's terms, it bounds
the scores of the part.  First each item is held against the one part with its highest bound in the
whole index; the k-th score found is the least that counts.  Then every task visits its parts in the
order of bounds, for each item until a bound is below the least score that counts, which rises on the
way.  Parts are left out by their bounds alone, so the result is that of scoring all documents.

The driver holds the terms, weights and least scores of one block of items, and broadcasts them;
results are written block by block.

Scores are whole numbers: w * ((10^9 tf) div (1000 tf + 8 m)), summed over an item's terms, each
taken once, where w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 10 + (90 n N) div L.

Defined results: null texts and texts without terms are no documents and match nothing; an item
without terms has no rows; repeated items are items of their own, with a row for each rank; repeated
documents are documents of their own, and equal scores are ranked by ascending id, null first.
Clashing or further columns do no harm.  Documents are numbered by ``monotonically_increasing_id``:
read them from files or a pinned table, so that a task that runs again finds the same numbers.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewindow.llm.arrow import slices
from tidewindow.operators.ordered import measured
from tidewindow.session import pin, run_folder, shuffle_width

TOP = 10
#: About as many terms are a part of a large stratum.
PART_TERMS = 1 << 16
#: Bytes of terms of a block of items, counted with 16 more for each term.
BLOCK_BYTES = 4 << 20
#: Bytes of index rows that are written out together.
WRITTEN_BYTES = 4 << 20

# A term is a run of ASCII letters and digits and of anything beyond ASCII.
LOWERED = re.compile(rb"[0-9a-z\x80-\xff]+")
IN_TERM = np.array([chr(b).isalnum() or b >= 0x80 for b in range(256)])


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8; only A-Z are lowered."""
    return LOWERED.findall(text.lower())


def term_counts(texts: pa.Array) -> np.ndarray:
    """Number of terms of each text of a binary column."""
    _, ends, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    ends = np.frombuffer(ends, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
    inside = IN_TERM[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    # A term that begins a text may stand right behind one that ends the text before.
    begins = ends[:-1][np.diff(ends) > 0] - ends[0]
    first[begins] = inside[begins]
    return np.diff(np.searchsorted(np.flatnonzero(first), ends - ends[0]))


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


# ---- index


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of this task have how many terms, of those that have any."""
    found: Counter[int] = Counter()
    for part in slices(batches, "_text"):
        number, times = np.unique(term_counts(part.column("_text")), return_counts=True)
        found.update(dict(zip(number.tolist(), times.tolist())))
    found.pop(0, None)
    yield pa.RecordBatch.from_arrays(
        [pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.int64())], ["_n", "_docs"]
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts that have terms, with their number."""
    for part in slices(batches, "_text"):
        number = term_counts(part.column("_text"))
        some = pa.array(np.flatnonzero(number))
        yield part.append_column("_n", pa.array(number.astype(np.int64))).take(some)


def _part_row(m: int, part: int, texts: list[bytes]) -> tuple[dict[str, np.ndarray | list], int]:
    """Posting runs of one part; documents are named by their places."""
    numbers: dict[bytes, int] = {}
    found: list[int] = []
    tfs: list[int] = []
    sizes = []
    for text in texts:
        counts = Counter(terms_of(text))
        found += [numbers.setdefault(t, len(numbers)) for t in counts]
        tfs += counts.values()
        sizes.append(len(counts))
    terms = sorted(numbers)
    rank = np.empty(len(terms), np.int64)
    rank[[numbers[t] for t in terms]] = np.arange(len(terms))
    term, tf = rank[found], np.array(tfs, np.int32)
    place = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    order = np.lexsort((place, tf, term))
    term, tf, place = term[order], tf[order], place[order]
    first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])]))
    row = {
        "m": m, "part": part, "terms": terms,
        "dfs": np.bincount(term, minlength=len(terms)).astype(np.int32),
        "runs": np.bincount(term[first], minlength=len(terms)).astype(np.int32),
        "tfs": tf[first], "sizes": np.diff(np.append(first, len(term))).astype(np.int32),
        "places": place,
    }
    return row, 4 * len(place) + 8 * len(first) + 24 * len(terms)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes], pa.Array]]:
    """The texts and ids of one part at a time, from sorted batches."""
    name, texts, ids = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        m, part = (batch.column(c).to_numpy() for c in ("m", "part"))
        cuts = np.flatnonzero((m[1:] != m[:-1]) | (part[1:] != part[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            here = (int(m[a]), int(part[a]))
            if name is not None and here != name:
                yield *name, texts, pa.concat_arrays(ids)
                texts, ids = [], []
            name = here
            texts += batch.column("_text").slice(a, b - a).to_pylist()
            ids.append(batch.column("_id").slice(a, b - a))
    if name is not None:
        yield *name, texts, pa.concat_arrays(ids)


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    if kind == pa.binary():
        flat = pa.array([t for terms in values for t in terms], kind)
    else:
        flat = pa.array(np.concatenate(values).astype(np.int32))
    return pa.ListArray.from_arrays(pa.array(ends), flat)


NUMBERS = ("dfs", "runs", "tfs", "sizes", "places")


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, docs, size = [], [], 0

    def written() -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, docs)]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r["m"] for r in rows], pa.int64()), pa.array([r["part"] for r in rows], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(docs)),
                _lists([r["terms"] for r in rows], pa.binary()),
                *(_lists([r[c] for r in rows], pa.int32()) for c in NUMBERS),
            ],
            ["m", "part", "docs", "terms", *NUMBERS],
        )

    for m, part, texts, ids in _parts(batches):
        row, grown = _part_row(m, part, texts)
        rows.append(row)
        docs.append(ids)
        size += grown
        if size >= WRITTEN_BYTES:
            yield written()
            rows, docs, size = [], [], 0
    if rows:
        yield written()


class Index(NamedTuple):
    """A table with one row for each part of a stratum, and the number of documents."""

    parts: DataFrame
    n_docs: int


def build_index(
    docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text",
    part_terms: int = PART_TERMS,
) -> Index | None:
    """Write the index of ``docs`` to ``folder``, which all executors reach; None without terms."""
    spark = docs.sparkSession
    whole = docs.select(
        F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").cast("binary").alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    lengths = pin(whole.select("_text").mapInArrow(_lengths, "_n long, _docs long").groupBy("_n").agg(
        F.sum("_docs").alias("_docs")
    ))
    n_docs, n_terms = lengths.agg(F.sum("_docs"), F.sum(F.col("_n") * F.col("_docs"))).first()
    if not n_docs:
        return None

    def normaliser(n: str) -> Column:
        # in decimals, as the product may not fit 64 bits
        return F.expr(f"10 + (90BD * CAST({n} AS DECIMAL(18,0)) * {n_docs}BD) div {n_terms}BD")

    strata = lengths.groupBy(normaliser("_n").alias("m")).agg(
        F.ceil(F.sum(F.col("_n") * F.col("_docs")) / part_terms).cast("long").alias("_parts")
    )
    counted = whole.mapInArrow(_counted, T.StructType([*whole.schema.fields]).add("_n", "long"))
    dealt = counted.withColumn("m", normaliser("_n")).join(measured(pin(strata)), "m").select(
        "m", F.pmod(F.xxhash64("_row"), F.col("_parts")).alias("part"), "_id", "_row", "_text"
    )
    ordered = dealt.repartition(shuffle_width(spark), "m", "part").sortWithinPartitions("m", "part", "_id", "_row")
    ints = T.ArrayType(T.IntegerType())
    kind = T.StructType([
        T.StructField("m", T.LongType()), T.StructField("part", T.LongType()),
        T.StructField("docs", T.ArrayType(whole.schema["_id"].dataType)),
        T.StructField("terms", T.ArrayType(T.BinaryType())),
        *(T.StructField(c, ints) for c in NUMBERS),
    ])
    ordered.drop("_row").mapInArrow(_index_rows, kind).write.parquet(folder)
    return Index(spark.read.schema(kind).parquet(folder), n_docs)


# ---- search


class Block(NamedTuple):
    """Items of a block: their terms by number, where each begins, weights and least scores."""

    names: np.ndarray
    vocabulary: pa.Array
    weights: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    least: np.ndarray

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per item the sum of its terms' values."""
        upto = np.concatenate([[0], np.cumsum(values[self.terms])])
        return upto[self.starts[1:]] - upto[self.starts[:-1]]


class _Part:
    """One part of a stratum, opened as far as a block of items needs it."""

    def __init__(self, row: dict[str, np.ndarray], m: int, block: Block, at: np.ndarray):
        self.row, self.block = row, block
        self.known = np.flatnonzero(at >= 0)
        self.number = at[self.known]
        self.run_ends = np.concatenate([[0], np.cumsum(row["runs"])])
        tf, back = np.unique(row["tfs"], return_inverse=True)
        self.run_impacts = impacts(tf.astype(np.int64), m)[back]  # once per tf
        highest = np.zeros(len(block.weights), np.int64)
        highest[self.number] = self.run_impacts[self.run_ends[self.known + 1] - 1]
        self.bounds = block.sums(highest * block.weights)
        self.opened = False

    def _open(self) -> None:
        sizes = self.row["sizes"]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        self.impacts = np.repeat(self.run_impacts, sizes)
        self.begin, self.end = np.zeros((2, len(self.block.weights)), np.int64)
        self.begin[self.number] = ends[self.run_ends[self.known]]
        self.end[self.number] = ends[self.run_ends[self.known + 1]]
        self.opened = True

    def best(self, item: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents of at least a score."""
        if not self.opened:
            self._open()
        block, places = self.block, self.row["places"]
        scores = np.zeros(self.row["docs"], np.int64)
        for term in block.terms[block.starts[item] : block.starts[item + 1]]:
            a, b = self.begin[term], self.end[term]
            # a document has a term in one run only, so places do not repeat here
            scores[places[a:b]] += self.impacts[a:b] * block.weights[term]
        found = np.flatnonzero(scores >= least)
        if len(found) > k:
            cut = np.partition(scores[found], len(found) - k)[len(found) - k]
            above = found[scores[found] > cut]
            found = np.concatenate([above, found[scores[found] == cut][: k - len(above)]])
        return found, scores[found]


def _opened(batch: pa.RecordBatch, block: Block) -> list[_Part]:
    terms = batch.column("terms")
    at = pc.fill_null(pc.index_in(terms.values, value_set=block.vocabulary), -1).to_numpy()
    ends = np.asarray(terms.offsets)
    columns = {}
    for name in ("runs", "tfs", "sizes", "places"):
        if name in batch.schema.names:
            column = batch.column(name)
            columns[name] = (column.values.to_numpy(), np.asarray(column.offsets))
    docs = np.diff(np.asarray(batch.column("docs").offsets)) if "docs" in batch.schema.names else None
    m = batch.column("m").to_numpy()
    out = []
    for i in range(batch.num_rows):
        row = {name: flat[o[i] : o[i + 1]] for name, (flat, o) in columns.items()}
        if docs is not None:
            row["docs"] = int(docs[i])
        out.append(_Part(row, int(m[i]), block, at[ends[i] : ends[i + 1]]))
    return out


def _best_parts(shared):
    """For each item the part with the highest bound in this task."""

    def run(batches):
        block: Block = shared.value
        bound = np.zeros(len(block.names), np.int64)
        where = np.zeros((2, len(block.names)), np.int64)
        for batch in batches:
            names = np.stack([batch.column(c).to_numpy() for c in ("m", "part")])
            for i, part in enumerate(_opened(batch, block)):
                higher = part.bounds > bound
                bound[higher] = part.bounds[higher]
                where[:, higher] = names[:, i : i + 1]
        some = np.flatnonzero(bound)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.names[some]), pa.array(bound[some]), pa.array(where[0, some]), pa.array(where[1, some])],
            ["_item", "_bound", "m", "part"],
        )

    return run


def _search(shared, k: int):
    """Each item's documents that may be among its best ones."""

    def run(batches):
        block: Block = shared.value
        least = np.maximum(block.least, 1)
        kept: list[np.ndarray] = [np.zeros(0, np.int64)] * len(block.names)
        for batch in batches:
            parts = _opened(batch, block)
            if not parts:
                continue
            bounds = np.stack([p.bounds for p in parts])
            docs = batch.column("docs")
            starts = np.asarray(docs.offsets)
            items, at, scores = [], [], []
            for item in np.flatnonzero((bounds >= least).any(axis=0)):
                for i in np.argsort(-bounds[:, item], kind="stable"):
                    if bounds[i, item] < least[item]:
                        break
                    places, found = parts[i].best(item, k, int(least[item]))
                    items.append(np.full(len(places), item))
                    at.append(starts[i] + places)
                    scores.append(found)
                    kept[item] = np.sort(np.concatenate([kept[item], found]))[-k:]
                    if len(kept[item]) == k:
                        least[item] = max(least[item], kept[item][0])
            if not items:
                continue
            item, place, score = map(np.concatenate, (items, at, scores))
            still = score >= least[item]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.names[item[still]]), docs.values.take(pa.array(place[still])), pa.array(score[still])],
                ["_item", "_doc", "score"],
            )

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(terms_of(t or b""))) for t in batch.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_item"), batch.column("_name"), pa.array(terms, pa.list_(pa.binary()))],
            ["_item", "_name", "_terms"],
        )


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col("_doc").asc())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block_of(rows: list, n_docs: int) -> Block:
    """``rows``: an item's number, and its terms with their document counts."""
    numbers: dict[bytes, int] = {}
    weights: list[int] = []
    terms, starts = [], [0]
    for row in rows:
        for term, df in row["_terms"]:
            term = bytes(term)
            if term not in numbers:
                numbers[term] = len(numbers)
                weights.append(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))))
            terms.append(numbers[term])
        starts.append(len(terms))
    return Block(
        np.array([r["_item"] for r in rows], np.int64), pa.array(list(numbers), pa.binary()),
        np.array(weights, np.int64), np.array(terms, np.int64), np.array(starts, np.int64),
        np.zeros(len(rows), np.int64),
    )


def _search_block(index: Index, block: Block, k: int) -> DataFrame:
    """``_item``, ``_doc``, ``score`` and ``rank`` for the items of a block; pinned."""
    spark = index.parts.sparkSession
    kind = T.StructType([
        T.StructField("_item", T.LongType()),
        T.StructField("_doc", index.parts.schema["docs"].dataType.elementType),
        T.StructField("score", T.LongType()),
    ])
    columns = ("m", "part", "docs", "terms", "runs", "tfs", "sizes", "places")
    shared = spark.sparkContext.broadcast(block)
    bounds = index.parts.select("m", "part", "terms", "runs", "tfs").mapInArrow(
        _best_parts(shared), "_item long, _bound long, m long, part long"
    )
    highest = bounds.groupBy("_item").agg(F.max_by(F.struct("m", "part"), F.struct("_bound", "m", "part")).alias("p"))
    # one part for each item of the block, at most
    first = F.broadcast(pin(highest.select("p.*").distinct()))
    tried = index.parts.select(*columns).join(first, ["m", "part"], "left_semi")
    seen = _best(tried.mapInArrow(_search(shared, k), kind), k).groupBy("_item").agg(
        F.min("score").alias("least"), F.count(F.lit(1)).alias("n")
    ).where(F.col("n") == k).collect()  # a row for each item of the block
    shared.unpersist()
    place = {int(item): i for i, item in enumerate(block.names)}
    least = block.least.copy()
    for row in seen:
        least[place[row["_item"]]] = row["least"]
    shared = spark.sparkContext.broadcast(block._replace(least=least))
    found = pin(_best(index.parts.select(*columns).mapInArrow(_search(shared, k), kind), k))
    shared.unpersist()
    return found


def search(
    index: Index | None, items: DataFrame, item_id: str = "item_id", text: str = "text",
    k: int = TOP, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each item's k best documents."""
    spark = items.sparkSession
    plain = items.select(
        F.monotonically_increasing_id().alias("_item"), F.col(f"`{item_id}`").alias("_name"),
        F.col(f"`{text}`").cast("binary").alias("_text"),
    )
    kind = T.StructType([plain.schema["_item"], plain.schema["_name"]]).add("_terms", T.ArrayType(T.BinaryType()))
    result = T.StructType([
        T.StructField(item_id, plain.schema["_name"].dataType), T.StructField("rank", T.IntegerType()),
    ])
    if index is None:
        return spark.createDataFrame([], result.add("doc_id", "long").add("score", "long"))
    result = result.add("doc_id", index.parts.schema["docs"].dataType.elementType).add("score", "long")
    asked = pin(plain.mapInArrow(_item_terms, kind).where(F.size("_terms") > 0))
    each = asked.select("_item", F.explode("_terms").alias("term"))
    wanted = pin(each.select("term").distinct())
    counted = index.parts.select(F.inline(F.arrays_zip("terms", "dfs"))).withColumnRenamed("terms", "term")
    # A term that no document has weighs nothing in any of them and is left out.
    dfs = pin(counted.join(measured(wanted), "term", "left_semi").groupBy("term").agg(F.sum("dfs").alias("df")))
    size = asked.agg(F.sum(F.aggregate(
        "_terms", F.lit(0).cast("long"), lambda total, t: total + F.octet_length(t) + 16
    ))).first()[0] or 0
    blocks = math.ceil(size / block_bytes)
    folder = run_folder(spark, "search")
    if not blocks:
        return spark.createDataFrame([], result)
    weighed = pin(each.join(dfs, "term").withColumn("_block", F.pmod(F.xxhash64("_item"), F.lit(blocks))))
    for number in range(blocks):
        rows = weighed.where(F.col("_block") == number).groupBy("_item").agg(
            F.collect_list(F.struct("term", "df")).alias("_terms")
        ).collect()  # the items of one block
        if not rows:
            continue
        found = _search_block(index, _block_of(rows, index.n_docs), k)
        found.write.parquet(f"{folder}/block={number}")
    if weighed.isEmpty():
        return spark.createDataFrame([], result)
    kind = f"_item long, _doc {result['doc_id'].dataType.simpleString()}, score long, rank int"
    return spark.read.schema(kind).parquet(folder).join(asked.select("_item", "_name"), "_item").select(
        F.col("_name").alias(item_id), "rank", F.col("_doc").alias("doc_id"), "score"
    )


def rank_documents(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """Index ``docs`` and search them for ``items``."""
    index = build_index(docs, run_folder(docs.sparkSession, "lexical-index"), doc_id, text)
    return search(index, items, **options)
