"""SimHash near-duplicates by pigeonring filtering.

A fingerprint is cut into four segments of 16 bits on a ring.  If two fingerprints differ in
3 bits or fewer, some segment begins a chain in which the first ``l`` segments differ in at
most ``l * 3 / 4`` bits for every ``l``: 0, 1, 2 and 3 bits.  Keys demand the first two steps:
a segment that is equal, and the next one equal but for one masked bit.  Only distinct
fingerprints get keys, and only those that meet another under a key are compared at all.
There the third step of the chain is checked, and then the whole distance.  A pair may meet
under several keys; it counts under the first that fits.

Within a bucket only links that join two parts are passed on, never all pairs.  Buckets
above a bound are compared in blocks (see ``buckets``).  Components are found on Spark.

Defined results: a null text or one without words has the fingerprint zero, which links like
any other; texts of one or two words are one shingle; repeated rows return as often as they
occur; a null id takes part and names no component as long as another row does; no documents
give no rows.  Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewindow.llm.arrow import slices, texts
from tidewindow.llm.buckets import Forest, grouped, groups, meeting_rows
from tidewindow.llm.links import components
from tidewindow.llm.texts import row_key
from tidewindow.session import pin

SHINGLE = 3
DISTANCE = 3
SEED = 42
CHUNK = 1 << 16
SEGMENTS, WIDTH = 4, 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the lower-cased words of a text, as a signed 64-bit number."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    starts = np.concatenate([[0], ends[: len(words) - width] + 1]).tolist()
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (hashed(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())),
        np.uint64, len(starts),
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(batches):
    for batch in slices(batches, "_text"):
        found = pa.array([fingerprint(t) for t in texts(batch, "_text")], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("_doc"), found], ["_doc", "_print"])


def fingerprints(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    kind = docs.schema[doc_id].dataType.simpleString()
    plain = docs.select(F.col(doc_id).alias("_doc"), F.col(text).cast("binary").alias("_text"))
    return plain.mapInArrow(_fingerprints, f"_doc {kind}, _print long")


def chain_keys(value: Column) -> Column:
    """The 64 keys of a fingerprint: segment, masked bit of the next one, and both values."""

    def segment(i: Column) -> Column:
        return F.pmod(i, F.lit(SEGMENTS)) * WIDTH

    def key(n: Column) -> Column:
        i, j = F.floor(n / WIDTH).cast("int"), n % WIDTH
        exact = F.call_function("shiftrightunsigned", value, segment(i)).bitwiseAND(F.lit(0xFFFF))
        after = F.call_function("shiftrightunsigned", value, segment(i + 1)).bitwiseAND(F.lit(0xFFFF))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), j)
        masked = after - after.bitwiseAND(one)
        return (n.cast("long") * (1 << 32)) + exact * (1 << 16) + masked

    return F.transform(F.sequence(F.lit(0), F.lit(SEGMENTS * WIDTH - 1)), key)


def _differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of each segment, in the order of the ring."""
    differing = np.bitwise_xor(a, b).astype("<u8").view("<u2").reshape(-1, SEGMENTS)
    return np.bitwise_count(differing).astype(np.int64)


def pigeonring(a: np.ndarray, b: np.ndarray, key: int) -> np.ndarray:
    """Which pairs are within the distance and meet under ``key`` first."""
    d = _differences(a, b)
    ring = np.concatenate([d, d], axis=1)
    begins = np.ones((len(d), SEGMENTS), bool)
    for i in range(SEGMENTS):
        for length in range(1, SEGMENTS + 1):
            begins[:, i] &= ring[:, i : i + length].sum(axis=1) <= length * DISTANCE // SEGMENTS
    start, bit = divmod(key, WIDTH)
    ok = begins[:, start] & ~begins[:, :start].any(axis=1)
    if not ok.any():
        return ok
    x = np.bitwise_xor(a, b) >> np.uint64(WIDTH * ((start + 1) % SEGMENTS)) & np.uint64(0xFFFF)
    return ok & (x == (np.uint64(1) << np.uint64(bit)) if bit else x <= 1)


def _links(batches):
    left, right = [], []
    for group in groups(batches):
        values = group.column("_id").to_numpy().astype(np.int64).view(np.uint64)
        block = group.column("_block").to_numpy()
        key = int(group.column("_key")[0].as_py()) >> 32
        two, forest = block[0] != block[-1], Forest(len(values))
        for row in range(len(values) - 1):
            rest = np.arange(row + 1, len(values))
            rest = rest[forest.root[rest] != forest.root[row]]
            if two:
                rest = rest[block[rest] != block[row]]
            if not len(rest):
                continue
            near = pigeonring(np.broadcast_to(values[row], rest.shape), values[rest], key)
            for other in forest.link(row, rest[near]):
                left.append(values[row])
                right.append(values[other])
        if len(left) >= 50_000:
            yield _pairs(left, right)
            left, right = [], []
    yield _pairs(left, right)


def _pairs(left, right):
    made = [np.array(x, np.uint64).view(np.int64) for x in (left, right)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["a", "b"])


def print_links(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that join all distinct ``_print`` within the distance."""
    keyed = prints.select(
        F.explode(chain_keys(F.col("_print"))).alias("_key"),
        F.lit(True).alias("_first"), F.col("_print").alias("_id"),
    )
    met = pin(meeting_rows(keyed))
    return grouped(met).mapInArrow(_links, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` in hexadecimal and ``component_id`` of every document."""
    prints = pin(fingerprints(docs, doc_id, text))
    distinct = pin(prints.groupBy("_print").agg(F.min("_doc").alias("_least")))
    found = components(print_links(distinct))
    named = distinct.join(found, distinct["_print"] == found["node"], "left").select(
        F.col("_print"), "_least", F.coalesce("root", "_print").alias("_root")
    )
    roots = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    # Pinned, so that the last join has plain exchanges and a print of many copies is split.
    component = pin(named.join(roots, "_root").select(F.col("_print").alias("_p"), "component_id"))
    return prints.join(component, F.col("_print") == F.col("_p")).select(
        F.col("_doc").alias(doc_id),
        F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each component: that of the smallest id.

    Where an id is missing or names several rows, a document is its id and text: rows with
    the same id and text are one document, of which one row stays, and of a component's texts
    under one id, or without one, the one with the smallest digest.  An id comes before none.
    """
    key, single = row_key(docs, doc_id, text)
    if single:
        ids = near_duplicates(docs, doc_id, text).filter(F.col(doc_id) == F.col("component_id"))
        kept = docs.join(ids.select(doc_id), doc_id, "left_semi")
        return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
    named = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), key.alias("_name"),
        F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), key.alias("name")).alias("_order"), F.col(text).alias("_words"),
    )
    found = near_duplicates(named, "_order", "_words")
    first = found.filter(F.col("_order").eqNullSafe(F.col("component_id"))).select(
        F.col("_order").getField("name").alias("_name")
    )
    kept = named.join(first.distinct(), "_name", "left_semi").dropDuplicates(["_name"])
    return kept.select(*(F.col("_row")[c].alias(c) for c in docs.columns))
