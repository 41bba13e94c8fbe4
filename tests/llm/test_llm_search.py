"""Centroid clustering, ranked search and word BPE against plain versions and on edge cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewindow.llm import centroids, lexical, wordbpe
from tidewindow.llm.queries import QUERIES
from tidewindow.session import run_folder

BPE_FILE = f"{wordbpe.FOLDER}/word_bpe_49k.json"

# ---- op11


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12), st.integers(1, 4))
def test_nearest_with_ties(seed, k, spread):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-spread, spread + 1, (200, 3))
    some = rng.integers(-spread, spread + 1, (k, 3))
    apart = ((vectors[:, None] - some[None]) ** 2).sum(axis=2)
    number, distance, _ = centroids.nearest(vectors, some)
    assert (number == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_lists_spare_distances():
    """Vectors near well separated centroids are measured against a few of them only."""
    rng = np.random.default_rng(5)
    some = rng.integers(-1000, 1000, (64, 8))
    vectors = some[rng.integers(0, 64, 5000)] + rng.integers(-5, 6, (5000, 8))
    number, _, measured = centroids.nearest(vectors, some)
    apart = ((vectors[:, None] - some[None]) ** 2).sum(axis=2)
    assert (number == apart.argmin(axis=1)).all() and measured < 64 * 5000 / 4


def plain_clusters(rows, k, rounds, dims, scale, seed):
    kept = []
    for name, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            whole = [math.floor(scale * x) if abs(scale * x) < 2**60 else math.copysign(2**60, x) for x in v]
            kept.append((name, [int(max(-(1 << 27), min(1 << 27, w))) for w in whole]))
    text = [hashlib.sha256(f"{seed}:{'' if n is None else n}".encode()).hexdigest() for n, _ in kept]
    some = [v for _, v in sorted(zip(text, (v for _, v in kept)))[:k]]

    def assign():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in some]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(some)):
            mine = [v for (_, v), (at, _) in zip(kept, found) if at == c]
            if mine:
                some[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(name, *at) for (name, _), at in zip(kept, assign())], some


VECTORS = [
    (1, [0.5, -0.26]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [float("nan"), 0.0]),
    (7, [float("inf"), 0.0]), (None, [3.0, 3.0]), (8, [0.5, -0.26]), (8, [0.5, -0.26]), (8, [-4.0, 9.0]),
    (9, [1e300, -1e300]), (10, [0.0, 0.0]), (11, [2.0, 1.0]), (12, [1.0, 2.0]), (13, [1.0, 2.0, 3.0]),
]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_clusters_of_odd_vectors(spark, k):
    rows = [(i, [None if x is None else float(x) for x in v] if v is not None else None, "x") for i, v in VECTORS]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string").repartition(5)
    assigned, clusters = centroids.cluster_vectors(table, k=k, dims=2, scale=64)
    want, some = plain_clusters(VECTORS, k, 3, 2, 64, 1)
    assert Counter(map(tuple, assigned.collect())) == Counter(want)
    got = {r["cluster"]: r for r in clusters.collect()}
    assert [got[c]["centroid"] for c in range(len(some))] == some
    assert sum(r["size"] for r in got.values()) == len(want)
    assert sum(r["inertia"] for r in got.values()) == sum(d for _, _, d in want)
    digests = centroids.cluster_digests(assigned, clusters).collect()
    assert len(digests) == len(want) and len({r["inertia"] for r in digests}) == 1
    none = centroids.cluster_digests(*centroids.cluster_vectors(table.limit(0)))
    assert none.count() == 0 and none.columns[:3] == ["vec_id", "cluster", "distance"]


def test_cluster_query_against_plain(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    want, _ = plain_clusters([tuple(r) for r in rows], 16, 3, 64, 64, 1)
    got = QUERIES["op11_centroids"](spark, SF_SMALL)
    assert Counter(tuple(r)[:3] for r in got.collect()) == Counter(want)


# ---- op12


def plain_search(docs, items, k=10):
    term = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

    def split(text):
        return term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    counts = [(name, Counter(split(text))) for name, text in docs]
    counts = [(name, c) for name, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        asked, scored = set(split(text)), []
        for name, c in counts:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in asked & c.keys()
            )
            if score > 0:
                scored.append((-score, (name is not None, name or 0)))
        for rank, (score, (known, name)) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, name if known else None, -score))
    return sorted(out, key=repr)


def searched(spark, docs, items, **options):
    left = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, term string").repartition(3)
    right = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, score int")
    folder = run_folder(spark, "test-index")
    index = lexical.build_index(left, folder, part_terms=options.pop("part_terms", lexical.PART_TERMS))
    rows = lexical.search(index, right, **options).collect()
    return sorted((tuple(r) for r in rows), key=repr), index


@pytest.mark.parametrize("options", [{}, {"part_terms": 30, "block_bytes": 120}, {"k": 3, "part_terms": 10}])
def test_search_against_plain(spark, options):
    rng = random.Random(8)
    words = ["a", "B", "é", "ÉT", "x1", "漢", "the", "rare", "zz", "q9"]
    docs = [(i, " ".join(rng.choices(words, range(10, 0, -1), k=rng.randint(1, 30)))) for i in range(150)]
    docs += [(3, docs[3][1])] * 4 + [(200 + i, "the rare-rare the") for i in range(30)]  # copies and ties
    docs += [(None, "the é"), (None, "zz"), (300, None), (301, ""), (302, " -- !"), (303, "the " * 4000 + "rare")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 6)))) for i in range(20)]
    items += [(1, "rare"), (1, "rare"), (None, "ZZ the"), (50, None), (51, "--"), (52, "nowhere"), (53, "the the The")]
    got, _ = searched(spark, docs, items, **options)
    assert got == plain_search(docs, items, options.get("k", 10))


def test_search_edges(spark):
    assert searched(spark, [], [(1, "a")])[0] == []
    assert searched(spark, [(1, None), (2, "--")], [(1, "a")])[0] == []
    assert searched(spark, [(1, "a b")], [])[0] == []
    assert searched(spark, [(1, "a b")], [(1, "c")])[0] == []


def test_index_is_stratified_and_whole(spark):
    docs = [(i, "one two two") for i in range(40)] + [(40 + i, "one " * 9) for i in range(5)]
    _, index = searched(spark, docs, [(0, "one")], part_terms=20)
    rows = index.parts.collect()
    strata = {r["m"] for r in rows}
    assert len(strata) == 2 and len(rows) > 2 and index.n_docs == 45
    assert sorted(d for r in rows for d in r["docs"]) == list(range(45))
    for r in rows:
        assert len(r["places"]) == sum(r["sizes"]) == sum(r["dfs"]) and len(r["tfs"]) == sum(r["runs"])


def test_bounds_leave_parts_out(monkeypatch):
    """Parts whose bound is below the least score that counts are not opened."""
    opened = []
    keep = lexical._Part._open
    monkeypatch.setattr(lexical._Part, "_open", lambda self: (opened.append(self), keep(self))[1])
    parts = [lexical._part_row(m, 0, [b"rare common"] * 12 if m == 10 else [b"common other"] * 12)[0] for m in (10, 50, 90)]
    block = lexical._block_of([{"_item": 0, "_terms": [(b"rare", 12), (b"common", 36)]}], 36)
    import pyarrow as pa

    rows = {c: [p[c] for p in parts] for c in ("terms", *lexical.NUMBERS)}
    batch = pa.RecordBatch.from_pydict({
        "m": [10, 50, 90], "part": [0, 0, 0], "docs": [list(range(i * 12, i * 12 + 12)) for i in range(3)],
        "terms": pa.array(rows["terms"], pa.list_(pa.binary())),
        **{c: pa.array([x.tolist() for x in rows[c]], pa.list_(pa.int32())) for c in lexical.NUMBERS},
    })

    class Shared:
        value = block

    out = list(lexical._search(Shared, 10)([batch]))
    assert len(opened) == 1 and sorted(out[0].column("_doc").to_pylist()) == list(range(10))


# ---- op13


@pytest.fixture(scope="module")
def bpe():
    file = wordbpe.read_vocabulary(BPE_FILE)
    return file, wordbpe.Encoder(wordbpe.Vocabulary(file)), Tokenizer.from_file(BPE_FILE)


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(
    st.sampled_from("abcdefghijklmnopqrstuvwxyz'  \n\t0123<|>/éÉΣσßñ漢字́  \x1c\x85İ😀½"),
    st.characters(codec="utf-8", exclude_categories=["Cn", "Cs"]),
), max_size=80))
def test_ids_equal_the_library(bpe, text):
    _, encoder, library = bpe
    assert ids_of(encoder(text.encode())) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "", " \n", "a", "a" * 30_000, "the" * 9_000, "!?" * 5_000, "it's they'LL 12 007", "ΟΔΥΣΣΕΥΣ ΟΔΟΣ",
    "x<|endoftext|>y<|startoftext|><|startoftext|>", "<|ENDOFTEXT|> <|endoftext|", "é<|endoftext|>́",
])
def test_ids_of_odd_texts(bpe, text):
    _, encoder, library = bpe
    assert ids_of(encoder(text.encode())) == library.encode(text, add_special_tokens=False).ids


def test_prefixes_of_words(bpe):
    """Words of few letters have many ways to be merged."""
    _, encoder, library = bpe
    rng = random.Random(4)
    for _ in range(1500):
        word = "".join(rng.choices("aeinorst" if rng.random() < 0.5 else "abcdhilmnoqu", k=rng.randint(1, 25)))
        assert ids_of(encoder(word.encode())) == library.encode(word, add_special_tokens=False).ids


def test_documents_against_the_library(spark, bpe):
    library = bpe[2]
    want = {}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[r["doc_id"]] = (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )
    rows = QUERIES["op13_word_bpe"](spark, SF_SMALL).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)


def test_bpe_edges(spark, bpe):
    file, _, library = bpe
    rows = [(1, None, "c"), (2, "", "c"), (None, "two words", "c"), (2, "same", "c"), (2, "same", "c"), (3, "z" * 200_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = wordbpe.encode_documents(docs, file, ["doc_id"])
    out = wordbpe.decode_documents(encoded, file).collect()
    assert sorted(map(repr, ((r["doc_id"], ids_of(r["ids"]), bytes(r["decoded"]).decode()) for r in out))) == sorted(
        repr((i, ids, library.decode(ids, skip_special_tokens=False)))
        for i, t, _ in rows for ids in [library.encode(t or "", add_special_tokens=False).ids]
    )
    empty = wordbpe.token_digests(wordbpe.decode_documents(wordbpe.encode_documents(docs.limit(0), file, ["doc_id"]), file))
    assert empty.count() == 0
    none = wordbpe.token_digests(wordbpe.decode_documents(
        spark.createDataFrame([(1, None)], "doc_id long, ids binary"), file)).first()
    assert none["n_tokens"] == 0 and none["decoded_sha256"] == hashlib.sha256(b"").hexdigest()


def test_unfit_vocabularies_are_refused():
    import json

    def file(vocab, merges, **more):
        return json.dumps({"added_tokens": [], "model": {
            "type": "BPE", "end_of_word_suffix": "</w>", "byte_fallback": False,
            "vocab": {t: i for i, t in enumerate(vocab)}, "merges": merges, **more}}).encode()

    with pytest.raises(ValueError, match="before its parts"):
        wordbpe.Vocabulary(file(["a", "b", "ab", "abb"], [["ab", "b"], ["a", "b"]]))
    with pytest.raises(ValueError, match="two merges"):
        wordbpe.Vocabulary(file(["a", "aa", "aaa"], [["a", "a"], ["aa", "a"], ["a", "aa"]]))
    with pytest.raises(ValueError, match="word ends"):
        wordbpe.Vocabulary(file(["a"], [], end_of_word_suffix=None))
