"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import pytest

import corpus_pipeline
from tidewindow.llm import (
    chat,
    decontaminate,
    htmltext,
    lattice,
    linededup,
    mixing,
    quality,
    rollups,
    simhash,
    suffixdedup,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars int"
#: Names that the operators use for columns of their own.
CLASHING = (
    "_row _text _doc _host _source _size _key _id _lost _rest _body _print t n_words kept size target spans "
    "items copies _copy taken word text_1 base_failed contaminated"
).split()
LONG = "word " * 30_000 + "end"
ROWS = [
    (None, "a text without an id " * 30, "en", "s1", 1),
    (1, None, "en", "s1", None),
    (2, "", None, None, 0),
    (3, LONG, "en", "s2", len(LONG)),
    (4, "one two three four five " * 12, "en", "s2", 288),
    (4, "one two three four five " * 12, "en", "s2", 288),
    (5, "one two three four five " * 12, "en", None, 288),
    (6, " \t\n ", "en", "s1", 4),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(0, "four five one two three four five one two three four five one two"), (1, None), (2, ""), (None, "end")],
        "item_id long, text string",
    )


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit("x").alias(c) for c in CLASHING))


def operators(benchmark):
    return {
        "lattice": lattice.score_documents,
        "simhash": simhash.near_duplicates,
        "mixing": mixing.mix_sources,
        "suffix": suffixdedup.remove_repeats,
        "lines": linededup.line_classes,
        "quality": quality.quality_rules,
        "decontaminate": lambda d: decontaminate.find_contamination(d, benchmark),
    }


NAMES = ["lattice", "simhash", "mixing", "suffix", "lines", "quality", "decontaminate"]


@pytest.mark.parametrize("name", NAMES)
def test_rows_in_are_rows_out(docs, benchmark, name):
    operator = operators(benchmark)[name]
    rows = operator(docs).collect()
    if name != "lines":
        assert sorted(repr(r["doc_id"]) for r in rows) == sorted(repr(r[0]) for r in ROWS)
    assert operator(docs.limit(0)).count() == 0
    clashing = operator(with_clashes(docs))
    assert sorted(map(repr, clashing.collect())) == sorted(map(repr, rows))


def test_repeated_rows_get_equal_results(docs, benchmark):
    for name, operator in operators(benchmark).items():
        rows = [r for r in operator(docs).collect() if r["doc_id"] == 4]
        assert len(rows) == (0 if name == "lines" and not rows else 2 if name != "lines" else len(rows)), name
        if name != "lines":
            assert rows[0] == rows[1], name


def test_empty_texts(docs, benchmark):
    of = {n: {r["doc_id"]: r for r in op(docs).collect()} for n, op in operators(benchmark).items()}
    for doc in (1, 2, 6):
        assert of["lattice"][doc]["n_tokens"] == 1
        assert of["simhash"][doc]["fingerprint"] == "0" * 16 and of["simhash"][doc]["component_id"] == 1
        assert of["mixing"][doc]["size"] == 0 and of["mixing"][doc]["taken"] == 0
        assert of["suffix"][doc]["n_removed"] == 0
        assert of["quality"][doc]["base_failed"] and not of["quality"][doc]["kept"]
        assert of["decontaminate"][doc]["n_words"] == 0 and not of["decontaminate"][doc]["contaminated"]
        assert doc not in of["lines"]
    assert of["suffix"][1]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert of["decontaminate"][3]["n_items"] == 1  # the item of one word without an id
    assert of["decontaminate"][4]["contaminated"]


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stage_keeps_columns(spark, docs, tmp_path, place):
    name, stage = corpus_pipeline.STAGES[place]
    sf = tmp_path / name
    spark.createDataFrame([(0, "nothing of it is in there at all")], "item_id long, text string").write.parquet(
        str(sf / "benchmark.parquet")
    )
    out = stage(spark, docs, str(sf))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
    assert stage(spark, docs.limit(0), str(sf)).count() == 0
    clashing = stage(spark, with_clashes(docs), str(sf))
    assert sorted(map(repr, clashing.select(docs.columns).collect())) == sorted(map(repr, out.collect()))


def test_stage_decisions(spark, docs):
    near = simhash.representatives(docs).collect()
    assert sorted(r["doc_id"] for r in near if r["doc_id"] is not None) == [1, 3, 4]
    assert [r["text"] for r in near if r["doc_id"] is None] == [ROWS[0][1]]
    lines = {r["doc_id"]: r for r in linededup.without_repeated_lines(docs, length="n_chars").collect()}
    assert 5 not in lines and lines[2]["text"] == "" and lines[1]["text"] is None
    good = spark.createDataFrame(
        [(i, " ".join(f"w{i}x{k}" for k in range(40)), "en", "s", 0) for i in range(9)] + [(9, "short", "en", "s", 0)], DOCS
    )
    assert sorted(r["doc_id"] for r in quality.passing(good).collect()) == list(range(9))


def test_chat_edges(spark):
    kind = "conv_id long, turn int, role string, text string, _conv string, _parts string"
    rows = spark.createDataFrame(
        [(1, 0, None, None, "", ""), (1, None, "user", "first", "", ""), (None, 0, "assistant", "x" * 100_000, "", ""),
         (2, 0, "assistant", "same", "", ""), (2, 0, "assistant", "same", "", "")], kind)
    out = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(rows)).collect()}
    assert out[1]["n_turns"] == 2 and out[1]["loss_chars"] == 0
    assert out[1]["turns_sha256"] == hashlib.sha256(b"user\nfirst\n\n\n").hexdigest()
    assert out[None]["loss_chars"] == 100_000
    assert out[2]["loss_sha256"] == hashlib.sha256(b"samesame").hexdigest()
    assert chat.format_conversations(rows.limit(0)).count() == 0
    broken = rows.selectExpr("conv_id", "turn", "CAST(unhex('61FF') AS STRING) AS role", "CAST(unhex('C362') AS STRING) AS text")
    said = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(broken)).collect()}
    assert said[None]["turns_sha256"] == hashlib.sha256("a\ufffd\n\ufffdb\n".encode()).hexdigest()


def test_page_edges(spark):
    rows = [(1, None, None), (2, "http://h/a", ""), (None, "http://h/b", "no markup &amp; more"),
            (3, "http://h/c", "<p>a" * 20_000), (3, "http://h/c", "<p>a" * 20_000), (4, "::", "<div><b>x")]
    pages = spark.createDataFrame([(*r, "y") for r in rows], "page_id long, url string, html string, text string")
    out = htmltext.extract_text(pages).collect()
    text = {r["page_id"]: r["text"] for r in out}
    assert len(out) == 6 and text[1] == "" and text[2] == "" and text[4] == "x"
    assert text[None] == "no markup & more"
    assert text[3] == "\n".join("a" * 20_000)
    assert htmltext.extract_text(pages.limit(0)).count() == 0


def test_token_count_edges(spark, docs):
    """Long texts are counted whole; columns of the same names do no harm."""
    files = (f"{rollups.FOLDER}/byte_bpe_50k.tiktoken", f"{rollups.FOLDER}/byte_bpe_multi_50k.tiktoken", "en")
    rows = rollups.token_counts(docs, *files).collect()
    coder = rollups.load_encoding(files[0])
    want = [(r[0], len(coder.encode_ordinary(r[1] or ""))) for r in ROWS]
    assert sorted(map(repr, ((r["_doc"], r["_first"]) for r in rows))) == sorted(map(repr, want))
    assert [r["_second"] for r in rows if r["_doc"] == 2] == [0]
    assert all((r["_second"] is None) == (r["_lang"] == "en") for r in rows)
    clashing = with_clashes(docs).selectExpr("*", "'x' AS _lang", "'x' AS _same", "'x' AS _first", "'x' AS _second")
    assert sorted(map(repr, rollups.token_counts(clashing, *files).collect())) == sorted(map(repr, rows))
    assert rollups.token_counts(docs.limit(0), *files).count() == 0


def test_rollup_edges(spark, tmp_path):
    rollup = rollups.Rollup(spark, str(tmp_path / "r"))
    assert rollup.totals().count() == 0
    image = rollups.IMAGE
    empty = spark.createDataFrame([], f"before {image}, after {image}")
    assert rollup.apply(1, empty) and rollup.totals().count() == 0
    rows = [(None, (None, None, "v", None), "x"), (None, ("s", "en", "v", 7), "x"), (None, None, "x")]
    assert rollup.apply(2, spark.createDataFrame(rows, f"before {image}, after {image}, source string"))
    assert {tuple(r) for r in rollup.totals().collect()} == {(None, None, "v", 1, 0), ("s", "en", "v", 1, 7)}
