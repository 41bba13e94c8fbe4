"""The whole job: lines of any length, boxes within articles, rows that share an id."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from test_llm_brute import DOCS, Sets, changed, edit_distance, table_of

import corpus_pipeline
from tidewindow.llm import htmltext, lattice, linededup, simhash


def plain_classes(places):
    """The first place of each line's class, by comparing all pairs."""
    sets = Sets(places)
    for a in places:
        for b in places:
            short, long = sorted((a, b), key=len)
            edits = min(2, len(short) // 20)
            if a < b and len(long) - len(short) <= edits and edit_distance(short, long) <= edits:
                sets.join(a, b)
    heads = {}
    for line, at in places.items():
        root = sets.find(line)
        heads[root] = min([heads.get(root, at[0]), *at])
    return {p: heads[sets.find(line)] for line, at in places.items() for p in at}


# ---- op6


@pytest.mark.parametrize("block", [1024, 3])
def test_lines_of_any_length(spark, monkeypatch, block):
    rng = random.Random(17)
    base = [bytes(rng.choice(b"abcdef") for _ in range(n)) for n in (1, 2, 5, 12, 19, 20, 21, 22, 30, 38, 39, 40, 41, 50)]
    lines = list(base)
    for i in range(200):
        line = rng.choice(lines)
        lines.append(changed(rng, line, rng.randrange(min(3, len(line)))))
    texts = ["\n".join(x.decode() for x in lines[i : i + 4]) + "\n  \n" for i in range(0, len(lines), 4)]
    monkeypatch.setattr(linededup, "BLOCK_LINES", block)
    monkeypatch.setattr(linededup, "SMALL_GROUP", 2)
    places = defaultdict(list)
    for doc, text in enumerate(texts):
        for at, line in enumerate(text.encode().split(b"\n")):
            if line.strip():
                places[line.strip()].append((doc, at))
    rows = linededup.line_classes(table_of(spark, texts)).collect()
    assert {(r["doc_id"], r["line"]): (r["class_doc"], r["class_line"]) for r in rows} == plain_classes(places)


def test_stage_removes_short_copies(spark):
    out = corpus_pipeline.line_stage(spark, table_of(spark, ["menu\nown a", "menu\nown b", "menu"]), "")
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {0: "menu\nown a", 1: "own b"}


def test_edits_are_characters(spark):
    rest = " and then some more words of it to fill up this line"
    texts = ["un été" + rest, "un ete" + rest, "漢字" + rest, "漢子" + rest, "漫子" + rest, "ñandú élé" + rest, "nandu ele" + rest]
    rows = linededup.line_classes(table_of(spark, texts)).collect()
    assert {r["doc_id"]: r["class_doc"] for r in rows} == {0: 0, 1: 0, 2: 2, 3: 2, 4: 2, 5: 5, 6: 6}
    broken = b"\xe9\xff caf\xc3\xa9 \xf0\x9f\x98\x80"
    assert linededup.code_points(linededup.characters(broken)).tolist() == [
        0xDCE9, 0xDCFF, 32, 99, 97, 102, 0xE9, 32, 0x1F600,
    ]


@pytest.mark.parametrize("at_once", [1 << 20, 64, 20])
def test_keys_of_many_lines(monkeypatch, at_once):
    """Running sums over all characters give what each segment gives by itself."""
    monkeypatch.setattr(linededup, "CHARACTERS_AT_ONCE", at_once)
    rng = random.Random(3)
    lines = ["".join(rng.choice("ab é漢") for _ in range(n)).encode() for n in [*range(18, 75), 40, 40, 90]]
    lines += [b"ab" * 30, b"\xff" * 45, b"a" * 21]
    keys, first, number = linededup.line_keys(lines, 2, {})
    got = defaultdict(dict)
    for k, f, n in zip(keys.tolist(), first.tolist(), number.tolist()):
        got[n][k] = got[n].get(k, False) or f
    for n, line in enumerate(lines):
        chars = line.decode("utf-8", "surrogateescape")
        edits = linededup.budget(len(chars), 2)
        want = {}
        own = linededup.segments(len(chars), edits)
        for indexed, i, at, size in linededup.probes(len(chars), 2) if edits else ():
            points = linededup.code_points(chars)[at : at + size]
            key = linededup.segment_key(points, indexed, i, 2)
            want[key] = want.get(key, False) or (indexed == len(chars) and at == own[i][0])
        assert got[n] == want


@pytest.mark.parametrize("block, small", [(1024, 8), (1024, 0), (3, 2)])
def test_number_of_links(spark, monkeypatch, block, small):
    """Families of lines within few edits: every pair counts once, however it was met."""
    rng = random.Random(23)
    lines = []
    for n in (20, 24, 39, 40, 41, 60):
        base = bytes(rng.choice(b"abc") for _ in range(n))
        lines += [base, *(changed(rng, base, rng.randrange(1, 3)) for _ in range(14))]
    lines += [b"ab" * 25, b"ba" * 25, b"ab" * 24, b"a" * 40, b"a" * 41, b"a" * 42, b"short", b"shors"]
    lines = [x.decode() for x in lines] + ["é" * 41, "é" * 40, "é" * 39 + "e"]
    texts = ["\n".join(lines[i : i + 3]) for i in range(0, len(lines), 3)] * 2
    monkeypatch.setattr(linededup, "BLOCK_LINES", block)
    monkeypatch.setattr(linededup, "SMALL_GROUP", small)
    kinds = sorted(set(lines))
    links = Counter()
    for i, a in enumerate(kinds):
        for b in kinds[i + 1 :]:
            x, y = sorted((a, b), key=len)
            edits = min(2, len(x) // 20)
            if len(y) - len(x) <= edits and edit_distance(x, y) <= edits:
                links.update((a, b))
    rows = linededup.line_classes(table_of(spark, texts)).collect()
    assert len(rows) == 2 * len(lines) and max(links.values()) > 3
    for r in rows:
        assert r["n_links"] == links[texts[r["doc_id"]].split("\n")[r["line"]]]


# ---- rows that share an id, or have none


def test_lines_of_rows_without_an_id(spark):
    same = "a line that several of the documents have in common"
    rows = [(None, f"{same}\nown one"), (None, f"own two\n{same}"), (None, f"{same}\nown three"),
            (7, f"own four\n{same}"), (7, "own five\nanother line that stands in here only"), (8, "own six")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    out = [r["text"] for r in linededup.without_repeated_lines(docs, length="n_chars", min_bytes=1).collect()]
    own = ["own four", "own five\nanother line that stands in here only", "own six"]
    assert sum(same in t for t in out) == 1 and {t for t in out if same not in t} >= set(own)
    assert sorted(x for t in out for x in t.split("\n") if x != same) == sorted(
        x for _, t in rows for x in t.split("\n") if x != same
    )


def test_representatives_of_rows_that_share_an_id(spark):
    def text(n):
        return " ".join(f"w{n}x{k}" for k in range(40))

    rows = [(None, text(0)), (None, text(1)), (None, text(1)), (4, text(2)), (4, text(3)), (4, text(3)), (5, text(2)), (None, text(2))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    out = sorted((str(r["doc_id"]), r["text"]) for r in simhash.representatives(docs).collect())
    assert out == sorted([("None", text(0)), ("None", text(1)), ("4", text(2)), ("4", text(3))])


# ---- op7


def pages_of(spark, rows):
    return spark.createDataFrame(
        [(i, f"https://{host}/{i}", f"<html><body>{body}</body></html>") for i, (host, body) in enumerate(rows)],
        "page_id long, url string, html string",
    )


def test_boxes_within_articles(spark):
    box = "<div class='x9'>Get our letter</div>"
    rows = [("h.org", f"<article><p>own text of page {i}</p>{box}<p>in all</p></article>") for i in range(4)]
    rows += [("near.org", f"<article><div>a long part that all the copies share</div><p>{i}</p></article>") for i in range(4)]
    rows += [("copies.org", f"<article><p>the same</p>{box}</article>")] * 4
    text = {r["page_id"]: r["text"] for r in htmltext.extract_text(pages_of(spark, rows)).collect()}
    assert all(text[i] == f"own text of page {i}\nin all" for i in range(4))
    assert all(text[4 + i] == f"a long part that all the copies share\n{i}" for i in range(4))
    assert all(text[8 + i] == "the same\nGet our letter" for i in range(4))


def test_copies_are_no_template_and_large_hosts_have_one(spark):
    rows = [("copies.org", "<div><p>one</p><p>two</p></div>")] * 5
    rows += [("large.org", f"<div>menu</div><p>own {i}</p>" if i < 5 else f"<p>own {i}</p>") for i in range(400)]
    text = {r["page_id"]: r["text"] for r in htmltext.extract_text(pages_of(spark, rows)).collect()}
    assert all(text[i] == "one\ntwo" for i in range(5))
    assert all(text[5 + i] == f"own {i}" for i in range(400))


@pytest.mark.parametrize("body, text", [
    ('<article class="post news-alert"><p>All of the text</p></article>', "All of the text"),
    ('<div class="sharing-economy"><p>About sharing</p></div>', "About sharing"),
    ('<article><p>One</p><section class="related-work"><p>Two</p></section></article>', "One\nTwo"),
    ('<article><p>One</p><div class="search-engines"><p>Two</p></div></article>', "One\nTwo"),
    ("<article><p>So <math>a + b</math> is <label>c</label></p></article>", "So a + b is c"),
    ('<main><h1>Head</h1><p>Long main text</p><article class="teaser">short</article></main>', "Head\nLong main text\nshort"),
    ("<main><div>x</div><article><p>The article itself</p></article></main>", "The article itself"),
    ('<article><p>One</p><div class="ad-slot">no</div><div id="user-comments-list">no</div></article>', "One"),
    ('<article><p>One</p></article><section class="comments"><p>no no no no no</p></section>', "One"),
])
def test_names_and_roots(body, text):
    assert htmltext.main_text(htmltext.read_page(f"<html><body>{body}"), set()) == text


def test_counted_subtrees_decide(spark, monkeypatch):
    """Boxes and menus without a telling name go by their count alone, with and without a broadcast."""
    box = "<div class='x9'><p>Same box</p></div>"
    rows = [("h.org", f"<div class='z'>Menu</div><article><p>Own {i} words</p>{box}</article>") for i in range(5)]
    rows += [("g.org", f"<div class='z'>Menu</div><div><p>Text {i}</p></div>") for i in range(4)]
    rows += [("one.org", f"<article><p>Alone</p>{box}</article>")]
    pages = pages_of(spark, rows)
    want = {**{i: f"Own {i} words" for i in range(5)}, **{5 + i: f"Text {i}" for i in range(4)}, 9: "Alone\nSame box"}
    for limit in (htmltext.BROADCAST_HASHES, 0):
        monkeypatch.setattr(htmltext, "BROADCAST_HASHES", limit)
        assert {r["page_id"]: r["text"] for r in htmltext.extract_text(pages).collect()} == want
    off = {r["page_id"]: r["text"] for r in htmltext.extract_text(pages, min_pages=10**9).collect()}
    assert all(off[i] != want[i] for i in want if i != 9)


# ---- op1


@pytest.mark.parametrize("frequent", [1 << 17, 40])
def test_scores_of_whole_documents(spark, monkeypatch, frequent):
    """The score of each text, from the scores that were learned, by sums from the end of its words."""
    learned = {}
    learn = lattice.learn

    def noted(words, docs, pieces, shared, rounds):
        learned["scores"], learned["pieces"] = learn(words, docs, pieces, shared, rounds), pieces
        return learned["scores"]

    monkeypatch.setattr(lattice, "learn", noted)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = lattice.score_documents(docs, frequent=frequent).collect()
    scores, pieces = learned["scores"], learned["pieces"]
    longest = max(map(len, pieces.spelled))
    known = {}

    def of_word(word):
        if word not in known:
            text = lattice.MARK + word
            rest = [-math.inf] * len(text) + [0.0]
            for at in range(len(text) - 1, -1, -1):
                for stop in range(at + 1, min(len(text), at + longest) + 1):
                    number = pieces.spelled.get(text[at:stop])
                    if number is not None:
                        rest[at] = np.logaddexp(rest[at], scores[number] + rest[stop])
            known[word] = rest[0]
        return known[word]

    text_of = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == len(text_of)
    for r in rows:
        words = re.findall(rb"[^\x20\x09-\x0d]+", (text_of[r["doc_id"]] or "").encode().lower())
        want = (math.fsum(of_word(w) for w in words) + scores[pieces.end]) / math.log(10)
        assert math.isclose(r["score"], want, rel_tol=1e-9)


def test_lines_of_all_lengths_get_keys_at_once(monkeypatch):
    """One running sum serves lines of different lengths; keys are those of each line alone."""
    draw = random.Random(8)
    lines = ["".join(draw.choices("abé字 ", k=n)).encode() for n in [*range(15, 140), 500, 40, 40]]
    lines += [b"a" * 60, b"ab" * 45]  # their segments repeat
    sums, made = linededup._running_sums, []
    monkeypatch.setattr(linededup, "_running_sums", lambda points: made.append(len(points)) or sums(points))
    calls, keyed = linededup._mixed, []
    monkeypatch.setattr(linededup, "_mixed", lambda *given: keyed.append(1) or calls(*given))
    found = linededup.line_keys(lines, 2, {})
    assert len(made) == len(keyed) == 1
    for number, line in enumerate(lines):
        alone = linededup.line_keys([line], 2, {})
        mine = found[2] == number
        assert found[0][mine].tolist() == alone[0].tolist()
        assert found[1][mine].tolist() == alone[1].tolist()
