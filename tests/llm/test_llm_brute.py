"""Operators against SQL, or against plain versions on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL
from oracle_check import database, oracle_rows, spark_rows

import corpus_pipeline
from tidewindow.llm import (
    buckets,
    chat,
    decontaminate,
    htmltext,
    lattice,
    linededup,
    links,
    mixing,
    rollups,
    simhash,
    suffixdedup,
    suffixsort,
)
from tidewindow.llm.oracle import ORACLE
from tidewindow.llm.queries import QUERIES

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def table_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)


def words(text):
    return (text or "").encode().lower().split()


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.up[y] = x


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    df, db = QUERIES[name](spark, SF_SMALL), database(SF_SMALL)
    described = db.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    assert {c: KINDS[k] for c, k in df.dtypes} == {d[0]: d[1] for d in described}
    assert spark_rows(df) == oracle_rows(db, ORACLE[name])


# ---- op1


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.mark.parametrize("frequent", [1 << 17, 40])
def test_base_scores(spark, frequent):
    docs = documents(spark)
    texts = {r["doc_id"]: [*words(r["text"]), None] for r in docs.collect()}
    count = Counter(w for d, ws in texts.items() if not held(d) for w in ws)
    total = sum(count.values())
    for r in lattice.score_documents(docs, frequent=frequent, rounds=0).collect():
        ws = texts[r["doc_id"]]
        base = sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in ws)
        known = sum(count[w] > 0 for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(r["doc_id"]), len(ws), known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)


class Letters:
    """A small vocabulary in place of a public one."""

    def __init__(self, spelled):
        self.spelled = {s: i for i, s in enumerate(spelled)}
        self.tree = lattice.spelling_tree(self.spelled)


def segmentations(word, pieces):
    if not word:
        yield []
    for s in pieces.spelled:
        if word.startswith(s):
            yield from ([s, *rest] for rest in segmentations(word[len(s):], pieces))


def test_lattice_sums_all_segmentations():
    mark = lattice.MARK
    marks = [mark[:1], mark[1:2], mark[2:]]
    pieces = Letters([mark, mark + b"a", b"a", b"b", b"ab", b"ba", b"aba", b"bab", *marks])
    scores = [-0.5 - 0.3 * i for i in range(11)]
    for word in (b"a", b"ab", b"abab", b"bbaab"):
        ways = list(segmentations(mark + word, pieces))
        weigh = [math.exp(sum(scores[pieces.spelled[s]] for s in way)) for way in ways]
        assert math.isclose(lattice.log_probability(pieces.tree, scores, word), math.log(sum(weigh)), rel_tol=1e-12)
        counts = [0.0] * 11
        lattice.expected_counts(pieces.tree, scores, word, 3, counts)
        short = [0.0] * 11
        lattice.expected_counts_of_short(pieces.tree, [math.exp(s) for s in scores], word, 3, short)
        for s, i in pieces.spelled.items():
            expected = 3 * sum(w * way.count(s) for w, way in zip(weigh, ways)) / sum(weigh)
            assert math.isclose(counts[i], expected, rel_tol=1e-9, abs_tol=1e-12)
            assert math.isclose(short[i], expected, rel_tol=1e-9, abs_tol=1e-12)


def test_short_lattices_are_summed_together():
    """Words of several lengths and scripts at once, some twice, against one word at a time."""
    pieces, draw = lattice.Pieces(lattice.MODEL), random.Random(4)
    scores = pieces.scores(np.array([draw.random() * 1000 for _ in range(pieces.end + 1)])).tolist()
    letters = ["a", "e", "s", "t", "th", "ing", "é", "Ω", "字", "\x00", "7"]
    words = ["".join(draw.choices(letters, k=draw.randint(1, 9))).encode() for _ in range(300)]
    words += [b"\xff\x80", b"the", b"the", b"x" * int(lattice.short_size(scores))]
    times = np.array([draw.randint(1, 9) for _ in words])
    found = lattice.ShortLattices(pieces, np.exp(scores), words)
    plain = [lattice.log_probability(pieces.tree, scores, w) for w in words]
    assert np.allclose(found.log_probabilities(), plain, rtol=1e-12)
    counts = [0.0] * (pieces.end + 1)
    for word, n in zip(words, times.tolist()):
        lattice.expected_counts(pieces.tree, scores, word, n, counts)
    assert np.allclose(found.expected(times, len(counts)), counts, rtol=1e-9, atol=1e-9)


def test_words_of_all_lengths_are_learned_alike(spark, monkeypatch):
    docs = documents(spark)
    plain = {r["doc_id"]: r["score"] for r in lattice.score_documents(docs).collect()}
    monkeypatch.setattr(lattice, "SMALLEST_LOG", 0.0)  # every word counts as a long one
    for r in lattice.score_documents(docs).collect():
        assert math.isclose(r["score"], plain[r["doc_id"]], rel_tol=1e-9)


def test_learning_raises_the_score(spark):
    docs = documents(spark)

    def held_out(rounds):
        rows = lattice.score_documents(docs, rounds=rounds).filter("held_out").agg({"score": "sum"}).first()
        return rows[0]

    assert held_out(2) > held_out(0)


# ---- op2


def plain_print(text):
    ws = [w.decode() for w in words(text)]
    grams = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def linked(prints):
    sets = Sets(prints)
    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                sets.join(a, b)
    return {d: sets.find(d) for d in prints}


def test_near_duplicates(spark):
    docs = documents(spark)
    prints = {r["doc_id"]: plain_print(r["text"]) for r in docs.collect()}
    expected = linked(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {d: (f"{p:016x}", expected[d]) for d, p in prints.items()}


@pytest.mark.parametrize("block", [4096, 7])
def test_dense_prints_in_blocks(spark, monkeypatch, block):
    """Chains of prints a few bits apart, in buckets above and below the bound."""
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(4)]
    prints = {}
    for i in range(150):
        value = prints[rng.randrange(i)] if i > 8 and rng.random() < 0.7 else base[i % 4]
        for _ in range(rng.randrange(4)):
            value ^= 1 << rng.randrange(64)
        prints[i] = value
    monkeypatch.setattr(buckets.grouped, "__defaults__", (block, None))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in set(prints.values())]
    edges = simhash.print_links(spark.createDataFrame(signed, "_print long"))
    roots = {r["node"]: r["root"] for r in links.components(edges).collect()}
    found = defaultdict(set)
    for d, p in prints.items():
        s = p - (1 << 64) if p >> 63 else p
        found[roots.get(s, s)].add(d)
    expected = defaultdict(set)
    for d, root in linked(prints).items():
        expected[root].add(d)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(1, 50)] + [(7, 7), (3000, 2000)]
    got = {r["node"]: r["root"] for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    sets = Sets({x for e in edges for x in e})
    for a, b in edges:
        sets.join(a, b)
    assert got == {n: sets.find(n) for n in sets.up}


# ---- op3


def test_chat_round_trip(spark):
    said = "</s>[INST] ok [/INST]"
    nasty = [said, "\\", "<\\|end|>", "<|end|>\\<|turn|>", "\\\\<s>", "<|", "[INST][/INST]", "é\n\n", ""]
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(nasty)] + [(2, 0, "<|text|>", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    formatted = chat.format_conversations(df)
    text = {r["conv_id"]: r["formatted"] for r in formatted.collect()}
    assert text[1].count("<|") == 3 * len(nasty) and "</s>" not in text[1] and "[INST]" not in text[1]
    got = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    for conv in (1, 2):
        turns = [(r, t) for c, _, r, t in rows if c == conv]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert (got[conv]["n_turns"], got[conv]["loss_chars"]) == (len(turns), len(loss))
        assert got[conv]["formatted_chars"] == len(text[conv])


def test_chat_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect()
    turns = defaultdict(list)
    for r in rows:
        turns[r["conv_id"]].append((r["role"], r["text"] or ""))
    turns[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: r for r in QUERIES["op3_chat_format"](spark, SF_SMALL).collect()}
    assert got.keys() == turns.keys()
    for conv, said in turns.items():
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()


def test_typed_parts(spark):
    part = dict.fromkeys(("text", "ref", "width", "height", "seconds", "pages"))
    parts = [
        {**part, "type": "text", "text": "see <|image:0|> "},
        {**part, "type": "image", "ref": "a.png", "width": 28, "height": 15},
        {**part, "type": "audio", "ref": "b.wav", "seconds": 2.0},
        {**part, "type": "document", "ref": "c.pdf", "pages": 3},
    ]
    order = ("type", "text", "ref", "width", "height", "seconds", "pages")
    df = spark.createDataFrame(
        [(1, 0, "user", [tuple(p[k] for k in order) for p in parts]), (1, 1, "assistant", None)],
        f"conv_id long, turn int, role string, parts array<{chat.PART}>",
    )
    row = chat.format_conversations(df, parts="parts").first()
    assert "see <\\|image:0|> <|image:0|><|audio:1|><|document:2|>" in row["formatted"]
    assert [(a["ref"], a["tokens"]) for a in row["attachments"]] == [("a.png", 4), ("b.wav", 50), ("c.pdf", 3072)]
    assert row["attachment_tokens"] == 3126


def test_linked_parts(spark):
    """Links in texts become attachments, and texts are read back as they were."""
    texts = [
        "![a](a.png){width=28 height=15} and \\![b \\](x/B.WAV){seconds=2.5}![c](c.pdf){pages=3}\n",
        "<|image:0|> ![](d.jpeg)![not] (e.png) ![f](f g.png)",
        "![g](g.png){width=99999999999 height=2} {x} \\<|image:7|>\\", "", None, "![h](h){height=14 width=14",
    ]
    rows = [(c, i, "assistant" if i % 2 else "user", t) for c in (1, 2) for i, t in enumerate(texts)]
    formatted = chat.format_conversations(
        spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    )
    found = {r["conv_id"]: r for r in formatted.collect()}[1]
    assert [(a["number"], a["type"], a["ref"], a["turn"], a["tokens"]) for a in found["attachments"]] == [
        (0, "image", "a.png", 0, 4), (1, "audio", "x/B.WAV", 0, 63), (2, "document", "c.pdf", 0, 3072),
        (3, "image", "d.jpeg", 1, 0), (4, "image", "g.png", 2, 0), (5, "image", "h", 5, 0),
    ]
    assert "<|turn|>user<|text|><|image:0|> and \\\\<|audio:1|><|document:2|>\n<|end|>" in found["formatted"]
    assert "<\\|image:0|> <|image:3|>![not] (e.png) ![f](f g.png)" in found["formatted"]
    for r in chat.digests(formatted).collect():
        said = [(role, t or "") for c, _, role, t in rows if c == r["conv_id"]]
        loss = "".join(t for role, t in said if role == "assistant")
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in said).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and r["loss_chars"] == len(loss)
        assert (r["n_attachments"], r["attachment_tokens"]) == (6, 3139)


# ---- op4


def test_water_filling(spark):
    sizes = {"a": 1000, "b": 10, "c": 400, None: 90, "d": 0}
    rows = mixing.water_fill(spark.createDataFrame(list(sizes.items()), "_source string, source_size long")).collect()
    target = {r["_source"]: r["target"] for r in rows}
    weight = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1]))
    share, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = sum(w for s, w in weight.items() if s not in capped)
        rest = share - sum(2 * sizes[s] for s in capped)
        over = {s for s in weight if s not in capped and rest * weight[s] / free > 2 * sizes[s]}
        if not over:
            break
        capped |= over
    for s in weight:
        expected = 2 * sizes[s] if s in capped else rest * weight[s] / free
        assert math.isclose(target[s], expected, abs_tol=1e-9)


def test_mix_meets_targets(spark):
    rows = mixing.mix_sources(documents(spark)).collect()
    assert rows and all(r["taken"] <= 2 * r["size"] for r in rows)
    largest, taken, target = Counter(), Counter(), {}
    source = {r["doc_id"]: r["source"] for r in documents(spark).collect()}
    for r in rows:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        target[s] = r["target"]
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in target)
    out = mixing.mixed(documents(spark)).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in out} == {r["doc_id"]: r["taken"] // r["size"] for r in rows if r["taken"]}


# ---- op5


def cut_repeats(texts, length=200):
    times = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        covered = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        runs = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        rest = bytes(x for x, c in zip(t, covered) if not c)
        yield len(t), sum(covered), runs, hashlib.sha256(rest).hexdigest()


def test_suffix_order():
    import numpy as np

    rng = random.Random(5)
    for trial in range(150):
        n, depth = rng.randint(1, 80), rng.choice([8, 16, 24])
        text = bytes(rng.choice(b"ab" if trial % 2 else b"abcd\xff") for _ in range(n))
        wanted = np.array([rng.random() < 0.6 for _ in range(n)])
        order, held_words = suffixsort.suffix_order(text, wanted, depth)
        keys = [(text + bytes(depth))[i : i + depth] for i in order]
        assert keys == sorted(keys) and set(np.flatnonzero(wanted)) <= set(order.tolist())
        shared = suffixsort.common_prefixes(held_words, order, depth)
        for i in range(1, len(keys)):
            same = next((k for k in range(depth) if keys[i - 1][k] != keys[i][k]), depth)
            assert same == shared[i]


@pytest.mark.parametrize("block", [2048, 3])
def test_remove_repeats(spark, monkeypatch, block):
    rng = random.Random(7)
    passage = "".join(rng.choice("etaoin shrdlué") for _ in range(420))
    texts = [r["text"] for r in documents(spark).limit(40).collect()]
    for i in range(30):
        own = "".join(rng.choice("etaoin shrdlu") for _ in range(rng.randrange(500)))
        texts.append(own + passage[rng.randrange(150) : rng.randrange(200, 420)] + own[::-1])
    texts += [passage, passage, "x" * 700, "ab" * 300, passage[:199], "y" * 201]
    monkeypatch.setattr(suffixdedup, "BLOCK_STRETCHES", block)
    monkeypatch.setattr(suffixdedup, "PART", 5000)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffixdedup.remove_repeats(table_of(spark, texts)).collect()}
    assert got == dict(enumerate(cut_repeats([t.encode() for t in texts])))


# ---- op6


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, line, edits):
    line = bytearray(line)
    for _ in range(edits):
        at, kind = rng.randrange(len(line)), rng.randrange(3)
        if kind == 0:
            line[at] = rng.choice(b"abcdef")
        elif kind == 1:
            del line[at]
        else:
            line.insert(at, rng.choice(b"abcdef"))
    return bytes(line)


def test_banded_distance():
    rng = random.Random(11)
    for distance in range(4):
        pairs = []
        for _ in range(400):
            a = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
            b = changed(rng, a, rng.randrange(min(5, len(a))))
            a, b = sorted((a, b), key=len)
            if len(b) - len(a) <= distance:
                pairs.append((a, b))
        near = linededup.within([a for a, _ in pairs], [b for _, b in pairs], distance)
        assert near.tolist() == [edit_distance(a, b) <= distance for a, b in pairs]


@pytest.mark.parametrize("block", [1024, 3])
def test_line_classes(spark, monkeypatch, block):
    rng = random.Random(13)
    base = [bytes(rng.choice(b"abcdef ") for _ in range(rng.randint(42, 60))).strip() for _ in range(12)]
    lines = []
    for i in range(120):
        line = lines[rng.randrange(i)] if i and rng.random() < 0.4 else base[i % 12]
        lines.append(changed(rng, line, rng.randrange(4)).strip())
    texts = ["\n".join(x.decode() for x in lines[i : i + 4]) + "\nshort" for i in range(0, 120, 4)]
    monkeypatch.setattr(linededup, "BLOCK_LINES", block)
    monkeypatch.setattr(linededup, "SMALL_GROUP", 2)
    places = defaultdict(list)
    for doc, text in enumerate(texts):
        for at, line in enumerate(text.encode().split(b"\n")):
            if len(line.strip()) >= 40:
                places[line.strip()].append((doc, at))
    sets = Sets(places)
    for a in places:
        for b in places:
            if a < b and abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= 2:
                sets.join(a, b)
    heads = {}
    for line, at in places.items():
        root = sets.find(line)
        heads[root] = min(heads.get(root, at[0]), *at)
    expected = {p: heads[sets.find(line)] for line, at in places.items() for p in at}
    rows = linededup.line_classes(table_of(spark, texts), min_bytes=40).collect()
    assert {(r["doc_id"], r["line"]): (r["class_doc"], r["class_line"]) for r in rows} == expected
    assert all(r["kept"] == ((r["doc_id"], r["line"]) == (r["class_doc"], r["class_line"])) for r in rows)


# ---- op7


def test_page_text(spark):
    def page(i, host, body):
        return (i, f"https://{host}/p/{i}", f"<!DOCTYPE html><html><head><title>t</title></head><body>{body}</body></html>")

    menu = "<div class='x1'><a href='/a'>Home</a> <a>News</a></div>"
    inner = "<article><header><h1>A &amp; B</h1></header><p>One\n <b>two</b>&nbsp;three<p>four<aside>no</aside><div class='ad-slot'>no</div><ul><li>i<li>j</ul><form>no</form></article>"
    rows = [page(i, "h.org", f"{menu}<div><p>own {i}</p><p>second {i}</p></div><div id='cookie-notice'>no</div>") for i in range(6)]
    rows.append(page(6, "h.org", f"{menu}<nav>no</nav>{inner}<section class='comments'><article class='comment'>no</article></section>"))
    rows.append(page(7, "other.org", menu))
    rows += [page(i, "copies.org", "<article><p>same text</p></article>") for i in range(8, 20)]
    got = {r["page_id"]: r for r in htmltext.extract_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i]["text"] == f"own {i}\nsecond {i}"
    assert got[6]["text"] == "A & B\nOne two three\nfour\ni\nj"
    assert got[7]["text"] == "Home News"  # on one page of its host only
    assert all(got[i]["text"] == "same text" for i in range(8, 20))


@pytest.mark.parametrize("body, text", [
    ("<aside><article>teaser</article></aside><article>own</article>", "own"),
    ("<div class='content-with-sidebar'><article class='post no-comments'>own</article></div>", "own"),
    ("<div class='content-with-sidebar'><p>own</p></div><div id='left_sidebar'>no</div>", "own"),
    ("<main><p>a</p><section id=comments><p>no</p></section></main><div>no</div>", "a"),
    ("<div class='comments'><article>only one</article></div>", "only one"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table>x &lt;b&gt; y<script>var a='</p>'</script></article>", "1\n2\n3\nx <b> y"),
    ("<article><p>a<br>b</p><pre>c\n d</pre></article", "a b\nc d"),
])
def test_main_text_of(body, text):
    assert htmltext.main_text(htmltext.read_page(f"<html><body>{body}"), set()) == text


def test_pages_of_the_table(spark):
    """In these pages the main text is the heading and the paragraphs of the one article."""
    import html

    for r in QUERIES["op7_html_text"](spark, SF_SMALL).join(
        spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", inner))
        clean = (" ".join(html.unescape(b).split()) for b in blocks)
        assert r["text"] == "\n".join(b for b in clean if b)
        assert r["n_chars"] == len(r["text"])


# ---- op8


def test_rollup_of_documents(spark):
    docs = documents(spark).collect()
    first, second = (rollups.load_encoding(f"{rollups.FOLDER}/{n}.tiktoken") for n in ("byte_bpe_50k", "byte_bpe_multi_50k"))
    seen, expected = set(), Counter()
    for r in sorted(docs, key=lambda r: r["doc_id"]):
        if r["text"] in seen:
            continue
        seen.add(r["text"])
        name, coder = ("byte_bpe_50k", first) if r["lang"] == "en" else ("byte_bpe_multi_50k", second)
        expected[r["source"], r["lang"], name, "docs"] += 1
        expected[r["source"], r["lang"], name, "tokens"] += len(coder.encode_ordinary(r["text"]))
    got = Counter()
    for r in QUERIES["op8_token_rollup"](spark, SF_SMALL).collect():
        got[r["source"], r["lang"], r["tokenizer"], "docs"] = r["n_docs"]
        got[r["source"], r["lang"], r["tokenizer"], "tokens"] = r["n_tokens"]
    assert got == expected


def test_rollup_commits(spark, tmp_path):
    rollup = rollups.Rollup(spark, str(tmp_path / "r"))
    kind = f"before {rollups.IMAGE}, after {rollups.IMAGE}"

    def changes(*rows):
        return spark.createDataFrame(rows, kind)

    def totals():
        return {tuple(r) for r in rollup.totals().collect()}

    a, b = ("s", "en", "v1", 10), ("s", "en", "v2", 8)
    assert rollup.apply(2, changes((a, b)))  # before its insert
    assert totals() == {("s", "en", "v1", -1, -10), ("s", "en", "v2", 1, 8)}
    assert rollup.apply(1, changes((None, a), (None, a)))
    assert not rollup.apply(1, changes((None, a), (None, a)))
    assert totals() == {("s", "en", "v1", 1, 10), ("s", "en", "v2", 1, 8)}
    # A batch that broke off before its marker does not count, and is replaced.
    rollups.signed_rows(changes((None, a))).write.parquet(f"{rollup.folder}/deltas/batch=3")
    assert totals() == {("s", "en", "v1", 1, 10), ("s", "en", "v2", 1, 8)}
    rollup.compact()
    assert totals() == {("s", "en", "v1", 1, 10), ("s", "en", "v2", 1, 8)}
    assert rollup.apply(3, changes((a, None)))
    assert totals() == {("s", "en", "v2", 1, 8)}
    rollup.compact()
    assert totals() == {("s", "en", "v2", 1, 8)} and not rollup.apply(3, changes((a, None)))


# ---- op10


def test_blocks_of_items(spark, monkeypatch):
    """Many blocks of items give what one block gives; one of them is held at a time."""
    docs = documents(spark)
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    one = decontaminate.find_contamination(docs, benchmark).collect()
    monkeypatch.setattr(decontaminate, "WINDOWS_AT_ONCE", 7)
    dropped, sent = [], []
    context = type(spark.sparkContext)
    keep = context.broadcast

    def noted(self, value):
        held = keep(self, value)
        sent.append(held)
        drop = held.unpersist
        held.unpersist = lambda *a: (dropped.append(held), drop(*a))
        assert len(sent) - len(dropped) <= 2
        return held

    monkeypatch.setattr(context, "broadcast", noted)
    many = decontaminate.find_contamination(docs, benchmark, block_bytes=1500).collect()
    assert len(sent) > 4 and len(sent) == len(dropped)
    assert sorted(one) == sorted(many) and any(r["contaminated"] for r in one)


# ---- the pipeline


def few_edits(a, b, edits):
    """Whether ``a`` can be made ``b`` by so many edits of a character: past what is equal, try each."""
    at = 0
    while at < min(len(a), len(b)) and a[at] == b[at]:
        at += 1
    a, b = a[at:], b[at:]
    if not a or not b:
        return len(a) + len(b) <= edits
    return edits > 0 and (
        few_edits(a[1:], b[1:], edits - 1) or few_edits(a[1:], b, edits - 1) or few_edits(a, b[1:], edits - 1)
    )


def test_pipeline_against_plain_stages(spark):
    """Each stage's decisions, taken from its operator's own tested result or from SQL."""
    docs = documents(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    judged = {r[0]: r[-1] for r in database(SF_SMALL).execute(ORACLE["op9_quality_rules"]).fetchall()}
    left = {d: t for d, t in texts.items() if judged[d]}
    lines = defaultdict(list)
    for d, t in sorted(left.items()):
        for at, line in enumerate(t.split("\n")):
            bare = line.strip(" \t\n\r\x0b\x0c")
            if bare:
                lines[bare].append((d, at))
    sets = Sets(lines)
    by_length = defaultdict(list)
    for line in lines:
        by_length[len(line)].append(line)
    for n, some in by_length.items():
        edits = min(2, n // 20)
        if not edits:
            continue
        for i, a in enumerate(some):
            rest = some[i + 1 :] + [b for k in range(1, edits + 1) for b in by_length.get(n + k, [])]
            for b in rest:
                if few_edits(a, b, edits):
                    sets.join(a, b)
    heads = {}
    for line, at in lines.items():
        root = sets.find(line)
        heads[root] = min([heads.get(root, at[0]), *at])
    lost = {p for line, at in lines.items() for p in at if p != heads[sets.find(line)]}
    cut = {}
    for d, t in left.items():
        rest = "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in lost)
        if rest == t or words(rest):
            cut[d] = rest
    roots = linked({d: plain_print(t) for d, t in cut.items()})
    near = {d: cut[d] for d in cut if roots[d] == d}
    split = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def fold(t):
        return split.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))

    windows = set()
    for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect():
        ws = fold(r["text"])
        windows |= {tuple(ws[i : i + 13]) for i in range(max(1, len(ws) - 12))} if ws else set()
    clean = {}
    for d, t in near.items():
        ws = fold(t)
        hit = {i + k for w in {len(w) for w in windows} for i in range(len(ws) - w + 1)
               if tuple(ws[i : i + w]) in windows for k in range(w)}
        if not hit or 20 * len(hit) < len(ws):
            clean[d] = t
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in rows} <= clean.keys()
    assert all(r["text"] == clean[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in rows)
    mixed = mixing.mixed(spark.createDataFrame([(d, t, source[d]) for d, t in clean.items()], "doc_id long, text string, source string"))
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in mixed.collect())
