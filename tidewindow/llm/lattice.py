"""Marginal likelihood of texts under a subword unigram model.

The vocabulary is that of a public tokenizer and is not changed; all 256 single bytes belong
to it, so every text can be spelled.  Its scores, the log probabilities of the pieces and of
the end of a text, are learned from the training documents: counts of the tokenizer's own
segmentation first, then expected counts over all segmentations (``rounds`` steps of
expectation and maximisation).  The probability of a text is the sum over all its
segmentations.  Pieces do not cross white space, so the lattice of a text falls into those of
its words, each with a mark before it, and a forward recursion over a word's bytes gives its
share: in log space for long words, from plain probabilities and for many words at once for
short ones.

*Size.*  All words are counted once, those of held-out documents as 0.  Learning and the
lattices see each distinct word once, in tasks.  Documents look up at most ``frequent`` words of
at most ``SHORT`` bytes in a broadcast table; each of its other words a document emits once, to be
joined with the table of all words.  So neither the vocabulary of the corpus nor a document's
tokens are ever in one place.  The tokenizer's file is read on the driver and broadcast.

Defined results: a null or empty text is one end token; without training documents all
counts are 0 and all pieces are equally likely; a null id counts as the empty string for the
split; repeated rows are learned from as often as they occur and all get the same score.
Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewindow.llm.arrow import slices, texts
from tidewindow.llm.texts import row_key
from tidewindow.session import pin

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
FOLDS, HELD_OUT = 7, 2
FREQUENT = 1 << 17
#: Longest word in the broadcast table, in bytes.
SHORT = 64
#: Log of the smallest probability of a segmentation that is not kept as a log.
SMALLEST_LOG = -600.0
REMEMBERED = 1 << 18
ROUNDS = 3


class Pieces:
    """The vocabulary: spellings as bytes, and how far a spelling may go on."""

    def __init__(self, model_file: str):
        import sentencepiece

        with open(model_file, "rb") as stored:
            self.model = stored.read()
        processor = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        spelled: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        self.number_of: list[int] = []
        for i in range(processor.get_piece_size()):
            if processor.is_byte(i):
                spelling = bytes([int(processor.id_to_piece(i)[3:-1], 16)])
            elif processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i):
                self.number_of.append(-1)
                continue
            else:
                spelling = processor.id_to_piece(i).encode()
            self.number_of.append(spelled.setdefault(spelling, len(spelled)))
        self.spelled = spelled
        self.tree = spelling_tree(spelled)
        self.children, self.piece = tree_arrays(self.tree)
        self.end = len(spelled)  # number of the end of a text

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Log probabilities of the pieces and the end, each counted once more."""
        return np.log(counts + 1.0) - math.log(counts.sum() + len(counts))


def spelling_tree(spelled: dict[bytes, int]) -> dict:
    """Spellings by their bytes; a piece's number lies under -1 of its last node."""
    tree: dict = {}
    for spelling, number in spelled.items():
        node = tree
        for byte in spelling:
            node = node.setdefault(byte, {})
        node[-1] = number
    return tree


def tree_arrays(tree: dict) -> tuple[np.ndarray, np.ndarray]:
    """The tree as arrays: the next node by node and byte, -1 for none, and the piece of a node,
    -1 for none.  Nodes that end come last and share the last row, which leads nowhere."""
    inner, ends = [tree], []
    for node in inner:  # grows while it is walked
        for byte, child in node.items():
            if byte >= 0:
                (inner if len(child) > (-1 in child) else ends).append(child)
    place = {id(node): k for k, node in enumerate(inner + ends)}
    children = np.full((len(inner) + 1, 256), -1, np.int32)
    for k, node in enumerate(inner):
        for byte, child in node.items():
            if byte >= 0:
                children[k, byte] = place[id(child)]
    return children, np.array([node.get(-1, -1) for node in inner + ends], np.int32)


def _add(x: float, y: float) -> float:
    """Log of the sum of two numbers given by their logs."""
    return x + math.log1p(math.exp(y - x)) if x > y else y + math.log1p(math.exp(x - y))


def log_probability(tree: dict, scores: list[float], word: bytes) -> float:
    """Natural log of the sum over all segmentations of a word.

    Every single byte is a piece, so every place in the word is reached.
    """
    word = MARK + word
    n = len(word)
    reached: list[float | None] = [None] * (n + 1)
    reached[0] = 0.0
    for start in range(n):
        here, node = reached[start], tree
        for stop in range(start, n):
            node = node.get(word[stop])
            if node is None:
                break
            number = node.get(-1)
            if number is not None:
                way, known = here + scores[number], reached[stop + 1]
                reached[stop + 1] = way if known is None else _add(known, way)
    return reached[n]


def expected_counts(tree: dict, scores: list[float], word: bytes, times: int, into) -> None:
    """Add the expected numbers of the pieces in a word."""
    word = MARK + word
    n = len(word)
    reached: list[float | None] = [None] * (n + 1)
    reached[0] = 0.0
    edges = []
    for start in range(n):
        here, node = reached[start], tree
        for stop in range(start, n):
            node = node.get(word[stop])
            if node is None:
                break
            number = node.get(-1)
            if number is not None:
                way, known = here + scores[number], reached[stop + 1]
                reached[stop + 1] = way if known is None else _add(known, way)
                edges.append((start, stop + 1, number, way))
    total = reached[n]
    left: list[float | None] = [None] * (n + 1)  # from a place to the end
    left[n] = 0.0
    # By descending start, so all that begin where an edge ends have been seen.
    for start, stop, number, way in reversed(edges):
        rest = left[stop]
        into[number] += times * math.exp(way + rest - total)
        way, known = scores[number] + rest, left[start]
        left[start] = way if known is None else _add(known, way)


def expected_counts_of_short(tree: dict, chances: list[float], word: bytes, times: int, into) -> None:
    """The same from probabilities, for one word whose product of probabilities is a float;
    ``ShortLattices`` takes many such words at once."""
    word = MARK + word
    n = len(word)
    reached = [1.0] + [0.0] * n
    edges = []
    for start in range(n):
        here, node = reached[start], tree
        for stop in range(start, n):
            node = node.get(word[stop])
            if node is None:
                break
            number = node.get(-1)
            if number is not None:
                way = here * chances[number]
                reached[stop + 1] += way
                edges.append((start, stop + 1, number, way))
    left = [0.0] * n + [times / reached[n]]
    for start, stop, number, way in reversed(edges):
        rest = left[stop]
        into[number] += way * rest
        left[start] += chances[number] * rest


class ShortLattices:
    """The lattices of many words at once, for words whose product of probabilities is a float.

    Words are sorted by length, longest first, so those that reach a place are the first ones.
    One step takes all edges from one place to another; a word has one of them at most.
    """

    def __init__(self, pieces: Pieces, chances: np.ndarray, words: list[bytes]):
        marked = [MARK + w for w in words]
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes, self.chances = sizes[self.order], chances
        count, width = len(marked), int(self.sizes[0])
        padded = b"".join(marked[i].ljust(width, b"\0") for i in self.order)
        letters = np.ascontiguousarray(np.frombuffer(padded, np.uint8).reshape(count, width).T)
        longer = np.searchsorted(-self.sizes, -np.arange(width + 1), "left")  # words beyond a place
        last = len(pieces.children) - 1
        self.reached = np.zeros((width + 1, count))
        self.reached[0] = 1.0
        self.edges: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []
        for start in range(width):
            rows = np.arange(longer[start])
            node = pieces.children[0, letters[start, : len(rows)]]
            for stop in range(start + 1, width + 1):
                number = pieces.piece[node]
                known = number >= 0
                at, number = rows[known], number[known]
                if len(at):
                    way = self.reached[start, at] * chances[number]
                    self.reached[stop, at] += way
                    self.edges.append((start, stop, at, number, way))
                going = np.searchsorted(rows, longer[stop])
                rows = rows[:going]
                node = pieces.children[np.minimum(node[:going], last), letters[stop, rows]] if going else node[:0]
                alive = node >= 0
                rows, node = rows[alive], node[alive]
                if not len(rows):
                    break

    def totals(self) -> np.ndarray:
        """Sum over all segmentations, by word in sorted order."""
        return self.reached[self.sizes, np.arange(len(self.sizes))]

    def log_probabilities(self) -> np.ndarray:
        found = np.empty(len(self.sizes))
        found[self.order] = np.log(self.totals())
        return found

    def expected(self, times: np.ndarray, size: int) -> np.ndarray:
        """Expected numbers of the pieces in all words."""
        left = np.zeros_like(self.reached)  # from a place to the end
        left[self.sizes, np.arange(len(self.sizes))] = times[self.order] / self.totals()
        weights = []
        # By descending start, so all that begin where an edge ends have been seen.
        for start, stop, at, number, way in reversed(self.edges):
            rest = left[stop, at]
            weights.append(way * rest)
            left[start, at] += self.chances[number] * rest
        numbers = [number for _, _, _, number, _ in reversed(self.edges)]
        return np.bincount(np.concatenate(numbers), np.concatenate(weights), size)


def short_size(scores: list[float]) -> float:
    """Bytes of the longest word for ``ShortLattices``: a segmentation has as many pieces as
    bytes at most, each no rarer than the rarest one."""
    return SMALLEST_LOG / min(scores) - len(MARK)


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def _word_counts(batches):
    """Counts of words within a task, 0 for those of held-out texts only; the row of no word
    counts the texts learned from."""
    counts: Counter[bytes] = Counter()
    docs = 0

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([*counts.keys(), None], pa.binary()), pa.array([*counts.values(), docs], pa.int64())],
            ["word", "n"],
        )

    for batch in slices(batches, "_text"):
        for text, held in zip(texts(batch, "_text"), batch.column("_held").to_pylist()):
            if held:
                counts.update(dict.fromkeys(tokens(text), 0))
            else:
                counts.update(tokens(text))
                docs += 1
        if len(counts) >= REMEMBERED:
            yield out()
            counts.clear()
            docs = 0
    yield out()


def _word_scores(shared, scores):
    def run(batches):
        pieces, table = shared.value, scores.value
        chances, short = np.exp(table), short_size(table)
        for batch in batches:
            words = batch.column("word").to_pylist()
            found = np.empty(len(words))
            fits = np.fromiter((len(w) <= short for w in words), bool, len(words))
            some = np.flatnonzero(fits)
            if len(some):
                found[some] = ShortLattices(pieces, chances, [words[i] for i in some]).log_probabilities()
            for i in np.flatnonzero(~fits):
                found[i] = log_probability(pieces.tree, table, words[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(found, pa.float64())], ["word", "c", "own"]
            )

    return run


def _segmented(shared):
    """Piece counts of the tokenizer's own segmentation of counted words."""

    def run(batches):
        import sentencepiece

        pieces = shared.value
        processor = sentencepiece.SentencePieceProcessor(model_proto=pieces.model)
        number = np.array([*pieces.number_of, -1], np.int64)
        counts = np.zeros(pieces.end + 1)
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
            times = batch.column("n").to_numpy()
            for at in range(0, len(words), 20_000):
                coded = processor.encode(words[at : at + 20_000], num_threads=1)
                flat = number[np.fromiter((i for c in coded for i in c), np.int64)]
                weight = np.repeat(times[at : at + 20_000], [len(c) for c in coded])
                known = flat >= 0
                counts += np.bincount(flat[known], weight[known], len(counts))
        yield _piece_rows(counts)

    return run


def _expected(shared, scores):
    def run(batches):
        pieces, table = shared.value, scores.value
        chances, short = np.exp(table), short_size(table)
        counts, of_long = np.zeros(pieces.end + 1), [0.0] * (pieces.end + 1)
        for batch in batches:
            words, times = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            fits = np.fromiter((len(w) <= short for w in words), bool, len(words))
            some = np.flatnonzero(fits)
            if len(some):
                found = ShortLattices(pieces, chances, [words[i] for i in some])
                counts += found.expected(times[some], len(counts))
            for i in np.flatnonzero(~fits):
                expected_counts(pieces.tree, table, words[i], int(times[i]), of_long)
        yield _piece_rows(counts + np.array(of_long))

    return run


def _piece_rows(counts: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["piece", "n"])


def learn(words: DataFrame, docs: int, pieces: Pieces, shared, rounds: int = ROUNDS) -> list[float]:
    """Scores of the pieces and the end, from ``word`` and ``n``."""
    spark = words.sparkSession

    def gathered(run) -> np.ndarray:
        counts = np.zeros(pieces.end + 1)
        summed = words.mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        for row in summed.collect():  # at most one row for each piece of the vocabulary
            counts[row["piece"]] = row["n"]
        counts[pieces.end] = docs
        return pieces.scores(counts)

    scores = gathered(_segmented(shared))
    for _ in range(rounds):
        scores = gathered(_expected(shared, spark.sparkContext.broadcast(scores.tolist())))
    return scores.tolist()


def _scored(common):
    """A row of sums for each text, and a row for each of its words that is not frequent."""

    def run(batches):
        frequent = common.value
        number = 0
        end_log, end_score = frequent[b""]
        for batch in slices(batches, "_text", 1 << 20):
            rows, words, times, sums = [], [], [], []
            for row, text in enumerate(texts(batch, "_text")):
                count = Counter(tokens(text))
                n, k, base, score = 1, int(end_log > 0), end_log, end_score
                for word, t in count.items():
                    n += t
                    found = frequent.get(word)
                    if found is None:
                        rows.append(row)
                        words.append(word)
                        times.append(t)
                    else:
                        k += t
                        base += t * found[0]
                        score += t * found[1]
                sums += [None] * (len(rows) - len(sums))
                # A word cannot hold a space: this one is joined with nothing, and spread.
                rows.append(row)
                words.append(b" %d" % number)
                times.append(0)
                sums.append({"n_tokens": n, "n_known": k, "base": base, "score": score})
                number += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_doc").take(pa.array(rows, pa.int64())), pa.array(words, pa.binary()),
                    pa.array(times, pa.int64()), pa.array(sums, _SUMS),
                ],
                ["_doc", "word", "t", "sums"],
            )

    return run


_SUMS = pa.struct([
    ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
])


def _frequent(words: DataFrame, most: int) -> dict[bytes, tuple[float, float]]:
    """Both scores of all short words above the smallest count that not more than ``most`` reach."""
    short = words.filter((F.col("c") > 0) & (F.octet_length("word") <= SHORT))
    sizes = short.groupBy("c").agg(F.count(F.lit(1)).alias("words")).orderBy(F.col("c").desc())
    least, total = None, 0
    for row in sizes.toLocalIterator():
        total += row["words"]
        if total > most:
            break
        least = row["c"]
    if least is None:
        return {}
    found = short.filter(F.col("c") >= least).collect()  # at most ``most`` short words
    return {bytes(r["word"]): (math.log10(r["c"] + 1), r["own"]) for r in found}


def score_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model_file: str = MODEL,
    frequent: int = FREQUENT, rounds: int = ROUNDS,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    and ``score`` (log10) of every document."""
    context = docs.sparkSession.sparkContext
    key, unique = row_key(docs, doc_id, text)
    plain = docs.select(
        F.col(doc_id).alias("_name"), key.alias("_doc"), F.col(text).cast("binary").alias("_text")
    )
    name = F.coalesce(F.col("_name").cast("string"), F.lit(""))
    held_out = F.crc32(name.cast("binary")) % FOLDS == HELD_OUT
    counted = plain.select("_text", held_out.alias("_held")).mapInArrow(_word_counts, "word binary, n long")
    every = pin(counted.groupBy("word").agg(F.sum("n").alias("n")))
    words = every.filter(F.col("word").isNotNull() & (F.col("n") > 0))
    sums = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = every.filter(F.col("word").isNull()).first()
    ends = ends["n"] if ends else 0
    total, distinct = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    pieces = Pieces(model_file)
    shared = context.broadcast(pieces)
    scores = learn(words, ends, pieces, shared, rounds)
    of_words = pin(every.filter(F.col("word").isNotNull()).withColumnRenamed("n", "c").mapInArrow(
        _word_scores(shared, context.broadcast(scores)), "word binary, c long, own double"
    ))
    common = _frequent(of_words, frequent)
    common[b""] = (math.log10(ends + 1), scores[pieces.end])
    once = plain.select("_doc", "_text")
    parts = (once if unique else once.dropDuplicates(["_doc"])).mapInArrow(
        _scored(context.broadcast(common)),
        f"_doc {plain.schema['_doc'].dataType.simpleString()}, word binary, t long, "
        "sums struct<n_tokens:long,n_known:long,base:double,score:double>",
    )
    met = F.when(F.col("c") > 0, F.col("t")).otherwise(0)
    summed = parts.join(of_words, "word", "left").groupBy("_doc").agg(
        F.sum("sums.n_tokens").alias("n_tokens"),
        (F.sum("sums.n_known") + F.sum(met)).alias("n_known"),
        (F.sum("sums.base") + F.sum(F.col("t") * F.coalesce(F.log10(F.col("c") + 1), F.lit(0.0)))).alias("base"),
        (F.sum("sums.score") + F.sum(F.col("t") * F.coalesce("own", F.lit(0.0)))).alias("score"),
    )
    named = summed.withColumn("_name", F.col("_doc")) if unique else plain.select("_name", "_doc").join(summed, "_doc")
    return named.select(
        F.col("_name").alias(doc_id), held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * math.log10(total + distinct + 1)).alias("base_score"),
        (F.col("score") / math.log(10)).alias("score"),
    )
