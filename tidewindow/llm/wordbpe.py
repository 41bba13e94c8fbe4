"""BPE encoding and decoding by dynamic programming over the prefixes of a word.

Merging pairs by rank gives every prefix of a word one last token.  A token that ends the prefix
is that one if it may stand behind the last token of the prefix before it: if merging the text of
the two gives just the two.  So an automaton over all tokens names those that end at each place,
the one that fits what stands before it is stored, and the tokens of the whole word follow from
the back pointers.  The work is linear in the length of a word, also of one of a million letters.

Whether two tokens may stand side by side is told from the symbols at their common border.  A
token is built from symbols by merges of rising rank; at its edge one symbol after the other is
consumed by the next larger one.  The two may not stand side by side if some merge would join a
symbol at the end of the left one and one at the start of the right one while both are there: if
its rank is below that of the merge that consumes the left one, and not above that of the merge
that consumes the right one (of equal merges the left one comes first).  A token that would not
come out of merging its own text never ends a prefix and is left out.  All this needs a vocabulary
in which a token comes from one merge at most, of a higher rank than those of its parts; others are
refused when they are read.

Texts are cut as the vocabulary's file says: control tokens first, taken as such wherever they
stand; then, of what is between them, NFC, lower case letter by letter, and words: contractions,
runs of letters, single digits, runs of other marks.  White space is dropped.  The last symbol of a
word is another one than the same byte inside of it.  Letters and digits are those of the tables of
``regex``; code points that became one after Unicode 16 are marks for some libraries.  Decoding writes the tokens as they are listed
in the vocabulary, with a space between them, as the file names no decoder.

The vocabulary is read on the driver and broadcast; it has a stated largest size.  Tasks
remember the words they met lately, up to a number of letters.  No shuffle takes place.

Defined results: a null or empty text has no tokens and decodes to an empty text, as do ids that
are null; invalid UTF-8 is read with replacement characters; repeated rows are rows of their
own.  Only the named columns are read, beside those asked for in ``carried``.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewindow.llm.arrow import slices

#: Where the files of public tokenizers are.
FOLDER = "/opt/tokenizers"
#: Largest vocabulary file that is broadcast.
VOCABULARY_BYTES = 64 << 20
#: Letters of remembered words in a task, and of the longest word that is remembered.
REMEMBERED, LONGEST = 1 << 22, 64

# The word pattern of the vocabulary file, and the white space that it drops.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = rf"{CONTRACTIONS}|[\p{{L}}]+|[\p{{N}}]|[^{WHITE_SPACE}\p{{L}}\p{{N}}]+"
ASCII_WORDS = rf"{CONTRACTIONS}|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand
    for themselves, the others are numbered on from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and control tokens of a BPE vocabulary whose words have ends."""

    def __init__(self, file: bytes):
        stated = json.loads(file)
        model = stated["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["byte_fallback"]:
            raise ValueError("not a BPE vocabulary with word ends")
        self.suffix: str = model["end_of_word_suffix"]
        ids: dict[str, int] = model["vocab"]
        added = {t["content"]: t["id"] for t in stated["added_tokens"]}
        self.control = {text.encode(): number for text, number in added.items()}
        self.names = [""] * (max([*ids.values(), *added.values()]) + 1)
        for text, number in [*ids.items(), *added.items()]:
            self.names[number] = text
        self._read_merges(ids, [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]])
        letters = byte_letters()
        # The symbols of a word in its automaton: a letter for each byte, and one for its end.
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + self.suffix] for c in letters]
        self._fits: dict[tuple[int, int], bool] = {}
        self._build_automaton()

    def _read_merges(self, ids: dict[str, int], merges: list[tuple[str, str]]) -> None:
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for rank, (left, right) in enumerate(merges):
            pair, whole = (ids[left], ids[right]), ids[left + right]
            if whole in self.parts:
                raise ValueError(f"{left + right!r} comes from two merges")
            if max(self.made.get(p, -1) for p in pair) >= rank or any(
                p not in self.made and len(t.removesuffix(self.suffix)) != 1
                for p, t in zip(pair, (left, right))
            ):
                raise ValueError(f"{left + right!r} is merged before its parts are")
            self.rank[pair], self.parts[whole], self.made[whole] = rank, pair, rank

    def _apart(self, left: int, right: int, limit: int) -> bool:
        """No merge below ``limit`` joins symbols across the border of two tokens."""
        left_until = right_until = limit
        while True:
            joined = self.rank.get((left, right))
            if joined is not None and joined < left_until and joined <= right_until and joined < limit:
                return False
            # Undo the later one of the merges that made the two; of equal ones the right one.
            made = self.made.get(left, -1), self.made.get(right, -1)
            if made == (-1, -1):
                return True
            if made[0] > made[1]:
                left, left_until = self.parts[left][1], made[0]
            else:
                right, right_until = self.parts[right][0], made[1]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the text of two tokens gives just the two."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= 1 << 20:
                self._fits.clear()
            known = self._fits[left, right] = self._apart(left, right, len(self.rank))
        return known

    def _build_automaton(self) -> None:
        """All tokens that come out of merging their own text."""
        text = {number: chr(number + 1) for number in [*self.inner, *self.last]}
        good = set(text)
        for whole, (left, right) in self.parts.items():  # in the order of ranks
            text[whole] = text[left] + text[right]
            if left in good and right in good and self._apart(left, right, self.made[whole]):
                good.add(whole)
        self.automaton = ahocorasick.Automaton()
        for number in good:
            self.automaton.add_word(text[number], (number, len(text[number])))
        self.automaton.make_automaton()

    def word(self, word: str) -> list[int]:
        """Ids of one word."""
        data = word.encode("utf-8", "surrogatepass")
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        tokens = [-1] * (len(symbols) + 1)  # the last token of each prefix
        sizes = [0] * (len(symbols) + 1)
        fits = self.fits
        for end, (number, size) in self.automaton.iter("".join(map(chr, (s + 1 for s in symbols)))):
            end += 1
            if tokens[end] >= 0:
                continue
            before = end - size
            if not before or (tokens[before] >= 0 and fits(tokens[before], number)):
                tokens[end], sizes[end] = number, size
        out, at = [], len(symbols)
        while at:
            out.append(tokens[at])
            at -= sizes[at]
        return out[::-1]


@lru_cache(maxsize=4)
def _vocabulary(file: bytes) -> Vocabulary:
    return Vocabulary(file)


class Encoder:
    """Texts to ids, with the words met lately."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}
        self.letters = 0
        self.ascii = regex.compile(ASCII_WORDS)
        self.any = regex.compile(WORDS)
        names = sorted(vocabulary.control, key=len, reverse=True)
        self.control = regex.compile(b"(" + b"|".join(map(regex.escape, names)) + b")") if names else None

    def _word(self, word: str) -> bytes:
        packed = np.array(self.vocabulary.word(word), "<u4").tobytes()
        if len(word) <= LONGEST:
            self.letters += len(word)
            if self.letters > REMEMBERED:
                self.known, self.letters = {}, len(word)
            self.known[word] = packed
        return packed

    def _plain(self, text: bytes) -> Iterator[bytes]:
        if text.isascii():
            words = self.ascii.findall(text.decode("ascii").lower())
        else:
            chars = unicodedata.normalize("NFC", text.decode("utf-8", "replace"))
            # Letter by letter, so a sigma at the end of a word is like any other.
            words = self.any.findall(chars.replace("Σ", "σ").lower())
        for word in words:
            # looked up anew each time, since it may be replaced on the way
            yield self.known.get(word) or self._word(word)

    def __call__(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.control is None:
            return b"".join(self._plain(text))
        out = []
        for i, part in enumerate(self.control.split(text)):  # what is between them, and they
            if i % 2:
                out.append(np.array([self.vocabulary.control[part]], "<u4").tobytes())
            else:
                out += self._plain(part)
        return b"".join(out)


def _encode(shared):
    def run(batches):
        encoder = Encoder(_vocabulary(shared.value))
        for batch in batches:
            for part in slices([batch], "_text"):
                ids = [encoder(text or b"") for text in part.column("_text").to_pylist()]
                others = [name for name in part.schema.names if name != "_text"]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in others), pa.array(ids, pa.binary())], [*others, "_ids"]
                )

    return run


def _decode(shared):
    def run(batches):
        vocabulary = _vocabulary(shared.value)
        names = np.array([name.encode() for name in vocabulary.names], object)
        for batch in batches:
            for part in slices([batch], "_ids", 1 << 20):
                texts = [
                    b" ".join(names[np.frombuffer(ids or b"", "<u4")].tolist())
                    for ids in part.column("_ids").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.binary())], [*part.schema.names, "_decoded"]
                )

    return run


def read_vocabulary(path: str) -> bytes:
    """The file of a vocabulary, read on the driver."""
    with open(path, "rb") as file:
        data = file.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return data


def encode_documents(
    docs: DataFrame, vocabulary: bytes, carried: list[str], text: str = "text", ids: str = "ids"
) -> DataFrame:
    """The ``carried`` columns and ``ids``: little-endian unsigned 32-bit integers, as shards of
    token ids hold them."""
    names = {f"_c{i}": name for i, name in enumerate(carried)}
    plain = docs.select(
        *(F.col(f"`{c}`").alias(n) for n, c in names.items()),
        F.col(f"`{text}`").cast("binary").alias("_text"),
    )
    kind = T.StructType([f for f in plain.schema if f.name in names]).add("_ids", "binary")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return plain.mapInArrow(_encode(shared), kind).withColumnsRenamed({**names, "_ids": ids})


def decode_documents(
    encoded: DataFrame, vocabulary: bytes, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encoded`` with the text that its ids stand for, in UTF-8."""
    names = {f"_c{i}": name for i, name in enumerate(encoded.columns)}
    held = {name: n for n, name in names.items()}
    plain = encoded.select(*(
        F.col(f"`{c}`").alias("_ids" if c == ids else n) for n, c in names.items()
    ))
    kind = T.StructType([*plain.schema.fields]).add("_decoded", "binary")
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    out = plain.mapInArrow(_decode(shared), kind)
    return out.select(
        *(F.col("_ids" if c == ids else held[c]).alias(c) for c in encoded.columns),
        F.col("_decoded").alias(decoded),
    )


def count_ids(ids: str | Column) -> Column:
    size = F.octet_length(F.col(ids) if isinstance(ids, str) else ids)
    return F.shiftright(F.coalesce(size, F.lit(0)).cast("long"), 2)


def token_digests(encoded: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Number of tokens, and digests of the ids and of the decoded text."""
    return encoded.select(
        doc_id, count_ids("ids").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
