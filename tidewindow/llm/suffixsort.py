"""Two-stage suffix sorting of chosen positions, and adjacent common prefixes.

Stage one sorts only the suffixes that are smaller than their successor.  Stage two takes the
buckets of the first byte in ascending order; as a bucket is passed, the suffix before each
of its suffixes, if it is larger than its successor, is the next one in its own bucket.  All
positions of a bucket are taken in one step.  Order is exact up to ``depth`` bytes, which is
all that prefixes of ``depth`` bytes need; beyond, ties fall in any order.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def words_at(text: bytes, depth: int) -> np.ndarray:
    """The eight bytes from every position as one big-endian number."""
    padded = text + bytes(depth + 2 * WORD)
    return np.ndarray((len(text) + depth + WORD,), ">u8", padded, 0, (1,)).astype(np.uint64)


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a byte later."""
    n = len(text)
    if not n:
        return np.zeros(0, bool)
    # In a run of equal bytes the first different byte after it decides.
    change = np.flatnonzero(text[1:] != text[:-1])
    after = np.append(change, n - 1)[np.searchsorted(change, np.arange(n))]
    return (after < n - 1) & (text[np.minimum(after + 1, n - 1)] > text[after])


def sort_directly(words: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    """``positions`` in the order of their suffixes, by words of eight bytes."""
    order = positions[np.argsort(words[positions], kind="stable")]
    word = words[order]
    begins = np.concatenate([[True], word[1:] != word[:-1]])
    for at in range(WORD, depth, WORD):
        tied = ~begins
        tied[:-1] |= ~begins[1:]
        rows = np.flatnonzero(tied)
        if not len(rows):
            break
        group = np.cumsum(begins[rows])
        word = words[order[rows] + at]
        inside = np.concatenate([[False], group[1:] == group[:-1]])
        uneven = inside & np.concatenate([[False], word[1:] != word[:-1]])
        if not uneven.any():
            continue
        # Only groups whose words differ are put in order.
        mixed = np.zeros(int(group[-1]) + 1, bool)
        mixed[group[uneven]] = True
        some = mixed[group]
        rows, group, word = rows[some], group[some], word[some]
        sort = np.lexsort((word, group))
        order[rows] = order[rows[sort]]
        word = word[sort]
        begins[rows[1:]] |= word[1:] != word[:-1]
    return order


def suffix_order(text: bytes, wanted: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in suffix order, and the words of the text.

    ``wanted`` marks positions.  Positions are added so that each suffix larger than its
    successor has that successor in the order too.
    """
    letters = np.frombuffer(text, np.uint8)
    words = words_at(text, depth)
    rising = smaller_than_successor(letters)
    n = len(letters)
    # From every wanted position on to the next rising one.
    fall = np.append(np.flatnonzero(rising), n - 1)
    chosen = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(wanted)
    np.add.at(chosen, at, 1)
    np.add.at(chosen, fall[np.searchsorted(fall, at)] + 1, -1)
    chosen = np.cumsum(chosen[:-1]) > 0
    direct = sort_directly(words, np.flatnonzero(chosen & rising), depth)
    induced = chosen & ~rising
    direct_bounds = np.searchsorted(letters[direct], np.arange(257)) if len(direct) else np.zeros(257, int)
    falling: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and induced[n - 1]:
        falling[letters[n - 1]].append(np.array([n - 1]))
    out = []

    def induce(passed: np.ndarray, letter: int) -> np.ndarray:
        """Hand the predecessors of a bucket to theirs; returns those of this bucket."""
        before = passed[passed > 0] - 1
        before = before[induced[before]]
        first = letters[before]
        sort = np.argsort(first, kind="stable")
        before, first = before[sort], first[sort]
        cuts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else []
        same = before[:0]
        for a, b in zip(cuts, [*cuts[1:], len(first)]):
            if first[a] == letter:
                same = before[a:b]
            else:
                falling[first[a]].append(before[a:b])
        return same

    for letter in range(256):
        here = np.concatenate(falling[letter]) if falling[letter] else direct[:0]
        while len(here):
            out.append(here)
            here = induce(here, letter)
        rise = direct[direct_bounds[letter] : direct_bounds[letter + 1]]
        if len(rise):
            out.append(rise)
            induce(rise, letter)
    return (np.concatenate(out) if out else direct), words


def common_prefixes(words: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, up to ``depth``, that each suffix shares with the one before it in the order.

    In whole words, with the rest of the first different word counted by its leading bits.
    """
    shared = np.zeros(len(order), np.int64)
    rows = np.arange(1, len(order))
    for at in range(0, depth, WORD):
        if not len(rows):
            break
        differing = words[order[rows] + at] ^ words[order[rows - 1] + at]
        ended = rows[differing != 0]
        shared[ended] += (64 - np.floor(np.log2(differing[differing != 0].astype(np.float64))).astype(np.int64) - 1) // 8
        rows = rows[differing == 0]
        shared[rows] += WORD
    return np.minimum(shared, depth)
