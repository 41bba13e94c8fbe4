"""Line deduplication by a segment-partition edit join.

Lines take part without white space at their ends, all but the blank ones; with ``min_bytes``, those
of so many bytes.  Two lines are links if their edit distance,
counted in characters, is at most the budget of the shorter one: an edit for each ``EDIT_LENGTH`` of
its length, and ``distance`` at most.  The shortest lines have a budget of 0 and are like their
exact copies alone; those need no keys.  Lines joined by a chain of links are one class, and of
a class only the first line stays: that of the smallest document id, then of the smallest place
in the text.

A line is cut into one segment more than its budget, of nearly equal length.  So many edits leave
one of them untouched, so a similar line that is not shorter holds that segment near its
place.  Lengths and places count characters; a byte that is not
part of one counts as one.  The index key is a hash of the line's length, the segment's number and its
characters; a line probes the keys of lines shorter by up to their budget at the few places that are
possible.  The keys of many lines are made at once, from running sums over all their characters.
Only lines that meet another line under a key are read again and compared, with a banded
bit-parallel edit distance over many pairs at once.

Of two lines the shorter one is looked up by its segments; of equal length, that of the smaller
digest.  They are compared once, under the first segment of it that the other one holds, so
every linked pair is counted once.  What leaves a group is the number of links of each line, and as
many of the links as join its lines into classes; pairs are not listed.

Keys, and then the lines themselves, are made once per task for repeated lines, so copies
of a line are folded before any shuffle.  Exact copies are one class and are never compared.

Defined results: null and empty texts have no lines that take part; blank lines, and those
shorter than ``min_bytes``, are kept; lines of documents without an id come first, as nulls do; where an
id is missing or names several rows, a document is its id and text, so different texts are
different documents, and repeated rows keep or lose the same lines.  Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

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

DISTANCE = 2
#: Smallest size of a line that takes part: any that is not blank.
ALL_LINES = 1
#: A line has an edit for each so much of its length.
EDIT_LENGTH = 20
#: Lines that a task remembers to fold repeated ones.
REMEMBERED = 1 << 18
#: Lines that meet others, above which they are joined by a shuffle.
BROADCAST_LINES = 200_000
#: Rows of a block, and bytes of lines compared in one step.
BLOCK_LINES = 1024
#: Groups of which all pairs are compared together with those of other groups.
SMALL_GROUP = 8
BYTES_AT_ONCE = 4 << 20
CELLS_AT_ONCE = 8 << 20
#: Characters of lines whose keys are made together.
CHARACTERS_AT_ONCE = 1 << 20

# An odd base of the running sums, and odd factors that mix their bits.
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def lines_of(text: bytes, min_bytes: int) -> Iterator[tuple[int, bytes]]:
    """Places and stripped bytes of the lines that take part."""
    for place, line in enumerate(text.split(b"\n")):
        bare = line.strip(b" \t\n\r\x0b\x0c")
        if len(bare) >= min_bytes:
            yield place, bare


def budget(length: int, distance: int) -> int:
    """Edits that a line of this length and one that is not shorter may differ in."""
    return min(distance, length // EDIT_LENGTH)


def segments(length: int, distance: int) -> list[tuple[int, int]]:
    """Start and size of the segments; the later ones are longer by one where needed."""
    size, longer = divmod(length, distance + 1)
    sizes = [size] * (distance + 1 - longer) + [size + 1] * longer
    starts = np.cumsum([0, *sizes[:-1]]).tolist()
    return list(zip(starts, sizes))


def probes(length: int, distance: int) -> list[tuple[int, int, int, int]]:
    """Indexed length, segment number, start and size of the substrings that a line probes.

    A segment can move by no more than the edits left of it, nor, seen from the end, by
    more than those right of it.
    """
    out = []
    for indexed in range(max(1, length - distance), length + 1):
        moved, edits = length - indexed, budget(indexed, distance)
        if not edits or moved > edits:
            continue
        for i, (start, size) in enumerate(segments(indexed, edits)):
            low = max(0, start - i, start + moved - (edits - i))
            high = min(length - size, start + i, start + moved + (edits - i))
            out += [(indexed, i, at, size) for at in range(low, high + 1)]
    return out


def characters(line: bytes) -> bytes | str:
    """A line as a sequence of characters; the bytes themselves if they are ASCII."""
    return line if line.isascii() else line.decode("utf-8", "surrogateescape")


def code_points(line: bytes | str) -> np.ndarray:
    if isinstance(line, bytes):
        return np.frombuffer(line, np.uint8)
    return np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4")


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as far as they were needed."""

    def __init__(self):
        self.inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            size = max(count, 1 << 12)
            self.up, self.down = np.full((2, size), BASE, np.uint64)
            self.down[:] = self.inverse
            self.up[0] = self.down[0] = 1
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)
        return self.up[:count], self.down[:count]


_powers = _Powers()


def _mixed(sums: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    keys = sums + seeds * BASE
    for shift, factor in zip((30, 27), MIX):
        keys ^= keys >> np.uint64(shift)
        keys *= factor
    keys ^= keys >> np.uint64(31)
    return keys


def segment_key(points: np.ndarray, indexed: int, segment: int, distance: int) -> int:
    """Key of one segment, given its code points."""
    total, scale = np.zeros(1, np.uint64), np.ones(1, np.uint64)
    for at in range(0, len(points), CHARACTERS_AT_ONCE):
        part = points[at : at + CHARACTERS_AT_ONCE].astype(np.uint64) + np.uint64(1)
        up, _ = _powers(len(part) + 1)
        total += (part * up[:-1]).sum(dtype=np.uint64, keepdims=True) * scale
        scale *= up[-1:]
    return int(_mixed(total, np.array([indexed * (distance + 1) + segment], np.uint64))[0])


class _Plans:
    """What lines probe, and where their own segments are: the plans of all lengths met so far,
    one after another, so that lines of all lengths are looked up at once."""

    def __init__(self, distance: int):
        self.distance = distance
        self.place: dict[int, tuple[int, int]] = {}  # of a length: where its plan begins, and its size
        self.columns = [np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, bool, np.int64)]

    def _plan(self, length: int) -> list[np.ndarray]:
        plan = probes(length, self.distance)
        at, size = (np.array([p[k] for p in plan], np.int64) for k in (2, 3))
        seeds = np.array([p[0] * (self.distance + 1) + p[1] for p in plan], np.uint64)
        own = segments(length, budget(length, self.distance))
        first = np.array([p[0] == length and p[2] == own[p[1]][0] for p in plan], bool)
        # the place of the own segment that a probe of the same length could repeat
        place = {p[1]: k for k, p in enumerate(plan) if first[k]}
        again = [place[p[1]] if p[0] == length and not first[k] else -1 for k, p in enumerate(plan)]
        return [at, size, seeds, first, np.array(again, np.int64)]

    def add(self, lengths: set[int]) -> None:
        parts, end = [self.columns], len(self.columns[0])
        for length in lengths - self.place.keys():
            plan = self._plan(length)
            self.place[length] = (end, len(plan[0]))
            end += len(plan[0])
            parts.append(plan)
        if len(parts) > 1:
            self.columns = [np.concatenate(column) for column in zip(*parts)]

    def keys(
        self, points: np.ndarray, sizes: list[int], numbers: list[int]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of lines that lie one after another in ``points``, whether a line is indexed
        under them, and the number of the line."""
        self.add(set(sizes))
        sums = _running_sums(points)
        _, down = _powers(len(sums))
        length = np.array(sizes, np.int64)
        begin, many = np.array([self.place[n] for n in sizes], np.int64).T
        before = np.cumsum(many) - many  # keys of the lines before
        entry = np.arange(many.sum()) + np.repeat(begin - before, many)
        at, size, seeds, first, again = (column[entry] for column in self.columns)
        at += np.repeat(np.cumsum(length) - length, many)
        keys = sums[at + size]
        keys -= sums[at]
        keys *= down[at]
        keys = _mixed(keys, seeds)
        repeats = np.flatnonzero(again >= 0)
        repeats = repeats[keys[repeats] == keys[np.repeat(before, many)[repeats] + again[repeats]]]
        line = np.repeat(np.array(numbers, np.int64), many)
        if not len(repeats):
            return keys, first, line
        return tuple(np.delete(column, repeats) for column in (keys, first, line))


def _running_sums(points: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums


def line_keys(
    lines: list[bytes], distance: int, plans: dict[int, _Plans]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of lines, whether a line is indexed under them, and the number of the line."""
    some: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    texts_, sizes, numbers = [], [], []
    if distance not in plans:
        plans[distance] = _Plans(distance)
    mine = plans[distance]

    def settle() -> None:
        some.append(mine.keys(code_points("".join(texts_)), sizes, numbers))
        texts_.clear()
        sizes.clear()
        numbers.clear()

    waiting = 0
    for number, line in enumerate(lines):
        chars = line.decode("utf-8", "surrogateescape")
        if not budget(len(chars), distance):
            continue
        if len(chars) > CHARACTERS_AT_ONCE:
            some.append(_long_line_keys(code_points(chars), number, distance))
            continue
        texts_.append(chars)
        sizes.append(len(chars))
        numbers.append(number)
        waiting += len(chars)
        if waiting >= CHARACTERS_AT_ONCE:
            settle()
            waiting = 0
    if texts_:
        settle()
    if not some:
        return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.int64)
    return tuple(np.concatenate(column) for column in zip(*some))


def _long_line_keys(points: np.ndarray, number: int, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for a line too long to be summed up as a whole."""
    own = segments(len(points), budget(len(points), distance))
    keys: dict[int, bool] = {}
    for indexed, i, at, size in probes(len(points), distance):
        key = segment_key(points[at : at + size], indexed, i, distance)
        keys[key] = keys.get(key, False) or (indexed == len(points) and at == own[i][0])
    return (
        np.array(list(keys), np.uint64), np.array(list(keys.values()), bool), np.full(len(keys), number)
    )


class _Seen:
    """Whether a line was met lately in this task."""

    def __init__(self):
        self.now: set[bytes] = set()
        self.before: set[bytes] = set()

    def __call__(self, digest: bytes) -> bool:
        if digest in self.now:
            return True
        known = digest in self.before
        self.now.add(digest)
        if len(self.now) >= REMEMBERED:
            self.now, self.before = set(), self.now
        return known


def _signed(numbers) -> pa.Array:
    return pa.array(np.asarray(numbers, np.uint64).view(np.int64))


def _places(min_bytes: int, names: list[str]):
    def run(batches):
        for batch in slices(batches, "_text"):
            rows, places, digests = [], [], []
            for row, text in enumerate(texts(batch, "_text")):
                for place, line in lines_of(text, min_bytes):
                    rows.append(row)
                    places.append(place)
                    digests.append(xxhash.xxh3_128_digest(line))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c).take(pa.array(rows, pa.int64())) for c in names),
                pa.array(places, pa.int32()), pa.array(digests, pa.binary()),
            ], [*names, "_place", "_line"])

    return run


def _keys(min_bytes: int, distance: int):
    def run(batches):
        seen, plans = _Seen(), {}
        for batch in slices(batches, "_text"):
            lines, ids = [], []
            for text in texts(batch, "_text"):
                for _, line in lines_of(text, min_bytes):
                    if len(line) < EDIT_LENGTH:
                        continue  # no edits, hence no keys
                    digest = xxhash.xxh3_128_digest(line)
                    if not seen(digest):
                        lines.append(line)
                        ids.append(int.from_bytes(digest[:8], "little"))
            keys, first, number = line_keys(lines, distance, plans)
            yield pa.RecordBatch.from_arrays(
                [_signed(keys), pa.array(first), _signed(np.array(ids, np.uint64)[number])],
                ["_key", "_first", "_id"],
            )

    return run


def _whole_lines(min_bytes: int):
    def run(batches):
        seen = _Seen()
        for batch in slices(batches, "_text", 1 << 20):
            ids, digests, lines = [], [], []
            for text in texts(batch, "_text"):
                for _, line in lines_of(text, min_bytes):
                    digest = xxhash.xxh3_128_digest(line)
                    if not seen(digest):
                        ids.append(int.from_bytes(digest[:8], "little"))
                        digests.append(digest)
                        lines.append(line)
            yield pa.RecordBatch.from_arrays(
                [_signed(ids), pa.array(digests, pa.binary()), pa.array(lines, pa.binary())],
                ["_id", "_line", "_bytes"],
            )

    return run


def trimmed(x: bytes | str, y: bytes | str) -> tuple[bytes | str, bytes | str]:
    """Two lines without what they share at their ends; the edit distance stays the same."""
    low, high = 0, min(len(x), len(y))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if x[low:middle] == y[low:middle] else (low, middle - 1)
    x, y = x[low:], y[low:]
    low, high = 0, min(len(x), len(y))
    while low < high:
        middle = (low + high + 1) // 2
        same = x[len(x) - middle : len(x) - low] == y[len(y) - middle : len(y) - low]
        low, high = (middle, high) if same else (low, middle - 1)
    return x[: len(x) - low], y[: len(y) - low]


def within(short: list[bytes], long: list[bytes], distance: int) -> np.ndarray:
    """Which pairs have an edit distance of at most ``distance`` characters.

    Pairs are compared without their equal ends, those of like length together.
    """
    cut = []
    for x, y in zip(short, long):
        if not (x.isascii() and y.isascii()):
            x, y = (z.decode("utf-8", "surrogateescape") for z in (x, y))
        cut.append(trimmed(*sorted((x, y), key=len)))
    size = np.fromiter((len(y) for _, y in cut), np.int64, len(cut))
    apart = size - np.fromiter((len(x) for x, _ in cut), np.int64, len(cut))
    order = np.argsort(size, kind="stable")
    order = order[apart[order] <= distance]
    ok = np.zeros(len(cut), bool)
    at = 0
    while at < len(order):
        # The longest of a part comes last and sets its width.
        grown = np.arange(1, len(order) - at + 1) * (size[order[at:]] + 2 * distance + 2)
        end = at + max(1, int(np.searchsorted(grown, CELLS_AT_ONCE, "right")))
        part = [cut[i] for i in order[at:end]]
        ok[order[at:end]] = _banded([x for x, _ in part], [y for _, y in part], distance)
        at = end
    return ok


def _banded(short: list[bytes | str], long: list[bytes | str], distance: int) -> np.ndarray:
    """Bit-parallel on a band: bit ``b`` of a pair's words stands for the diagonal ``b`` places
    from the lowest one, so each pair needs one machine word, and one step of a few word
    operations serves all pairs.
    """
    count = len(short)
    n = np.fromiter(map(len, short), np.int64, count)
    m = np.fromiter(map(len, long), np.int64, count)
    ok = np.zeros(count, bool)
    width, steps = 2 * distance + 1, int(n.max())
    # Rows of ``long`` begin with ``distance`` places that match nothing.
    a = np.full((count, steps), -1, np.int32)
    b = np.full((count, steps + width + 1), -2, np.int32)
    for i, (x, y) in enumerate(zip(short, long)):
        a[i, : len(x)] = code_points(x)
        b[i, distance : distance + len(y)] = code_points(y)
    # reach[e]: diagonals that can be reached with e edits up to the current row.
    mask = np.uint32((1 << width) - 1)
    reach = [
        np.full(count, sum(1 << (distance + k) for k in range(e + 1)), np.uint32)
        for e in range(distance + 1)
    ]
    one = np.uint32(1)
    alive, final = np.arange(count), m - n + distance
    for step in range(steps):
        done = n[alive] == step
        if done.any():
            ended = alive[done]
            ok[ended] = (reach[distance][done] >> final[ended].astype(np.uint32)) & 1 > 0
            alive, reach = alive[~done], [r[~done] for r in reach]
        if not len(alive):
            return ok
        letter = a[alive, step]
        equal = np.zeros(len(alive), np.uint32)
        for k in range(width):
            equal |= (b[alive, step + k] == letter).astype(np.uint32) << np.uint32(k)
        following = []
        for e in range(distance + 1):
            now = reach[e] & equal
            if e:
                # Replaced; left out of the long line's side; put into it.
                now |= reach[e - 1] | (reach[e - 1] >> one) | (following[e - 1] << one)
            following.append(now & mask)
        reach = following
        gone = reach[distance] == 0
        if gone.any():
            alive, reach = alive[~gone], [r[~gone] for r in reach]
            if not len(alive):
                return ok
    ok[alive] = (reach[distance] >> final[alive].astype(np.uint32)) & 1 > 0
    return ok


class _Group:
    """The lines that meet under one key."""

    def __init__(self, table: pa.Table, distance: int):
        self.distance = distance
        name = table.column("_group")[0].as_py()
        self.key, self.across = name["_key"] % (1 << 64), name["a"] != name["b"]
        self.lines = [x or b"" for x in table.column("_bytes").to_pylist()]
        self.names = table.column("_line").to_pylist()
        self.block = table.column("_block").to_numpy()
        self.first = table.column("_first").to_numpy()
        self.points = [code_points(characters(x)).astype(np.uint32, copy=False) for x in self.lines]
        self.length = np.fromiter(map(len, self.points), np.int64, len(self.points))
        self.rank = np.empty(len(self.names), np.int64)
        self.rank[sorted(range(len(self.names)), key=self.names.__getitem__)] = np.arange(len(self.names))

    def partners(self, row: int) -> np.ndarray:
        """Rows that ``row`` is to be compared with under this key, of which no other key tells."""
        size = int(self.length[row])
        edits = budget(size, self.distance)
        longer = (self.length > size) & (self.length <= size + edits)
        fits = longer | (self.length == size) & (self.rank > self.rank[row])
        if self.across:  # of two blocks, one of which may have no rows
            fits &= self.block != self.block[row]
        rest = np.flatnonzero(fits)
        own = segments(size, edits)
        points = self.points[row]
        for i, (start, wide) in enumerate(own):
            segment = points[start : start + wide]
            if not len(rest) or segment_key(segment, size, i, self.distance) == self.key:
                break
            # a line that holds an earlier segment is compared under that one
            held = np.zeros(len(rest), bool)
            for moved in range(edits + 1):
                some = np.flatnonzero(self.length[rest] == size + moved)
                low = max(0, start - i, start + moved - (edits - i))
                high = min(size + moved - wide, start + i, start + moved + (edits - i))
                for at in range(low, high + 1):
                    held[some] |= self._holds(rest[some], at, segment)
            rest = rest[~held]
        return rest

    def _holds(self, rows: np.ndarray, at: int, segment: np.ndarray) -> np.ndarray:
        many = max(1, BYTES_AT_ONCE // (4 * max(1, len(segment))))
        out = np.zeros(len(rows), bool)
        for begin in range(0, len(rows), many):
            part = rows[begin : begin + many]
            taken = np.stack([self.points[r][at : at + len(segment)] for r in part])
            out[begin : begin + many] = (taken == segment).all(axis=1)
        return out


def _line_links(distance: int):
    """Rows ``a``, ``b``, ``n``: a link that joins lines into a class, or without ``b`` the number
    of links of a line that were found in one group."""

    def rows(left, right, counts):
        names = list(counts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(left + names, pa.binary()), pa.array(right + [None] * len(names), pa.binary()),
                pa.array([0] * len(left) + [counts[n] for n in names], pa.int64()),
            ],
            ["a", "b", "n"],
        )

    def run(batches):
        left, right, counts = [], [], Counter()
        waiting, size = [], 0

        def settle():
            for edits in range(1, distance + 1):
                some = [w for w in waiting if w[4] == edits]
                near = within([w[0] for w in some], [w[1] for w in some], edits)
                for at in np.flatnonzero(near):
                    _, _, a, b, _ = some[at]
                    left.append(a)
                    right.append(b)
                    counts.update((a, b))
            waiting.clear()

        for table in groups(batches):
            group = _Group(table, distance)
            lines, names, forest = group.lines, group.names, Forest(len(group.lines))
            for row in np.flatnonzero(group.first):
                edits = budget(int(group.length[row]), distance)
                rest = group.partners(row)
                if len(lines) <= SMALL_GROUP:
                    waiting += [(lines[row], lines[j], names[row], names[j], edits) for j in rest]
                    size += len(lines[row]) * len(rest)
                    continue
                many = max(1, BYTES_AT_ONCE // int(group.length[row] + edits))
                for at in range(0, len(rest), many):
                    part = rest[at : at + many]
                    linked = part[within([lines[row]] * len(part), [lines[j] for j in part], edits)]
                    if len(linked):
                        counts[names[row]] += len(linked)
                        counts.update(names[j] for j in linked)
                    for other in forest.link(row, linked):
                        left.append(names[row])
                        right.append(names[other])
            if size >= BYTES_AT_ONCE:
                settle()
                size = 0
            if len(left) + len(counts) >= 50_000:
                yield rows(left, right, counts)
                left, right, counts = [], [], Counter()
        settle()
        yield rows(left, right, counts)

    return run


def line_links(plain: DataFrame, distance: int = DISTANCE, min_bytes: int = ALL_LINES) -> DataFrame:
    """Links between the digests of different lines of ``_text``, and numbers of links: see
    ``_line_links``."""
    keyed = plain.select("_text").mapInArrow(
        _keys(min_bytes, distance), "_key long, _first boolean, _id long"
    )
    met = pin(meeting_rows(keyed).distinct())
    wanted = pin(met.select("_id").distinct())
    lines = plain.select("_text").mapInArrow(
        _whole_lines(min_bytes), "_id long, _line binary, _bytes binary"
    )
    few = wanted.count() <= BROADCAST_LINES
    lines = lines.join(F.broadcast(wanted) if few else wanted, "_id", "left_semi")
    lines = lines.groupBy("_line").agg(F.first("_id").alias("_id"), F.first("_bytes").alias("_bytes"))
    rows = met.join(lines, "_id").select("_key", "_first", "_id", "_line", "_bytes")
    return grouped(rows, BLOCK_LINES).mapInArrow(_line_links(distance), "a binary, b binary, n long")


def _text_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("binary"), F.lit(b"")), 256)


def _placed(
    docs: DataFrame, doc_id: str, text: str, distance: int, min_bytes: int
) -> tuple[DataFrame, list[str]]:
    """The lines with ``_here`` and ``_head``, the first of their class, and the fields of both
    that name a document: ``_doc``, and ``_same`` where ids do not name one row each."""
    single = row_key(docs, doc_id, text)[1]
    names = ["_doc"] if single else ["_doc", "_same"]
    plain = docs.select(
        F.col(doc_id).alias("_doc"), *([] if single else [_text_digest(F.col(text)).alias("_same")]),
        F.col(text).cast("binary").alias("_text"),
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema if f.name in names)
    places = pin(plain.mapInArrow(_places(min_bytes, names), f"{kinds}, _place int, _line binary"))
    links = pin(line_links(plain, distance, min_bytes))
    found = components(links.where(F.col("b").isNotNull())).join(
        links.where(F.col("b").isNull()).groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("_links")), "node"
    )
    here = F.struct(*names, "_place")
    first = places.groupBy("_line").agg(F.min(here).alias("_first"), F.count(F.lit(1)).alias("_times"))
    # A line met once and without links is its own class and needs no row here.
    named = first.join(found, first["_line"] == found["node"], "left").filter(
        (F.col("_times") > 1) | F.col("root").isNotNull()
    ).select(F.col("_line").alias("_name"), "_first", F.coalesce("root", "_line").alias("_root"), "_links")
    heads = named.groupBy("_root").agg(F.min("_first").alias("_head"))
    # Pinned, so that the last join has plain exchanges and a line of many copies is split.
    classes = pin(named.join(heads, "_root").select("_name", "_head", "_links"))
    return places.join(classes, F.col("_line") == F.col("_name"), "left").select(
        here.alias("_here"), F.coalesce(F.col("_head"), here).alias("_head"),
        F.coalesce("_links", F.lit(0)).cast("long").alias("_links"),
    ), names


def line_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    distance: int = DISTANCE, min_bytes: int = ALL_LINES,
) -> DataFrame:
    """One row for each line that takes part: ``doc_id``, ``line``, ``class_doc``,
    ``class_line`` (the first line of its class), ``kept``, and ``n_links``, the number of
    other texts within the distance of its own; copies are not counted."""
    here, head = F.col("_here"), F.col("_head")
    return _placed(docs, doc_id, text, distance, min_bytes)[0].select(
        here["_doc"].alias(doc_id), here["_place"].cast("long").alias("line"),
        head["_doc"].alias("class_doc"), head["_place"].cast("long").alias("class_line"),
        here.eqNullSafe(head).alias("kept"), F.col("_links").alias("n_links"),
    )


def without_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = None,
    distance: int = DISTANCE, min_bytes: int = ALL_LINES,
) -> DataFrame:
    """``docs`` without the lines that are not kept; ``length`` names a column for the new
    number of characters.  Documents of which nothing but white space is left are dropped if
    they have lost a line; all others stay, with all their columns."""
    placed, known = _placed(docs, doc_id, text, distance, min_bytes)
    lost = placed.filter(~F.col("_here").eqNullSafe(F.col("_head"))).groupBy(
        *(F.col("_here")[c].alias(c) for c in known)
    ).agg(F.collect_set(F.col("_here")["_place"]).alias("_lost"))
    names = [f.name for f in docs.schema]
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"))
    same = F.col(f"_row.`{doc_id}`").eqNullSafe(F.col("_doc"))
    if "_same" in known:
        held = held.withColumn("_digest", _text_digest(F.col(f"_row.`{text}`")))
        same &= F.col("_digest") == F.col("_same")
    joined = held.join(lost, same, "left")
    old = F.col(f"_row.`{text}`")
    lines = F.split(old, "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "_lost")
    lines = F.transform(places, lambda i: F.get(lines, i))
    untouched = F.col("_lost").isNull()
    kept = joined.withColumn("_rest", F.when(untouched, old).otherwise(F.array_join(lines, "\n"))).filter(
        untouched | F.col("_rest").rlike(r"[^\x20\x09-\x0D]")
    )
    new = {text: F.col("_rest")}
    if length:
        new[length] = F.when(untouched, F.col(f"_row.`{length}`")).otherwise(
            F.length("_rest").cast(docs.schema[length].dataType)
        )
    return kept.select(*(new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in names))
