"""Feature search inside the row: packed sequences and tables of all features that go to every task.

Bases are packed at two bits. Distances are tried from 0 upwards and a read leaves as soon as it has a feature, or two at
one distance, so with many features hardly any read is compared at the larger distances. At each distance either all words that
far from a window are looked up, or, where that is less work, a pigeonhole table: a window within d mismatches of a feature
holds one of d + 1 pieces of it unchanged, and the distance to what is found is one XOR and a bit count. Letters other than A, C,
G and T differ from every base. Reads are not shuffled.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Features, and bases of all of them, that the tables may hold: they go to every task.
MOST_FEATURES, MOST_BASES = 1 << 21, 1 << 26
#: Pairs of a window and a feature, or of a window and a word near it, that are looked at together.
PAIRS = 1 << 21
#: Words at one distance from a window that are looked up at most; beyond that pieces are.
MOST_WORDS = 1 << 14
#: Bases of features that are found by one access to a list of all words rather than by bisection.
DENSE_WIDTH = 11
#: Reads, and letters of them with what pads them to one length, that are searched together.
ROWS, LETTERS = 1 << 13, 1 << 20
_CODE = np.full(256, 4, np.uint8)
_CODE[[65, 67, 71, 84]] = range(4)
_LOW = np.uint64(0x5555555555555555)
_FAR = np.int64(1 << 62)


def codes_of(texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of base codes, lengths); beyond a text's end stands 5."""
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    texts = texts.fill_null("")
    if pc.sum(pc.binary_length(texts)).as_py() == pc.sum(pc.utf8_length(texts)).as_py():
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        edge = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[edge[0] : edge[-1]]
        size = np.diff(edge)
    else:
        # a letter beyond ASCII is one letter
        one = [t.encode("ascii", "replace") for t in texts.to_pylist()]
        raw, size = np.frombuffer(b"".join(one), np.uint8), np.array([len(r) for r in one], np.int64)
    out = np.full((len(size), int(size.max()) if len(size) else 0), 5, np.uint8)
    out[np.arange(out.shape[1])[None] < size[:, None]] = _CODE[raw]
    return out, size


def packed_windows(codes: np.ndarray, at: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(packed bases, low bits set where no base stands) of columns at to at + width, 32 at most."""
    word, odd = np.zeros(len(codes), np.uint64), np.zeros(len(codes), np.uint64)
    for c in codes[:, at : at + width].T:
        word = word << np.uint64(2) | (c & 3).astype(np.uint64)
        odd = odd << np.uint64(2) | (c > 3).astype(np.uint64)
    return word, odd


@cache
def changes(width: int, distance: int) -> np.ndarray:
    """What to XOR a packed word with for all words that differ from it at exactly `distance` places."""
    out = [0]
    if distance:
        out = [sum(v << 2 * p for p, v in zip(at, by)) for at in itertools.combinations(range(width), distance) for by in itertools.product((1, 2, 3), repeat=distance)]
    return np.array(out, np.uint64)


def expanded(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, element) for every element of the ranges [lo, hi)."""
    size = hi - lo
    row = np.repeat(np.arange(len(lo)), size)
    return row, np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + lo[row]


class Group:
    """The features of one length. Tables are made in the task that needs them."""

    def __init__(self, index: np.ndarray, codes: np.ndarray):
        self.index, self.codes, self.width = index.astype(np.int32), codes, codes.shape[1]
        self._words, self._tables, self._known, self._costs = None, {}, None, {}

    def __getstate__(self):
        return self.index, self.codes

    def __setstate__(self, state):
        self.__init__(*state)

    @property
    def words(self) -> list[np.ndarray]:
        if self._words is None:
            self._words = [packed_windows(self.codes, k, min(32, self.width - k))[0] for k in range(0, self.width, 32)]
        return self._words

    def tables(self, distance: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, length, sorted codes, features) of each of distance + 1 pieces."""
        if distance not in self._tables:
            edges = [i * self.width // (distance + 1) for i in range(distance + 2)]
            # where a window may differ everywhere, one empty piece that all share leaves all features to compare
            cuts = [(0, 0)] if distance >= self.width else list(zip(edges, edges[1:]))
            made = []
            for a, b in cuts:
                # a longer piece is known by its first 31 bases
                key = packed_windows(self.codes, a, min(b - a, 31))[0]
                order = np.argsort(key, kind="stable")
                made.append((a, min(b - a, 31), key[order], order.astype(np.int32)))
            self._tables[distance] = made
        return self._tables[distance]

    def known(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
        """(distinct words, feature of each, a second feature of it or -1, place of every possible word among them or None)."""
        if self._known is None:
            order = np.argsort(self.words[0], kind="stable").astype(np.int32)
            key = self.words[0][order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            several = np.diff(np.append(first, len(key))) > 1
            second = np.where(several, order[np.minimum(first + 1, len(order) - 1)], -1)
            dense = None
            if self.width <= DENSE_WIDTH:
                dense = np.full(1 << 2 * self.width, -1, np.int32)
                dense[key[first].astype(np.int64)] = np.arange(len(first), dtype=np.int32)
            self._known = key[first], order[first], second, dense
        return self._known

    def by_words(self, distance: int) -> bool:
        """Whether looking up the words at this distance is less work than comparing what shares a piece."""
        if distance not in self._costs:
            n = math.comb(self.width, distance) * 3**distance if self.width <= 32 else MOST_WORDS + 1
            # features that a feature shares its pieces with, as a window that resembles one does
            met = 0.0
            if 64 < n <= MOST_WORDS:
                for _, _, key, _ in self.tables(distance):
                    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
                    met += 4 + float((np.diff(edge).astype(float) ** 2).sum()) / len(key)
            self._costs[distance] = n <= 64 or (n <= MOST_WORDS and n * (1 if self.width <= DENSE_WIDTH else 4) < 4 * met)
        return self._costs[distance]

    def at_distance(self, codes: np.ndarray, at: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, feature) for windows at `at` and the features at exactly this distance; of features with one sequence two at least,
        the first among them; repeats are possible."""
        if not self.by_words(distance):
            for row, feature, far, _ in self.pairs(codes, at, distance):
                hit = far == distance
                yield row[hit], feature[hit]
            return
        word, odd = packed_windows(codes, at, self.width)
        strange = np.bitwise_count(odd)
        clean = np.flatnonzero(odd == 0)
        yield from self._looked_up(word[clean], clean, changes(self.width, distance))
        rest = np.flatnonzero((odd != 0) & (strange <= distance))
        if len(rest):
            # letters that are no base count whatever stands there in the feature
            for k in range(distance + 1):
                by = changes(self.width, k)
                off = (by | by >> np.uint64(1)) & _LOW
                step = max(1, PAIRS // len(by))
                for i in range(0, len(rest), step):
                    part = rest[i : i + step]
                    far = np.bitwise_count(off[None] & ~odd[part][:, None]) + strange[part][:, None]
                    r, c = np.nonzero(far == distance)
                    yield from self._found(word[part][r] ^ by[c], part[r])

    def _looked_up(self, word: np.ndarray, row: np.ndarray, by: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, PAIRS // len(by))
        for i in range(0, len(word), step):
            near = (word[i : i + step, None] ^ by[None]).ravel()
            yield from self._found(near, np.repeat(row[i : i + step], len(by)))

    def _found(self, word: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        key, first, second, dense = self.known()
        if dense is not None:
            place = dense[word.astype(np.int64)]
            hit = np.flatnonzero(place >= 0)
            place = place[hit]
        else:
            place = np.minimum(np.searchsorted(key, word), len(key) - 1)
            hit = np.flatnonzero(key[place] == word)
            place = place[hit]
        yield row[hit], self.index[first[place]]
        more = np.flatnonzero(second[place] >= 0)
        if len(more):
            yield row[hit[more]], self.index[second[place[more]]]

    def pairs(self, codes: np.ndarray, at: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(row, feature, mismatches, of which no base) of windows at `at` and the features that share one of distance + 1 pieces; repeats are possible."""
        windows = [packed_windows(codes, at + k, min(32, self.width - k)) for k in range(0, self.width, 32)]
        strange = sum(np.bitwise_count(odd).astype(np.int64) for _, odd in windows)
        for a, n, keys, order in self.tables(distance):
            word, odd = packed_windows(codes, at + a, n)
            lo, hi = np.searchsorted(keys, word), np.searchsorted(keys, word, side="right")
            hi = np.where(odd == 0, hi, lo)
            ends = np.cumsum(hi - lo)
            start = 0
            while start < len(lo):
                done = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
                row, e = expanded(lo[start:stop], hi[start:stop])
                row, feature = row + start, order[e]
                far = strange[row].copy()
                for (word_, odd_), own in zip(windows, self.words):
                    x = word_[row] ^ own[feature]
                    far += np.bitwise_count((x | x >> np.uint64(1)) & _LOW & ~odd_[row])
                yield row, self.index[feature], far, strange[row]
                start = stop


class Nearest:
    """For each row the feature of least distance so far, whether another has the same one, and the place."""

    def __init__(self, rows: int):
        self.key, self.shared, self.place = np.full(rows, _FAR), np.zeros(rows, bool), np.zeros(rows, np.int64)

    def add(self, row: np.ndarray, feature: np.ndarray, far: np.ndarray, place: int) -> None:
        keep = far <= self.key[row] >> 32
        row, new = row[keep], far[keep] << 32 | feature[keep]
        before = self.key.copy()
        np.minimum.at(self.key, row, new)
        # a closer feature starts anew; another feature of the same distance is a tie, and the first place of a feature stays
        closer = (self.key >> 32) < (before >> 32)
        self.shared[closer] = False
        tie = ((self.key >> 32) == (before >> 32)) & (self.key != before)
        self.shared |= tie
        self.place[closer] = place
        same = (new >> 32) == (self.key[row] >> 32)
        self.shared[row[same & (new != self.key[row])]] = True


class Features:
    """The tables of all features for searches up to a distance."""

    def __init__(self, sequences: list[str] | pa.Array, distance: int):
        codes, size = codes_of(sequences)
        self.distance = distance
        self.groups = [Group(own := np.flatnonzero(size == n), np.ascontiguousarray(codes[own, :n])) for n in np.unique(size[size > 0]).tolist()]

    def scan(self, codes: np.ndarray, size: np.ndarray, distance: int, most: np.ndarray | None = None) -> Nearest:
        """The nearest feature within the distance (of each read within `most`) over all places of each read."""
        best = Nearest(len(codes))
        most = np.full(len(codes), distance, np.int64) if most is None else most
        for far in range(distance + 1):
            todo = np.flatnonzero((best.key == _FAR) & (most >= far))
            if not len(todo):
                break
            for place in range(codes.shape[1]):
                # a second feature at the least distance settles a read
                todo = todo[~best.shared[todo]]
                for g in self.groups:
                    fit = todo[size[todo] >= place + g.width]
                    if len(fit):
                        for row, feature in g.at_distance(codes[fit, place : place + g.width], 0, far):
                            best.add(fit[row], feature, np.full(len(row), far, np.int64), place + 1)
        return best

    def fixed(self, codes: np.ndarray, size: np.ndarray, at: int, distance: int, max_n: int) -> Nearest:
        """The feature at one place: exact, else the only one that differs at letters that are no base (max_n at most), else the nearest."""
        exact, blank, close = (Nearest(len(codes)) for _ in range(3))

        def add(best: Nearest, rows: np.ndarray, far: int, cost: int, strange: bool = False) -> None:
            for g in self.groups:
                fit = rows[size[rows] >= at - 1 + g.width]
                window = codes[fit, at - 1 : at - 1 + g.width]
                if strange:
                    own = (window > 3).sum(axis=1) == far
                    fit, window = fit[own], window[own]
                if len(fit):
                    for row, feature in g.at_distance(window, 0, far):
                        best.add(fit[row], feature, np.full(len(row), cost, np.int64), at)

        add(exact, np.arange(len(codes)), 0, 0)
        none = np.flatnonzero(exact.key == _FAR)
        odd = none[(codes[none, at - 1 :] == 4).any(axis=1)]
        for far in range(1, max_n + 1):
            # as far as there are strange letters: the feature differs at these alone
            add(blank, odd, far, 0, strange=True)
        # several exact features leave the read without one; several ways to resolve its Ns leave it to the nearest
        free = (blank.key == _FAR) | blank.shared
        for far in range(1, distance + 1):
            add(close, np.flatnonzero((exact.key == _FAR) & free & (close.key == _FAR)), far, far)
        return _chosen(exact, _chosen(blank, close, free), exact.key == _FAR)

    def contained(self, codes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) of every feature that a read holds, each pair once."""
        rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for place in range(codes.shape[1]):
            for g in self.groups:
                fit = np.flatnonzero(size >= place + g.width)
                if len(fit):
                    for row, feature, far, _ in g.pairs(codes[fit], place, 0):
                        rows.append(fit[row[far == 0]])
                        found.append(feature[far == 0])
        pair = np.unique(np.stack((np.concatenate(rows), np.concatenate(found))), axis=1)
        return pair[0], pair[1]


def _chosen(first: Nearest, second: Nearest, free: np.ndarray) -> Nearest:
    out = Nearest(len(free))
    for name in ("key", "shared", "place"):
        setattr(out, name, np.where(free, getattr(second, name), getattr(first, name)))
    return out


def collected(features: DataFrame) -> tuple[pa.Array, pa.Array] | None:
    """(names, sequences) of the features, or None if they are too many or too long to be sent to every task."""
    rows = features.select(F.col("feature").cast("string").alias("feature"), F.col("sequence").cast("string").alias("sequence")).where("sequence is not null")
    # no more than the bound is ever counted or fetched
    n, bases = rows.limit(MOST_FEATURES + 1).agg(F.count("*"), F.sum(F.length("sequence"))).first()
    if n > MOST_FEATURES or (bases or 0) > MOST_BASES:
        return None
    # as columns: rows of Python objects would take ten times the memory
    found = rows.toArrow().sort_by([("feature", "ascending"), ("sequence", "ascending")])
    return tuple(pa.concat_arrays(found.column(k).cast(pa.string()).chunks) if n else pa.array([], pa.string()) for k in (0, 1))


_SHAPE = "feature string, distance int, place int"


#: Bytes of reads that one core should have at least before an input counts as large; larger inputs have splits enough.
SPLIT_BYTES = 128 << 20


def spread(rows: DataFrame) -> DataFrame:
    """A small table dealt out to all cores, since the search costs far more than a shuffle of it; a large one as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.repartition(cores) if size < cores * SPLIT_BYTES else rows


def _mapped(reads: DataFrame, work, schema: str) -> DataFrame:
    kind = dict(reads.dtypes)["read_id"]
    return spread(reads.select("read_id", "read")).mapInArrow(work, f"read_id {kind}, {schema}")


def _rows(batch: pa.RecordBatch, names: pa.Array, best: Nearest, also: Nearest | None = None) -> pa.RecordBatch:
    """The read's own feature where one alone is nearest; of a second search where that is strictly closer."""
    key, shared, place = best.key, best.shared | (best.key == _FAR), best.place
    if also is not None:
        better = ~(also.shared | (also.key == _FAR)) & (shared | ((also.key >> 32) < (key >> 32)))
        key, shared, place = np.where(better, also.key, key), np.where(better, False, shared), np.where(better, also.place, place)
    at = np.flatnonzero(~shared)
    feature = names.take(pa.array(key[at] & 0xFFFFFFFF))
    return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), feature, pa.array(key[at] >> 32, pa.int32()), pa.array(place[at], pa.int32())], names=["read_id", "feature", "distance", "place"])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            part = b.slice(i, ROWS)
            longest = pc.max(pc.utf8_length(part.column(1))).as_py() or 1
            step = max(1, LETTERS // longest)
            for k in range(0, part.num_rows, step):
                own = part.slice(k, step)
                yield own, *codes_of(own.column(1))


def scan_reads(reads: DataFrame, names: pa.Array, sequences: pa.Array, distance: int) -> DataFrame:
    table = Features(sequences, distance)

    def run(batches):
        for b, codes, size in _batches(batches):
            yield _rows(b, names, table.scan(codes, size, distance))

    return _mapped(reads, run, _SHAPE)


def fixed_reads(reads: DataFrame, names: pa.Array, sequences: pa.Array, at: int, distance: int, max_n: int) -> DataFrame:
    table = Features(sequences, max(distance, max_n))

    def run(batches):
        for b, codes, size in _batches(batches):
            yield _rows(b, names, table.fixed(codes, size, at, distance, max_n))

    return _mapped(reads, run, _SHAPE)


def fixed_or_scanned_reads(reads: DataFrame, names: pa.Array, sequences: pa.Array, at: int, distance: int, max_n: int) -> DataFrame:
    table = Features(sequences, max(distance, max_n))

    def run(batches):
        for b, codes, size in _batches(batches):
            here = table.fixed(codes, size, at, distance, max_n)
            # the whole read matters only where it may be closer
            most = np.where(here.shared | (here.key == _FAR), distance, (here.key >> 32) - 1)
            yield _rows(b, names, here, table.scan(codes, size, distance, most))

    return _mapped(reads, run, _SHAPE)


def contained_in_reads(reads: DataFrame, names: pa.Array, sequences: pa.Array) -> DataFrame:
    table = Features(sequences, 0)

    def run(batches):
        for b, codes, size in _batches(batches):
            row, feature = table.contained(codes, size)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), names.take(pa.array(feature))], names=["read_id", "feature"])

    return _mapped(reads, run, "feature string")
