"""Byte-level BPE by a monoid tree reduction over each text.

The reduction has two levels, and at both a window about the seam of two halves is encoded anew, and grows, until the
tokens outside it provably cannot change.

*Text.* A text is halved until its parts are short leaves or hold no safe cut; a leaf is split by the pattern. A *safe
cut* is a place between a character that is no white space and a blank or line feed. No match of the splitting pattern
holds white space after another character, so a safe cut ends a match in every context; matches before it look no further
than it, and matches after it start afresh. The window about a seam doubles until either end of it is a safe cut.

*Match.* The UTF-8 bytes of a match are halved down to a few bytes, which a plain merge loop encodes: of all adjacent
parts whose concatenation has a rank, the least rank merges first, the leftmost of equal ones. Call two tokens *apart* if
their joint bytes encode to just these two. A sequence of tokens is the encoding of its bytes if, and only if, all of its
neighbours are apart: the first merge across a seam would also be the first one in the two tokens beside it, for merges
inside them run in the same order whatever stands around them. So a join takes tokens of the right half one at a time,
encoding them with a window of the last tokens of the left half that doubles until the token before it and the first of
the new ones are apart, and stops as soon as the next token is apart from what precedes it.

Decoding concatenates bytes up the same tree.

Defined results: null counts as the empty text, which has no tokens; characters that UTF-8 cannot hold cannot occur in
Spark strings; repeated rows give repeated results, ties cannot occur; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.common import by_text

#: Characters of a text, and bytes of a match, below which a part is not halved; tokens below which a list is not.
LEAF, LEAF_BYTES, LEAF_TOKENS = 256, 8, 64
#: Entries of each memory of a worker, which starts afresh beyond them.
REMEMBERED = 1 << 18
#: More than any rank.
_NONE = 1 << 62
_CUT = re.compile(r"\S(?=[ \n])")


@lru_cache(maxsize=2)
def vocabulary(ranks: str) -> dict[bytes, int]:
    """Bytes and rank of every token, read once in each Python worker."""
    with open(ranks, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def encoding(ranks: str, pattern: str):
    """The tiktoken encoder of the same vocabulary, to hold results against; no operator uses it."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=vocabulary(ranks), special_tokens={})


class TreeCodec:
    """Encode and decode with one vocabulary; `leaf` is the length in characters below which a part is not halved."""

    def __init__(self, ranks: str, pattern: str, leaf: int = LEAF):
        self.ranks, self.leaf, self._files = vocabulary(ranks), max(1, leaf), (ranks, pattern)
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.size_of = {v: len(k) for k, v in self.ranks.items()}
        # white space is the Unicode property; the module's own class also holds four control characters
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self._known: dict[str, tuple[int, ...]] = {}
        self._pairs: dict[tuple[int, int], tuple[int, ...] | None] = {}
        self._leaves: dict[bytes, tuple[int, ...]] = {}

    @property
    def base(self):
        return encoding(*self._files)

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf or not _CUT.search(text):
            return self._leaf(text)
        mid = len(text) // 2
        left, right = text[:mid], text[mid:]
        return self._join(left, self.encode(left), right, self.encode(right))

    def _leaf(self, text: str) -> list[int]:
        known, out = self._known, []
        for m in self.split(text):
            ids = known.get(m)
            if ids is None:
                ids = self._match(m)
            out += ids
        return out

    def _join(self, left: str, a: list[int], right: str, b: list[int]) -> list[int]:
        p, q = self._cut_before(left), self._cut_after(right)
        seam_left, seam_right = left[p:], right[:q]
        keep = self._drop(a, len(seam_left.encode()), from_end=True)
        skip = self._drop(b, len(seam_right.encode()), from_end=False)
        del a[keep:]
        a += self._leaf(seam_left + seam_right)
        a += b[skip:] if skip else b
        return a

    def _cut_before(self, left: str) -> int:
        """The last safe cut of the left part; 0, its start, where it has none."""
        width = 32
        while True:
            at = max(0, len(left) - width)
            last = None
            for last in _CUT.finditer(left, at):  # noqa: B007
                pass
            if last:
                return last.end()
            if not at:
                return 0
            width *= 2

    def _cut_after(self, right: str) -> int:
        """The first safe cut of the right part; its length, where it has none."""
        m = _CUT.search(right)
        return m.end() if m else len(right)

    def _drop(self, ids: list[int], size: int, from_end: bool) -> int:
        """How many tokens are left of (or make up) `size` bytes at one end; the cut is a token boundary."""
        k, step, size_of = (len(ids), -1, self.size_of) if from_end else (0, 1, self.size_of)
        while size > 0:
            size -= size_of[ids[k - 1] if from_end else ids[k]]
            k += step
        assert size == 0, "a safe cut must fall between tokens"
        return k

    def _match(self, m: str) -> tuple[int, ...]:
        """The tokens of one match of the pattern; a match that is a token stays whole."""
        data = m.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(data)
        # tuples of numbers are nothing that the garbage collector walks
        ids = tuple(self._halves(data)) if whole is None else (whole,)
        if len(m) <= 64:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[m] = ids
        return ids

    def _halves(self, data: bytes) -> list[int]:
        n = len(data)
        if n <= LEAF_BYTES:
            known = self._leaves.get(data)
            if known is None:
                if len(self._leaves) >= REMEMBERED:
                    self._leaves.clear()
                known = self._leaves[data] = tuple(self._merged(data))
            return list(known)
        a, b = self._halves(data[: n // 2]), self._halves(data[n // 2 :])
        pairs, at = self._pairs, 0
        for y in b:
            key = (a[-1], y)
            new = pairs[key] if key in pairs else self._pair(*key)
            if new is None:
                break
            width = 1
            while width < len(a) and not self._apart(a[-width - 1], new[0]):
                width = min(2 * width, len(a))
                new = self._merged(b"".join([self.bytes_of[i] for i in a[-width:]]) + self.bytes_of[y])
            a[-width:] = new
            at += 1
        a += b[at:] if at else b
        return a

    def _apart(self, x: int, y: int) -> bool:
        key = (x, y)
        return (self._pairs[key] if key in self._pairs else self._pair(x, y)) is None

    def _pair(self, x: int, y: int) -> tuple[int, ...] | None:
        """What the joint bytes of two tokens encode to; None where that is the two."""
        if len(self._pairs) >= REMEMBERED:
            self._pairs.clear()
        new = self._merged(self.bytes_of[x] + self.bytes_of[y])
        new = self._pairs[x, y] = None if new == [x, y] else tuple(new)
        return new

    def _merged(self, data: bytes) -> list[int]:
        """The merge loop over the ranks."""
        rank = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], _NONE) for i in range(len(data) - 1)]
        while pairs:
            least = min(pairs)
            if least == _NONE:
                break
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], _NONE)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], _NONE)
        return [self.ranks[p] for p in parts]

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_TOKENS:
            return b"".join([self.bytes_of[i] for i in ids])
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


@lru_cache(maxsize=4)
def codec_of(ranks: str, pattern: str, leaf: int = LEAF) -> TreeCodec:
    """The codec of a Python worker, which remembers matches from batch to batch."""
    return TreeCodec(ranks, pattern, leaf)


def bpe_tokens(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text", leaf: int = LEAF) -> DataFrame:
    """(doc_id, n_tokens, ids): the token ids of every whole text."""

    def work(texts: list[str]) -> list[pa.Array]:
        codec = codec_of(ranks, pattern, leaf)
        ids = [codec.encode(t) for t in texts]
        return [pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))]

    return by_text(docs, F.col(text), [F.col(doc_id)], work, "n_tokens bigint; ids array<int>").withColumnRenamed("_k0", "doc_id")


def bpe_texts(tokens: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, decoded): the bytes of each id list; null gives no bytes."""
    kind = tokens.schema[doc_id].dataType.simpleString()
    narrow = tokens.select(F.col(doc_id).alias("_k0"), F.col(ids).cast("array<int>").alias("_i"))

    def mapped(batches):
        codec = codec_of(ranks, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([codec.decode(x or []) for x in part.column(1).to_pylist()], pa.binary())], names=["_k0", "_o0"])

    return narrow.mapInArrow(mapped, f"_k0 {kind}, _o0 binary").select(F.col("_k0").alias("doc_id"), F.col("_o0").alias("decoded"))


def bpe_digests(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text", leaf: int = LEAF) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of a full round trip, without moving ids through the JVM."""

    def work(texts: list[str]) -> list[pa.Array]:
        codec = codec_of(ranks, pattern, leaf)
        n, a, b = [], [], []
        for t in texts:
            ids = codec.encode(t)
            n.append(len(ids))
            a.append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
            b.append(hashlib.sha256(codec.decode(ids)).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]

    return by_text(docs, F.col(text), [F.col(doc_id)], work, "n_tokens bigint; ids_sha256 string; decoded_sha256 string").withColumnRenamed("_k0", "doc_id")
