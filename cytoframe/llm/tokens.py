"""Words of many texts at once as numpy arrays: where they stand in the bytes, and 64-bit hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

#: Words above this many bytes are hashed by XXH64.
LONG = 256


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_WEIGHTS = mix(np.arange(1, LONG + 1, dtype=np.uint64)) | np.uint64(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def table_of(*ranges: tuple[int, int]) -> np.ndarray:
    """Which byte values separate words, from inclusive ranges."""
    out = np.zeros(256, bool)
    for lo, hi in ranges:
        out[lo : hi + 1] = True
    return out


@dataclass
class Words:
    """Words of consecutive texts: A-Z lower-cased bytes, first byte, length, hash and text of each word."""

    raw: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    hash: np.ndarray
    text: np.ndarray


def words_of(texts: list[str], separators: np.ndarray) -> Words:
    """Split texts at the separating bytes, one of which must be the line feed."""
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = _FOLD[np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)]
    apart = separators[raw]
    edge = np.flatnonzero(apart[1:] != apart[:-1]) + 1
    if len(raw) and not apart[0]:
        edge = np.concatenate(([0], edge))
    begin, end = edge[0::2], edge[1::2]
    size = end - begin
    if not len(begin):
        none = np.zeros(0, np.int64)
        return Words(raw, none, none, np.zeros(0, np.uint64), none)
    text = np.searchsorted(np.cumsum([len(c) + 1 for c in coded]), begin, side="right")
    inner = np.flatnonzero(~apart)
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    offset = np.arange(len(inner)) - np.repeat(first, size)
    value = (raw[inner].astype(np.uint64) + np.uint64(1)) * _WEIGHTS[offset & (LONG - 1)]
    h = mix(np.add.reduceat(value, first) + size.astype(np.uint64))
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(raw[begin[i] : end[i]].tobytes(), 1)
    return Words(raw, begin, size, h, text)
