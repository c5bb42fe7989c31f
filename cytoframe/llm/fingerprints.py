"""Document fingerprints by locally consistent parsing.

A text's code points are the symbols of level 0. At each level runs of one symbol shrink to one, and deterministic coin
tossing turns neighbouring symbols into labels: the lowest bit in which a symbol differs from its left neighbour, and
that bit's value. Four rounds leave labels below six in which neighbours still differ; local maxima begin new phrases,
whose names, hashes of their symbols, are the next level's symbols. A phrase depends on a few symbols to either side
only, so equal substrings get equal names in their interior, whatever stands before them. Names of level 2 and up are
signatures, which unrelated texts hardly share. The least names in each of 64 bins (one-permutation hashing) make the fingerprint, and the share of
equal bins among those that either text fills is the likeness. Names of level 1, phrases of a few characters that any two
texts of a language share, have 16 bins of their own; the names above share the other 48, of which a short text fills few.
One rule holds for texts of every length.

Levels are computed with numpy across all texts of a run, in as many array operations as there are levels.

Defined results: null counts as empty; a text without symbols has 64 empty bins, and two such texts have likeness 1; repeated
ids follow each other by text; a null id stands before all others; a single row is its own next document; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 64
#: The last bins, which only names of level 1 fill.
PHRASE_BINS = 16
EMPTY = "...."
#: Characters of original text in one run of numpy work.
RUN_CHARS = 1 << 20
_NONE = np.iinfo(np.int64).min


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_WEIGHTS = _mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def _coin(prev: int, cur: int) -> int:
    d = prev ^ cur
    low = (d & -d).bit_length() - 1 if d else 0
    return 2 * low + (cur >> low & 1)


#: One coin toss on labels below 128: index prev * 128 + cur.
_TOSS = np.array([_coin(p, c) for p in range(128) for c in range(128)], np.uint8)


def _labels(sym: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below six. A text's first symbol has no left neighbour and takes its lowest bit."""
    d = sym.copy()
    d[1:] ^= sym[:-1]
    d[first] = 1
    low = np.bitwise_count((d & (~d + d.dtype.type(1))) - d.dtype.type(1))
    lab = 2 * low + ((sym >> low.astype(sym.dtype)) & sym.dtype.type(1)).astype(np.uint8)
    for _ in range(3):
        at = np.empty(len(lab), np.uint16)
        at[1:] = lab[:-1]
        at[first] = lab[first] ^ 1
        lab = _TOSS[(at << 7) | lab]
    return lab


def _collapse(sym: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol become one symbol that depends on the run's length."""
    head = np.ones(len(sym), bool)
    head[1:] = sym[1:] != sym[:-1]
    head[starts] = True
    if head.all():
        return sym, starts
    at = np.flatnonzero(head)
    length = np.diff(at, append=len(sym))
    out = sym[at].astype(np.uint64)
    long = length > 1
    out[long] = _mix(out[long] * np.uint64(3) + _mix(length[long].astype(np.uint64)))
    return out, np.searchsorted(at, starts)


def signatures(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the text, name) arrays, a pair for each level from 2 up."""
    return islice(levels(texts), 1, None)


def levels(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the text, name) arrays, a pair for each level from 1 up."""
    lengths = np.array([len(t) for t in texts], np.int64)
    doc = np.flatnonzero(lengths)
    if not len(doc):
        return
    sym = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    starts = np.concatenate(([0], np.cumsum(lengths[doc])[:-1]))
    while len(doc):
        sym, starts = _collapse(sym, starts)
        lab = _labels(sym, starts)
        peak = np.zeros(len(sym), bool)
        peak[1:-1] = (lab[1:-1] > lab[:-2]) & (lab[1:-1] > lab[2:])
        last = np.concatenate((starts[1:], [len(sym)])) - 1
        peak[last] = False
        peak[starts] = True
        at = np.flatnonzero(peak)
        size = np.diff(at, append=len(sym))
        offset = np.arange(len(sym)) - np.repeat(at, size)
        name = _mix(np.add.reduceat(_mix(sym.astype(np.uint64)) * _WEIGHTS[offset & 255], at) + size.astype(np.uint64))
        starts = np.searchsorted(at, starts)
        count = np.diff(starts, append=len(at))
        single = count == 1
        yield np.repeat(doc, count), name
        if single.any():
            keep = np.repeat(~single, count)
            sym, doc, count = name[keep], doc[~single], count[~single]
            starts = np.concatenate(([0], np.cumsum(count)[:-1])).astype(np.int64)
        else:
            sym = name


def fingerprint_bins(texts: list[str]) -> np.ndarray:
    """(texts, 64) of 16-bit values in int32; -1 marks an empty bin."""
    top = np.uint64(2**64 - 1)
    low = np.full(len(texts) * BINS, top, np.uint64)
    upper = BINS - PHRASE_BINS
    for level, (doc, name) in enumerate(levels(texts), 1):
        h = _mix(name ^ np.uint64(0xA5A5A5A5))
        first, bins = (upper, PHRASE_BINS) if level == 1 else (0, upper)
        bin_ = first + ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(low, doc * BINS + bin_, h << np.uint64(32))
    out = (_mix(low) & np.uint64(0xFFFF)).astype(np.int32)
    out[low == top] = -1
    return out.reshape(-1, BINS)


def bins_text(bins: np.ndarray) -> list[str]:
    return ["".join(EMPTY if v < 0 else f"{v:04x}" for v in row) for row in bins.tolist()]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    either = ((a >= 0) | (b >= 0)).sum(axis=1)
    same = ((a >= 0) & (a == b)).sum(axis=1)
    return np.where(either == 0, 1.0, same / np.maximum(either, 1))


def edited(text: str, following: str) -> str:
    """The last half of the text, rounded down, replaced by as many characters of the next one (or all it has)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, str]]:
    """(id, text, next text) of rows sorted by part, guard, id; the next row of the part, at its end its guard row."""
    held = None
    for b in batches:
        for at in range(0, b.num_rows, 512):
            part = b.slice(at, 512).to_pydict()
            for p, guard, i, t in zip(part["_p"], part["_g"], part["_id"], part["_t"]):
                t = t or ""
                if held is not None and held[0] == p:
                    yield held[1], held[2], t
                held = None if guard else (p, i, t)


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run, size = [], 0
    for pair in _pairs(batches):
        run.append(pair)
        size += len(pair[1]) + 1
        if size >= RUN_CHARS:
            yield _run(run)
            run, size = [], 0
    if run:
        yield _run(run)


def _run(run: list[tuple[object, str, str]]) -> pa.RecordBatch:
    texts: list[str] = []
    own, nxt = [], []
    for _, a, b in run:
        if not texts or texts[-1] is not a:
            texts.append(a)
        own.append(len(texts) - 1)
        texts.append(b)
        nxt.append(len(texts) - 1)
    new = [edited(a, b) for _, a, b in run]
    bins = fingerprint_bins(texts + new)
    mine, after, changed = bins[own], bins[nxt], bins[len(texts) :]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _, _ in run], pa.int64()),
            pa.array([len(a) for _, a, _ in run], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new], pa.string()),
            pa.array(bins_text(mine), pa.string()),
            pa.array(bins_text(changed), pa.string()),
            pa.array(likeness(mine, changed), pa.float64()),
            pa.array(likeness(mine, after), pa.float64()),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Rows (_p, _g, _id, _t) dealt out by ranges of ids and sorted, each range followed by the first row of the next (_g = 1).

    Ranges come from approximate quantiles of the ids, so no id is dense enough to make one large; the last range is
    followed by the very first row. Texts are shuffled once.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or min(4096, 4 * n)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NONE)).alias("_id"), F.col(text).cast("string").alias("_t"))
    cuts = rows.agg(F.percentile_approx("_id", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] if parts > 1 else None
    splits = [float("-inf"), *sorted({float(c) for c in cuts or ()}), float("inf")]
    dealt = rows.withColumn("_p", F.lit(0)) if len(splits) < 3 else Bucketizer(splits=splits, inputCol="_d", outputCol="_b").transform(rows.withColumn("_d", F.col("_id").cast("double"))).withColumn("_p", F.col("_b").cast("int")).drop("_b", "_d")
    # one row for each range: `parts` at most
    firsts = sorted((r["_p"], r["m"]) for r in dealt.groupBy("_p").agg(F.min("_id").alias("m")).collect())
    if not firsts:
        return dealt.select("_p", F.lit(0).alias("_g"), "_id", "_t")
    ahead = [(m, firsts[k - 1][0]) for k, (_, m) in enumerate(firsts)]
    guard = spark.createDataFrame(ahead, "_id bigint, _q int")
    both = dealt.join(F.broadcast(guard), "_id", "left").withColumn("_to", F.explode(F.when(F.col("_q").isNull(), F.array(F.struct(F.col("_p").alias("p"), F.lit(0).alias("g")))).otherwise(F.array(F.struct(F.col("_p").alias("p"), F.lit(0).alias("g")), F.struct(F.col("_q").alias("p"), F.lit(1).alias("g"))))))
    out = both.select(F.col("_to.p").alias("_p"), F.col("_to.g").alias("_g"), "_id", "_t")
    return out.repartition(n, "_p").sortWithinPartitions("_p", "_g", "_id", "_t")


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited form, with likenesses to the edited form and to the next document."""
    kind = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    out = in_order(docs, doc_id, text, parts).mapInArrow(_fingerprinted, kind)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != _NONE, F.col("doc_id")))
