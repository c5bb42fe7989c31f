"""Quality by compression: which of two zstandard dictionaries, built from good and from bad text, packs a text better.

A text is cut into blocks of 1024 bytes, so that the dictionaries rather than the text's own repeats explain its bytes
throughout. For each block both dictionaries compress it, and the difference of the two sizes, normalised by the block's
length and clipped to 0.1 (a verbatim match with a dictionary is no stronger evidence than that), is averaged over the
text. A logistic calibration turns that difference into a probability, with the text's plain compressibility and the
logarithm of its length, and the latter's product with the difference, as further terms: a difference means less in a
short text. Dictionaries are built from one half of a bounded sample of labelled rows, the calibration is fitted on the
other half, and class shares in all labelled rows of the training folds set the intercept.

Defined results: null and empty texts get a score as well (that of no bytes); labels that are null, and labelled ids
without a document, are ignored; with no good or no bad labelled text every score is the share of good labels (0.5
without labels); repeated rows and equal texts give equal scores; null ids and extra columns do no harm.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.common import by_text, checkpoint, fold_of, least_hashes

#: Chosen by `cross_validated` in the training folds alone; see the README.
BLOCK = 1024
CLIP = 0.1
LEVEL = 3
DICT_BYTES = 112 << 10
#: Labelled rows of each class that the fit sees at most, and characters of each, from a place that its hash picks.
SAMPLE, EXCERPT = 3000, 20_000
THRESHOLD = 0.7


@dataclass
class QualityModel:
    good: bytes | None
    bad: bytes | None
    raw: bool
    weights: list[float]
    block: int = BLOCK
    clip: float = CLIP

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Holds the two compressors of one Python worker."""

    def __init__(self, model: QualityModel):
        self.w, self.block, self.clip = np.array(model.weights), model.block, model.clip
        kind = zstandard.DICT_TYPE_RAWCONTENT if model.raw else zstandard.DICT_TYPE_AUTO
        self.pack = [] if model.good is None else [_packer(zstandard.ZstdCompressionDict(d, dict_type=kind)) for d in (model.good, model.bad)]

    def features(self, text: str) -> list[float]:
        data = text.encode("utf-8", "surrogatepass")
        good, bad = (p.compress for p in self.pack)
        small = mean = 0.0
        for at in range(0, max(len(data), 1), self.block):
            part = data[at : at + self.block]
            a, b = len(good(part)), len(bad(part))
            small += a
            mean += max(-self.clip, min(self.clip, (b - a) / max(len(part), 1))) * len(part)
        n = max(len(data), 1)
        mean, size = mean / n, math.log(n)
        return [1.0, mean, small / n, size, mean * size]

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.pack:
            return np.full(len(texts), self.w[0])
        if not texts:
            return np.zeros(0)
        # row by row, so that a score does not depend on the texts beside it
        z = (np.array([self.features(t) for t in texts]) * self.w).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _packer(d: zstandard.ZstdCompressionDict) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)


def _blocks(texts: list[str], block: int) -> list[bytes]:
    data = (t.encode("utf-8", "surrogatepass") for t in texts)
    return [d[i : i + block] for d in data for i in range(0, len(d), block)]


def _dictionaries(good: list[bytes], bad: list[bytes], size: int) -> tuple[bytes, bytes, bool]:
    """Trained dictionaries, or plain content of equal length where there is too little text to train on."""
    try:
        return zstandard.train_dictionary(size, good).as_bytes(), zstandard.train_dictionary(size, bad).as_bytes(), False
    except zstandard.ZstdError:
        a, b = b"".join(good), b"".join(bad)
        n = max(8, min(len(a), len(b), size))
        return a[:n].ljust(8, b"\0"), b[:n].ljust(8, b"\0"), True


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-5) -> np.ndarray:
    mu, sd = x[:, 1:].mean(axis=0), x[:, 1:].std(axis=0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x[:, 1:] - mu) / sd])
    w = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * len(a) * np.eye(len(w))
        w += np.linalg.solve(h, a.T @ (y - p) - ridge * len(a) * w)
    out = w.copy()
    out[1:] /= sd
    out[0] -= (out[1:] * mu).sum()
    return out


def fit_texts(good: list[str], bad: list[str], share: float, block: int = BLOCK, dict_bytes: int = DICT_BYTES, clip: float = CLIP) -> QualityModel:
    """Dictionaries from every second text of each class, calibration on the others, prior `share` of good."""
    good, bad = list(dict.fromkeys(good)), list(dict.fromkeys(bad))
    a, b = _blocks(good[::2], block), _blocks(bad[::2], block)
    if len(good) < 2 or len(bad) < 2 or not a or not b:
        return QualityModel(None, None, False, [share])
    model = QualityModel(*_dictionaries(a, b, dict_bytes), [], block, clip)
    model.weights = [0.0] * 5
    s = model.scorer()
    held = good[1::2] + bad[1::2]
    y = np.array([1.0] * len(good[1::2]) + [0.0] * len(bad[1::2]))
    w = _logistic(np.array([s.features(t) for t in held]), y)
    had, share = y.mean(), min(1 - 1e-6, max(1e-6, share))
    w[0] += math.log(share / (1 - share)) - math.log(had / (1 - had))
    model.weights = w.tolist()
    return model


def cross_validated(good: list[str], bad: list[str], folds: int = 3, **settings: float) -> float:
    """Mean logarithmic loss of texts that each fit of `fit_texts` with these settings has not seen; equal texts share a fold."""
    fold = lambda t: zlib.crc32(t.encode("utf-8", "surrogatepass")) % folds
    loss = []
    for f in range(folds):
        seen = [[t for t in side if fold(t) != f] for side in (good, bad)]
        scorer = fit_texts(*seen, len(seen[0]) / max(1, len(seen[0]) + len(seen[1])), **settings).scorer()
        for side, sign in zip((good, bad), (1, -1), strict=True):
            p = np.clip(scorer.scores([t for t in side if fold(t) == f]), 1e-9, 1 - 1e-9)
            loss.extend(-np.log(p if sign > 0 else 1 - p))
    return float(np.mean(loss))


def quality_fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 4, held: int = 2, sample: int = SAMPLE) -> QualityModel:
    """Fit on labelled rows outside the held-out fold: at most `sample` of each class, those with the smallest hashes of id and text.

    Rows that repeat an id and a text count once.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y in (0, 1)").where(fold_of("id", folds) != held)
    n, ones = known.agg(F.count("*"), F.sum("y")).first()
    share = ones / n if n else 0.5
    some = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t")).where("t <> ''").withColumn("h", F.xxhash64("id", "t"))
    each = checkpoint(some.select("id", "h").distinct().join(known.distinct(), "id"))
    counts = {r["y"]: r["n"] for r in each.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fit_texts([], [], share)
    picked = least_hashes(each, counts, sample)
    place = F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.length("t") - EXCERPT, F.lit(1)).cast("bigint")).cast("int") + 1
    # bounded: 2 * sample rows
    rows = some.join(F.broadcast(picked), ["id", "h"]).select("y", "h", "id", F.substring("t", place, F.lit(EXCERPT)).alias("t")).dropDuplicates(["y", "id", "h"]).collect()
    rows = sorted(rows, key=lambda r: (str(r["id"]), r["t"]))
    return fit_texts([r["t"] for r in rows if r["y"] == 1], [r["t"] for r in rows if r["y"] == 0], share)


def quality_scores(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text."""
    return by_text(docs, F.col(text), [F.col(doc_id)], _scorer_work(model), "score double").withColumnRenamed("_k0", "doc_id")


def accepted_documents(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose text scores the threshold or more, all columns intact and in place (no shuffle)."""
    names = docs.columns
    out = by_text(docs, F.col(text), [F.col(f"`{c}`") for c in names], _scorer_work(model), "__score double")
    kept = out.where(F.col("__score") >= threshold)
    return kept.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(names)])


def _scorer_work(model: QualityModel):
    cache: list[Scorer] = []

    def work(texts: list[str]) -> list[pa.Array]:
        if not cache:
            cache.append(model.scorer())
        return [pa.array(cache[0].scores(texts), pa.float64())]

    return work
