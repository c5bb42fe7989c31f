"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into segments of 128; in each, one minimal gated unit (a recurrent unit whose single gate
both forgets and updates) runs forward and another backward, and a softmax over both states labels every byte. Byte
probabilities are averaged over the whole text. Segments start from a zero state, so texts of any length run side by side
in one batch; padding bytes close the gate and leave the state untouched.

Training is numpy back-propagation through time with Adam on a bounded sample of labelled rows, on the driver; prediction
runs on the executors, bounded by bytes.

Defined results: `und` with score 0 for null texts and texts without a letter; with no labelled row to learn from, every
text is `und`; repeated rows and equal texts give equal results; languages are learned values in code-point order; an
empty table gives an empty result; null ids, null labels and extra columns do no harm.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.common import by_text, fold_of, least_hashes

SEGMENT, PAD = 128, 256
HIDDEN = 8
#: Labelled rows of each language in the sample (in expectation), and characters of each from a place its hash picks.
SAMPLE, EXCERPT = 1200, 640
STEPS, BATCH, RATE = 320, 256, 0.02
#: Segments that one numpy batch holds.
WIDE = 2048
UNKNOWN = "und"
_ASCII_LETTER = re.compile("[A-Za-z]")


@dataclass
class LanguageModel:
    """For each direction: inputs (257, 2H), recurrent (H, 2H), output (H, K); then the output's bias."""

    languages: list[str]
    parts: list[np.ndarray]


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text))


def segments_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(segments, 128) byte values, PAD behind the end, and the index of each text's first segment."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    count = np.array([max(1, -(-len(d) // SEGMENT)) for d in data], np.int64)
    first = np.concatenate(([0], np.cumsum(count)))
    flat = np.full(first[-1] * SEGMENT, PAD, np.uint16)
    for d, at in zip(data, first[:-1] * SEGMENT):
        flat[at : at + len(d)] = np.frombuffer(d, np.uint8)
    return flat.reshape(-1, SEGMENT), first[:-1]


def _scan(x: np.ndarray, inputs: np.ndarray, rec: np.ndarray, out: np.ndarray, logits: np.ndarray, order) -> None:
    """Run one direction over x (time, batch) and add its part of the logits (time, batch, K).

    The gate's weights come halved, so that one tanh serves it: sigmoid(a) = (1 + tanh(a / 2)) / 2.
    """
    n, hidden = x.shape[1], rec.shape[0]
    h = np.zeros((n, hidden), np.float32)
    a, u = np.empty((n, 2 * hidden), np.float32), np.empty((n, 2 * hidden), np.float32)
    c = np.empty((n, hidden), np.float32)
    for t in order:
        np.take(inputs, x[t], axis=0, out=a)
        np.matmul(h, rec, out=u)
        gate = a[:, :hidden]
        gate += u[:, :hidden]
        np.tanh(gate, out=gate)
        gate *= 0.5
        gate += 0.5
        np.multiply(gate, u[:, hidden:], out=c)
        c += a[:, hidden:]
        np.tanh(c, out=c)
        c -= h
        c *= gate
        h += c
        logits[t] += h @ out


def _halved(m: np.ndarray, hidden: int) -> np.ndarray:
    m = m.copy()
    m[:, :hidden] *= 0.5
    return m


def segment_probabilities(model: LanguageModel, x: np.ndarray) -> np.ndarray:
    """(segments, K): sums of byte probabilities over each segment's bytes."""
    wf, uf, vf, wb, ub, vb, bias = model.parts
    hidden, k = uf.shape[0], len(bias)
    wf, uf, wb, ub = (_halved(m, hidden) for m in (wf, uf, wb, ub))
    out = np.empty((len(x), k), np.float32)
    for at in range(0, len(x), WIDE):
        cols = np.ascontiguousarray(x[at : at + WIDE].T)
        logits = np.empty((SEGMENT, cols.shape[1], k), np.float32)
        logits[:] = bias
        _scan(cols, wf, uf, vf, logits, range(SEGMENT))
        _scan(cols, wb, ub, vb, logits, range(SEGMENT - 1, -1, -1))
        np.clip(logits, -60, 60, out=logits)
        np.exp(logits, out=logits)
        weight = (cols != PAD) / logits.sum(axis=2)
        out[at : at + WIDE] = np.einsum("tnk,tn->nk", logits, weight.astype(np.float32))
    return out


def predict(model: LanguageModel, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """(language, score) of every whole text."""
    known = [i for i, t in enumerate(texts) if has_letter(t)] if model.languages else []
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if known:
        x, first = segments_of([texts[i] for i in known])
        total = np.add.reduceat(segment_probabilities(model, x).astype(np.float64), first, axis=0)
        share = total / total.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        scores[known] = share[np.arange(len(known)), best]
        for i, b in zip(known, best):
            names[i] = model.languages[b]
    # the last digits of a matrix product depend on the batch
    return names, np.round(np.clip(scores, 0.0, 1.0), 5)


def _forward(x, w, u, order):
    n, hidden = x.shape[1], u.shape[0]
    h = np.zeros((n, hidden), np.float32)
    kept = [None] * len(x)
    for t in order:
        a, r = w[x[t]], h @ u
        f = 1 / (1 + np.exp(-(a[:, :hidden] + r[:, :hidden])))
        c = np.tanh(a[:, hidden:] + f * r[:, hidden:])
        new = h + f * (c - h)
        kept[t] = (h, f, c, r[:, hidden:], new)
        h = new
    return kept


def _backward(x, kept, dh_out, w, u, order):
    """Gradients of inputs and recurrent weights, given those of the states at each time."""
    hidden = u.shape[0]
    du, dpre = np.zeros_like(u), np.empty((len(x), x.shape[1], 2 * hidden), np.float32)
    dh = np.zeros((x.shape[1], hidden), np.float32)
    for t in reversed(order):
        h, f, c, r, _ = kept[t]
        d = dh + dh_out[t]
        dc = d * f * (1 - c * c)
        df = (d * (c - h) + dc * r) * f * (1 - f)
        dpre[t, :, :hidden], dpre[t, :, hidden:] = df, dc
        dr = np.concatenate((df, dc * f), axis=1)
        du += h.T @ dr
        dh = d * (1 - f) + dr @ u.T
    flat, g = x.ravel(), dpre.reshape(-1, 2 * hidden)
    return np.stack([np.bincount(flat, g[:, j], PAD + 1) for j in range(2 * hidden)], axis=1).astype(np.float32), du


def train(texts: list[str], labels: list[str], steps: int = STEPS, hidden: int = HIDDEN, seed: int = 7) -> LanguageModel:
    """Back-propagation through time over random batches of segments, the languages in equal parts."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], [])
    rng, k = np.random.default_rng(seed), len(languages)
    x, first = segments_of(texts)
    y = np.repeat([languages.index(v) for v in labels], np.diff(np.append(first, len(x))))
    by = [np.flatnonzero(y == i) for i in range(k)]
    shape = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
    parts = [p for _ in range(2) for p in (shape(PAD + 1, 2 * hidden), shape(hidden, 2 * hidden), shape(hidden, k))] + [np.zeros(k, np.float32)]
    closed = np.array([-30.0] * hidden + [0.0] * hidden, np.float32)
    parts[0][PAD], parts[3][PAD] = closed, closed
    m, v = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    there, back = range(SEGMENT), range(SEGMENT - 1, -1, -1)
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(b, BATCH // k + 1) for b in by])
        cols, want = np.ascontiguousarray(x[pick].T), y[pick]
        wf, uf, vf, wb, ub, vb, bias = parts
        kf, kb = _forward(cols, wf, uf, there), _forward(cols, wb, ub, back)
        hf, hb = np.stack([q[4] for q in kf]), np.stack([q[4] for q in kb])
        z = hf @ vf + hb @ vb + bias
        p = np.exp(z - z.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(len(want)), want] -= 1
        real = cols != PAD
        dz = p * (real / max(1, real.sum()))[:, :, None].astype(np.float32)
        flat = dz.reshape(-1, k)
        gwf, guf = _backward(cols, kf, dz @ vf.T, wf, uf, there)
        gwb, gub = _backward(cols, kb, dz @ vb.T, wb, ub, back)
        grads = [gwf, guf, hf.reshape(-1, hidden).T @ flat, gwb, gub, hb.reshape(-1, hidden).T @ flat, flat.sum(axis=0)]
        grads[0][PAD] = grads[3][PAD] = 0
        norm = max(1.0, float(np.sqrt(sum((g * g).sum() for g in grads))))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for q, g, a, b in zip(parts, grads, m, v):
            g = g / norm
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            q -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-7)
    return LanguageModel(languages, [p.astype(np.float32) for p in parts])


def language_fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, held: int = 1, sample: int = SAMPLE) -> LanguageModel:
    """Train on rows outside the held-out fold: `sample` of each language at most, those with the smallest hashes of id and text.

    Rows that repeat an id and a text count once.
    """
    known = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("y")).where("y is not null and t is not null").where(F.coalesce(fold_of("id", folds), F.lit(0)) != held)
    known = known.withColumn("h", F.xxhash64("id", "t"))
    counts = {r["y"]: r["n"] for r in known.select("y", "h").distinct().groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return LanguageModel([], [])
    picked = least_hashes(known.select("y", "h").distinct(), counts, sample)
    place = F.pmod(F.xxhash64("id", F.lit(2)), F.greatest(F.length("t") - EXCERPT, F.lit(1)).cast("bigint")).cast("int") + 1
    some = known.join(F.broadcast(picked), ["y", "h"]).select("y", "h", F.col("id").cast("string").alias("id"), F.substring("t", place, F.lit(EXCERPT)).alias("t")).dropDuplicates(["y", "h"])
    rows = sorted((str(r["id"]), r["y"], r["t"]) for r in some.collect() if has_letter(r["t"]))
    return train([t for _, _, t in rows], [y for _, y, _ in rows])


def languages(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""

    def work(texts: list[str]) -> list[pa.Array]:
        names, scores = predict(model, texts)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return by_text(docs, F.col(text), [F.col(doc_id)], work, "lang_pred string; score double").withColumnRenamed("_k0", "doc_id")
