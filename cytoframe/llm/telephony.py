"""Media columns of telephony audio: mu-law, A-law and IMA ADPCM in RIFF files, decoded to resampled PCM.

A text's UTF-8 bytes, padded with blanks to a positive multiple of 192, are the samples of a recording: mu-law or A-law
code words, or the nibbles of ADPCM blocks of 192 data bytes, each behind a header of its own with predictor and step 0.
The payload's CRC picks the codec, so equal texts become equal files. Reading parses the file's chunks again; code words
expand through lookup tables of 256 entries built from their rule, and ADPCM is decoded with numpy across all blocks of a
run of documents, one nibble position at a time. PCM is resampled by linear interpolation in integers.

Defined results: null counts as empty, whose payload is 192 blanks; repeated rows and equal texts give equal results; an
empty table gives an empty result; null ids and extra columns do no harm. A run of documents is bounded by bytes, so
memory depends on the longest text only.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.common import by_text

UNIT = 192
RATE, OUT_RATE = 8000, 16000
CODECS = ("mulaw", "alaw", "adpcm")
#: RIFF format tags.
TAGS = {"mulaw": 7, "alaw": 6, "adpcm": 0x11}
ADPCM_HEADER = struct.pack("<hBB", 0, 0, 0)
BLOCK_ALIGN = len(ADPCM_HEADER) + UNIT

# Fixed values of the IMA ADPCM format: quantiser steps and changes of the step index by code.
STEPS = np.array(
    [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
    np.int32,
)
INDEX_CHANGE = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def _mulaw_table() -> np.ndarray:
    u = ~np.arange(256, dtype=np.int32) & 0xFF
    size = ((((u & 0x0F) << 3) + 0x84) << ((u >> 4) & 7)) - 0x84
    return np.where(u & 0x80, -size, size).astype(np.int16)


def _alaw_table() -> np.ndarray:
    a = np.arange(256, dtype=np.int32) ^ 0x55
    exp, low = (a >> 4) & 7, (a & 0x0F) << 4
    size = np.where(exp == 0, low + 8, (low + 0x108) << np.maximum(exp - 1, 0))
    return np.where(a & 0x80, size, -size).astype(np.int16)


TABLES = {"mulaw": _mulaw_table(), "alaw": _alaw_table()}


def _adpcm_steps() -> tuple[np.ndarray, np.ndarray]:
    """Change of the predictor and next step index for each (step index, code)."""
    code, step = np.arange(16, dtype=np.int32)[None, :], STEPS[:, None]
    diff = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
    nxt = np.clip(np.arange(len(STEPS), dtype=np.int32)[:, None] + INDEX_CHANGE[code & 7], 0, len(STEPS) - 1)
    return np.where(code & 8, -diff, diff).ravel().astype(np.int32), nxt.ravel().astype(np.int32)


_CHANGE, _NEXT = _adpcm_steps()


def payload_of(text: str) -> tuple[bytes, int]:
    data = text.encode("utf-8", "surrogatepass")
    return data + b" " * (max(UNIT, -(-len(data) // UNIT) * UNIT) - len(data)), len(data)


def codec_of(payload: bytes) -> str:
    return CODECS[zlib.crc32(payload) % len(CODECS)]


def store(payload: bytes, codec: str) -> bytes:
    """A RIFF file whose data chunk holds the payload bit by bit."""
    if codec == "adpcm":
        data = b"".join(ADPCM_HEADER + payload[i : i + UNIT] for i in range(0, len(payload), UNIT))
        per_block = 2 * UNIT + 1
        fmt = struct.pack("<HHIIHHHH", TAGS[codec], 1, RATE, RATE * BLOCK_ALIGN // per_block, BLOCK_ALIGN, 4, 2, per_block)
        samples = len(payload) // UNIT * per_block
    else:
        data, samples = payload, len(payload)
        fmt = struct.pack("<HHIIHHH", TAGS[codec], 1, RATE, RATE, 1, 8, 0)
    chunks = b"".join(k + struct.pack("<I", len(v)) + v for k, v in ((b"fmt ", fmt), (b"fact", struct.pack("<I", samples)), (b"data", data)))
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def load(media: bytes) -> tuple[str, bytes]:
    """(codec, payload) of a file that store() wrote."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF wave file")
    at, parts = 12, {}
    while at + 8 <= len(media):
        n = struct.unpack_from("<I", media, at + 4)[0]
        parts[media[at : at + 4]] = media[at + 8 : at + 8 + n]
        at += 8 + n + (n & 1)
    tag = struct.unpack_from("<H", parts[b"fmt "])[0]
    codec = next(k for k, v in TAGS.items() if v == tag)
    data = parts[b"data"]
    if codec == "adpcm":
        data = np.frombuffer(data, np.uint8).reshape(-1, BLOCK_ALIGN)[:, len(ADPCM_HEADER) :].tobytes()
    return codec, data


def decode_adpcm(payload: np.ndarray) -> np.ndarray:
    """PCM of consecutive blocks of 192 data bytes: (blocks, 384) samples, low nibble first."""
    blocks = payload.reshape(-1, UNIT)
    out = np.empty((2 * UNIT, len(blocks)), np.int16)
    codes = np.ascontiguousarray(blocks.T).astype(np.int32)
    pred, index = np.zeros(len(blocks), np.int32), np.zeros(len(blocks), np.int32)
    for i in range(2 * UNIT):
        at = (index << 4) + (codes[i >> 1] >> 4 if i & 1 else codes[i >> 1] & 15)
        pred = np.clip(pred + _CHANGE[at], -32768, 32767)
        index = _NEXT[at]
        out[i] = pred
    return np.ascontiguousarray(out.T)


def decode_run(codec: str, payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(PCM of all payloads one after another, starts of each and the end)."""
    data = np.frombuffer(b"".join(payloads), np.uint8)
    lengths = np.array([len(p) for p in payloads], np.int64)
    if codec == "adpcm":
        return decode_adpcm(data).ravel(), np.concatenate(([0], np.cumsum(lengths * 2)))
    return TABLES[codec][data], np.concatenate(([0], np.cumsum(lengths)))


def resample(pcm: np.ndarray, starts: np.ndarray, rate: int) -> tuple[np.ndarray, np.ndarray]:
    """Linear interpolation from RATE to `rate` for each recording of the run."""
    counts = np.diff(starts)
    new = counts * rate // RATE
    ends = np.concatenate(([0], np.cumsum(new)))
    which = np.repeat(np.arange(len(counts)), new)
    pos = (np.arange(ends[-1]) - ends[which]) * RATE
    left = starts[which] + pos // rate
    right = np.minimum(left + 1, starts[which + 1] - 1)
    a = pcm[left].astype(np.int64)
    return (a + (pcm[right] - a) * (pos % rate) // rate).astype(np.int16), ends


def features(pcm: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(samples, peak, mean square, zero crossings) of each recording."""
    at = starts[:-1]
    wide = pcm.astype(np.int64)
    peak, energy = np.maximum.reduceat(np.abs(wide), at), np.add.reduceat(wide * wide, at)
    neg = pcm < 0
    cross = np.concatenate(([False], neg[1:] != neg[:-1]))
    cross[at] = False
    return list(zip(np.diff(starts).tolist(), peak.tolist(), (energy // np.diff(starts)).tolist(), np.add.reduceat(cross.astype(np.int64), at).tolist()))


def _decoded(texts: list[str], rate: int):
    """For each text: (n_bytes, payload read back, media, codec, features, resampled PCM bytes)."""
    out: list = [None] * len(texts)
    by: dict[str, list[int]] = {}
    stored = []
    for i, t in enumerate(texts):
        payload, n = payload_of(t)
        media = store(payload, codec_of(payload))
        codec, back = load(media)
        stored.append((n, media, codec, back))
        by.setdefault(codec, []).append(i)
    for codec, rows in by.items():
        pcm, starts = decode_run(codec, [stored[i][3] for i in rows])
        feats = features(pcm, starts)
        new, ends = resample(pcm, starts, rate)
        for k, i in enumerate(rows):
            n, media, _, back = stored[i]
            out[i] = (n, back, media, codec, feats[k], new[ends[k] : ends[k + 1]].tobytes())
    return out


def telephony_media(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: int = OUT_RATE) -> DataFrame:
    """(doc_id, codec, media, rate, pcm): the stored file and its decoded 16-bit PCM at `rate`."""

    def work(texts: list[str]) -> list[pa.Array]:
        rows = _decoded(texts, rate)
        return [pa.array([r[3] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.binary()), pa.array([rate] * len(rows), pa.int32()), pa.array([r[5] for r in rows], pa.binary())]

    return by_text(docs, F.col(text), [F.col(doc_id)], work, "codec string; media binary; rate int; pcm binary").withColumnRenamed("_k0", "doc_id")


def telephony_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: int = OUT_RATE) -> DataFrame:
    """Digests of the stored files and of what is read back from them, made where the files are."""

    def work(texts: list[str]) -> list[pa.Array]:
        rows = _decoded(texts, rate)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        cols = [
            ([r[0] for r in rows], pa.int64()),
            ([len(r[1]) for r in rows], pa.int64()),
            ([sha(r[1]) for r in rows], pa.string()),
            ([zlib.crc32(r[1][-16:]) for r in rows], pa.int64()),
            ([len(r[2]) for r in rows], pa.int64()),
            ([sha(r[2]) for r in rows], pa.string()),
            ([f"{r[3]}:{':'.join(map(str, r[4]))}:{rate}:{len(r[5]) // 2}:{zlib.crc32(r[5]):08x}" for r in rows], pa.string()),
        ]
        return [pa.array(v, t) for v, t in cols]

    kinds = "n_bytes bigint; payload_bytes bigint; payload_sha256 string; tail_crc32 bigint; media_bytes bigint; media_sha256 string; feature string"
    return by_text(docs, F.col(text), [F.col(doc_id)], work, kinds).withColumnRenamed("_k0", "doc_id")
