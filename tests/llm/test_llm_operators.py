"""Operators against brute-force versions, exact round trips and held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken  # noqa: F401
import xxhash
from llm_cases import prose
from hypothesis import given, settings
from hypothesis import strategies as st

from cytoframe.llm import bpe, fingerprints, langid, mixing, passages, pii, quality, queries, sharding, simhash, telephony
from cytoframe.llm.components import connected_components

CHARS = st.text(alphabet=st.sampled_from(list("ab's \n\t12é日!.?ZQ\x1c😀 ")), max_size=120)


# BPE


@settings(max_examples=300, deadline=None)
@given(CHARS, st.integers(1, 20))
def test_tree_encoding_equals_direct(text, leaf):
    codec = bpe.TreeCodec(queries.ranks_path(), queries.split_pattern(), leaf)
    assert codec.encode(text) == codec.base.encode_ordinary(text)
    assert codec.decode(codec.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 30000, " " * 9000 + "x", "word " * 9000, "'s" * 5000, "\n" * 5000 + "1" * 7000, "日本" * 6000, "x y" * 1000 + "   "])
def test_tree_encoding_of_long_runs(text):
    codec = bpe.TreeCodec(queries.ranks_path(), queries.split_pattern())
    assert codec.encode(text) == codec.base.encode_ordinary(text)


def test_bpe_on_data(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").toPandas()
    enc = bpe.encoding(queries.ranks_path(), queries.split_pattern())
    got = {r["doc_id"]: r for r in queries.op3_bpe_round_trip(spark, small).collect()}
    for i, t in zip(docs.doc_id, docs.text):
        ids = enc.encode_ordinary(t)
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


# SimHash


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@settings(max_examples=200, deadline=None)
@given(CHARS)
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) == brute_fingerprint(text)


def components_of(fps):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if b < a and (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_on_data(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").toPandas()
    fps = {i: brute_fingerprint(t) for i, t in zip(docs.doc_id, docs.text)}
    want = components_of(fps)
    for r in queries.op10_simhash(spark, small).collect():
        assert int(r["fingerprint"], 16) == fps[r["doc_id"]] and r["component_id"] == want[r["doc_id"]]


def test_ball_links_keep_components(spark):
    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(12)]
    fps = {}
    for b in base:
        v = b
        for _ in range(12):
            for _ in range(r.choice((0, 1, 1, 2, 2, 3))):
                v ^= 1 << r.randrange(64)
            fps[len(fps)] = v
    want = components_of(fps)
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in fps.items()]
    df = spark.createDataFrame(signed, "doc_id bigint, fp bigint")
    links = simhash.ball_links(df)
    comp = {row["node"]: row["root"] for row in connected_components(links).collect()}
    groups = {}
    for i, v in signed:
        groups.setdefault(comp.get(v, v), []).append(i)
    assert sorted(map(min, groups.values())) == sorted(set(want.values()))
    assert all(len({want[i] for i in g}) == 1 for g in groups.values())


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(60)}


# Personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_match_the_patterns(spark):
    from pyspark.sql import functions as F

    r = random.Random(11)
    pieces = ["a@b.c", "_x@y-z.co.uk", "@", ".", "-", " ", "+", "1.2.3.4", "256.1.1.1", "0001.2.3.04", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (202) 555-0143", "+49", "12345678", "é", "😀", "(", ")", "\n", "7", "x", "%", "4111111111111111+1"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(1, 14))) for _ in range(600)]
    texts += ["a.b@c.d " * 700, "1" * 3000, "1.2.3.4," * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = df.select("doc_id", pii.base_spans(F.col("text")).alias("s")).collect()
    for row in got:
        assert [(s["kind"], s["start"], s["stop"]) for s in row["s"]] == brute_spans(texts[row["doc_id"]]), texts[row["doc_id"]]


def test_redaction_merges_overlaps(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("0123456789", [("b", 2, 5), ("a", 4, 7), ("c", 8, 9)]), ("none", [])], "text string, s array<struct<kind:string,start:int,stop:int>>")
    assert [r[0] for r in df.select(pii.redact(F.col("text"), F.col("s"))).collect()] == ["01<b>7<c>9", "none"]


def test_labelers_agree_on_secrets_only(spark, small):
    rows = queries.op5_pii(spark, small).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in rows:
        spans = brute_spans(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        for s in r["spans"].split(","):
            if s.startswith("secret"):
                _, a, b = s.split(":")
                assert re.fullmatch("[0-9a-f]{32,}", docs[r["doc_id"]][int(a) : int(b)])


def test_em_finds_the_reliable_labeler():
    r = random.Random(3)
    cells = Counter()
    for _ in range(4000):
        y = r.random() < 0.4
        vote = lambda right: (1 if y else -1) * (1 if r.random() < right else -1)  # noqa: E731, B023
        cells[("secret", vote(0.97), vote(0.6), vote(0.9), vote(0.9), 1, 0 if y else 2)] += 1
    rows = [dict(zip(("kind", "v0", "v1", "v2", "v3", "len", "next"), k)) | {"n": n} for k, n in cells.items()]
    model = pii.fit_cells(rows)
    got = model.reliability["secret"]
    assert got["shape"] > got["left"] > got["gazetteer"] and abs(got["shape"] - 0.97) < 0.03


# Mixing


def brute_targets(sizes, weights=(1, 2, 3), cap=3.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[f] for f in free) for s in free}
        above = [s for s in free if share[s] > cap * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in above}


def test_targets_and_rounding(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").toPandas()
    rows = queries.op9_pivotal_mix(spark, small).toPandas()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in zip(docs.doc_id, docs.text)}
    assert dict(zip(rows.doc_id, rows["size"])) == size
    per = rows.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    want = brute_targets(per["size"].to_dict())
    for s, r in per.iterrows():
        assert abs(r.target - want[s]) < 1e-6 * max(1, r.target)
        assert abs(r.taken - r.target) <= r.most
    assert (rows.taken <= 3 * rows["size"]).all()
    again = queries.op9_pivotal_mix(spark, small).toPandas()
    assert sorted(zip(rows.doc_id, rows.taken)) == sorted(zip(again.doc_id, again.taken))


def test_caps_and_expectation(spark):
    rows = [(i, "w " * (1 + i % 5), "big" if i % 10 else "small") for i in range(400)] + [(1000, "w", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken = Counter()
    for seed in range(6):
        for r in mixing.mix_copies(df, seed=seed, fan=8).collect():
            taken[r["doc_id"]] += r["copies"]
            assert r["target"] <= 3 * r["source_size"] + 1e-9
    assert len({taken[i] for i in range(0, 400, 1)}) > 1


# Sharding


def test_shards_follow_the_directory(spark, small):
    rows = queries.op8_extendible_shards(spark, small).collect()
    names = {r["shard"] for r in rows}
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    assert all(r["shard_bytes"] <= queries.SHARD_BYTES for r in rows)


def test_uneven_hashes_split_deeper():
    sums = np.zeros(16, np.int64)
    sums[3], sums[8], sums[9] = 90, 50, 60
    depth, held = sharding.depths(sums, 4, 100)
    assert depth[3] == 1 and depth[8] == 4 and depth[9] == 4 and held[8] == 50 and held[0] == 90
    assert sharding.depths(np.array([500, 1]), 1, 100)[0].tolist() == [-1, 1]


# Fingerprints


def test_equal_substrings_share_signatures():
    a, b = prose(1, 600), prose(2, 600)
    names = lambda t: {int(v) for _, n in fingerprints.signatures([t]) for v in n}
    inside, moved = names(a), names(b + "xyz" + a)
    assert len(inside & moved) > 0.9 * len(inside)
    assert len(names(a) & names(b)) < 0.05 * len(inside)


def test_runs_equal_batches():
    texts = ["", "a", "aa" * 400, prose(3, 50), "ab" * 300, prose(3, 50), "x" * 17 + "y"]
    alone = np.concatenate([fingerprints.fingerprint_bins([t]) for t in texts])
    assert (fingerprints.fingerprint_bins(texts) == alone).all()


def test_fingerprints_on_data(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").toPandas().sort_values("doc_id").reset_index(drop=True)
    got = queries.op6_fingerprints(spark, small).toPandas().set_index("doc_id")
    for k, (i, t) in enumerate(zip(docs.doc_id, docs.text)):
        n, half = docs.text[(k + 1) % len(docs)], len(t) // 2
        assert got.edited_sha256[i] == hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest()
    long = got[got.n_chars > 300]
    assert long.near_edited.mean() > 0.25 and long.near_next.mean() < 0.1 and (long.near_edited > long.near_next).mean() > 0.97


# Passages


def brute_chain_score(x, y):
    best = [0.0] * len(x)
    for j in range(len(x)):
        gain = max([best[i] - passages.GAP_COST * (x[j] - x[i] + y[j] - y[i]) for i in range(j) if x[i] < x[j] and y[i] < y[j]] + [0.0])
        best[j] = passages.SEED_SCORE + max(gain, 0.0)
    return max(best)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=25, unique=True))
def test_chains_find_the_best_score(points):
    points.sort()
    x, y = [p[0] for p in points], [p[1] for p in points]
    found = passages.chains(x, y)
    assert sorted(i for c in found for i in c) == list(range(len(x)))
    best = max(passages.SEED_SCORE * len(c) - passages.GAP_COST * ((x[c[-1]] - x[c[0]]) + (y[c[-1]] - y[c[0]])) for c in found)
    assert abs(best - brute_chain_score(x, y)) < 1e-6
    for c in found:
        assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c, c[1:]))


def test_word_hashes_follow_words():
    texts = ["", " a  B c\n", "b", "\t", "A b"]
    h, counts = passages.word_hashes(texts)
    assert counts.tolist() == [0, 3, 1, 0, 2] and h[1] == h[3] == h[5] and h[0] == h[4] != h[1]


def test_planted_passages(spark):
    from difflib import SequenceMatcher  # noqa: F401

    r = random.Random(5)
    passage = [f"p{i}" for i in range(70)]
    fuzzy = [w if r.random() > 0.06 else w + "x" for w in passage]
    rows, hit = [], set()
    for i in range(60):
        words = prose(100 + i, 150).split()
        if i % 7 == 0:
            at = r.randrange(0, 150)
            words = words[:at] + (passage if i % 2 else fuzzy) + words[at:]
            hit.add(i)
        rows.append((i, " ".join(words)))
    rows.append((100, rows[3][1]))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {x["doc_id"] for x in got} == hit | {3, 100}
    assert all(x["n_words"] >= 60 for x in got) and len({x["class_id"] for x in got if x["doc_id"] in hit}) == 1


def test_exact_runs_of_fifty_words_are_covered(spark, small):
    docs = {r["doc_id"]: r["text"].encode().lower().split() for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    where: dict = {}
    for i, w in docs.items():
        for p in range(len(w) - 49):
            where.setdefault(tuple(w[p : p + 50]), set()).add(i)
    spans: dict = {}
    for r in queries.op7_passages(spark, small).collect():
        spans.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"]))
    for i, w in docs.items():
        for p in range(len(w) - 49):
            if len(where[tuple(w[p : p + 50])]) > 1:
                assert any(a <= p and p + 50 <= b for a, b in spans.get(i, [])), (i, p)


# Telephony


def test_code_tables():
    mu, a = telephony.TABLES["mulaw"], telephony.TABLES["alaw"]
    assert mu[0xFF] == mu[0x7F] == 0 and mu[0x80] == 32124 and mu[0x00] == -32124 and len(set(mu.tolist())) == 255
    assert a[0xD5] == 8 and a[0x55] == -8 and a.max() == 32256 and a.min() == -32256


@settings(max_examples=30, deadline=None)
@given(st.binary(min_size=192, max_size=192))
def test_adpcm_blocks(payload):
    pred = index = 0
    want = []
    for byte in payload:
        for code in (byte & 15, byte >> 4):
            step = int(telephony.STEPS[index])
            diff = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
            pred = max(-32768, min(32767, pred + (-diff if code & 8 else diff)))
            index = max(0, min(88, index + int(telephony.INDEX_CHANGE[code & 7])))
            want.append(pred)
    twice = telephony.decode_adpcm(np.frombuffer(payload * 2, np.uint8))
    assert twice[0].tolist() == want and twice[1].tolist() == want


def test_storage_is_lossless(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in queries.op4_telephony(spark, small).collect():
        payload, n = telephony.payload_of(docs[r["doc_id"]])
        assert (r["n_bytes"], r["payload_bytes"], r["tail_crc32"]) == (n, len(payload), zlib.crc32(payload[-16:]))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest()
        media = telephony.store(payload, telephony.codec_of(payload))
        assert r["media_sha256"] == hashlib.sha256(media).hexdigest() and r["media_bytes"] == len(media) and telephony.load(media)[1] == payload


# Models on held-out rows


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op1_language(spark, sf).toPandas()
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas()
    both = rows.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert set(held.doc_id) == {i for i in truth.doc_id if zlib.crc32(str(i).encode()) % 3 == 1}
    assert (held.lang_pred == held.lang).mean() > 0.97


def test_gradients():
    model = langid.train(["abcab cab", "xyzzy zyx"], ["p", "q"], steps=60)
    names, scores = langid.predict(model, ["abc abc cab", "zyx xyz", "", None, "123"])
    assert names == ["p", "q", "und", "und", "und"] and scores[0] > 0.6 and scores[2] == 0


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op2_quality(spark, sf).toPandas()
    both = rows.merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.93
    assert ((rows.score >= 0.7).astype(int) == rows.predicted).all()


def test_equal_texts_equal_scores():
    model = quality.fit_texts([prose(i, 60) for i in range(30)], ["#" * i + " $$ " * 20 for i in range(1, 31)], 0.8)
    s = model.scorer()
    assert s.scores(["abc def"])[0] == s.scores(["x", "abc def"])[1]


@pytest.mark.parametrize("gap", (31, 60, 100, 200, 300))
def test_passages_of_one_pair_stand_apart(spark, gap):
    rng = np.random.default_rng(gap)
    words = lambda n, tag: [f"{tag}{v}" for v in rng.integers(0, 10**9, n)]
    head, foot = words(60, "h"), words(60, "f")
    rows = [(d, " ".join([*words(20, f"s{d}"), *head, *words(gap, f"m{d}"), *foot, *words(20, f"e{d}")])) for d in (1, 2, 3)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = {(d, s, s + 60) for d in (1, 2, 3) for s in (20, 80 + gap)}
    assert {(r["doc_id"], r["start_word"], r["end_word"]) for r in got} == want


@given(st.lists(st.tuples(st.integers(6, 80), st.integers(0, 40)), min_size=1, max_size=6))
def test_pieces_equal_brute_force(parts):
    """Blocks of equal words with gaps of unequal ones: every piece from block to block is judged."""
    a, b, xs, spans = [], [], [], []
    for n, gap in parts:
        xs += range(len(a), len(a) + n - passages.K + 1)
        spans.append((len(a), len(a) + n))
        a += [f"w{len(a) + i}" for i in range(n)] + ["a"] * gap
        b += a[len(b) : len(b) + n] + ["b"] * gap
    good = [(s, e) for s, _ in spans for _, e in spans if e - s >= 50 and sum(w == v for w, v in zip(a[s:e], b[s:e])) >= 0.8 * (e - s)]
    got = passages.pieces(a, b, xs, xs)
    # _extend goes on over a short gap, so a piece may hold more than its blocks
    assert all(any(p[0] <= s and e <= p[1] for p in got) for s, e in good)
    assert all(p[1] - p[0] >= 50 and p[4] >= 0.8 for p in got)
    assert all(abs(sum(w == v for w, v in zip(a[p[0] : p[1]], b[p[2] : p[3]])) / (p[1] - p[0]) - p[4]) < 1e-9 for p in got)


def test_samples_are_bounded_by_rows(spark, monkeypatch):
    """Null and repeated ids with many texts, and one row many times."""
    docs = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, prose(i, 30), "en") for i in range(900)] + [(1, prose(1, 30), "en")] * 300
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    seen = []
    monkeypatch.setattr(langid, "train", lambda texts, labels: seen.append(list(texts)))
    langid.language_fit(df, sample=50, folds=10**6, held=-1)
    assert len(seen[0]) == 50 == len(set(seen[0]))
    labels = spark.createDataFrame([(7, 1), *((i, i % 2) for i in range(8, 900))], "doc_id bigint, quality int")
    monkeypatch.setattr(quality, "fit_texts", lambda good, bad, share: seen.append((list(good), list(bad))))
    quality.quality_fit(df, labels, sample=50, folds=10**6, held=-1)
    assert [len(x) for x in seen[1]] == [50, 50]
    assert sum(prose(i, 30) in seen[1][0] for i in range(1, 900, 3)) < 50
