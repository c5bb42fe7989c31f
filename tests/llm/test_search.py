"""Ranked search against scoring every document."""

import math
import random
import re

import numpy as np

from cytoframe.llm import search
from cytoframe.llm.tokens import table_of, words_of

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, (text or "").translate(FOLD))


def by_hand(docs, items, best):
    words = [(i, terms(t)) for i, t in docs]
    n, total = sum(1 for _, w in words if w), sum(len(w) for _, w in words)
    df = {}
    for _, w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in sorted(set(items), key=repr):
        hits = []
        for i, w in words:
            if w:
                m = 100 - 50 + (50 * len(w) * n) // total
                score = sum(weight[t] * ((1_000_000_000 * w.count(t)) // (1000 * w.count(t) + 20 * m)) for t in set(terms(text)) & set(w))
                if score > 0:
                    hits.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(hits, key=lambda h: h[:3])[:best], 1)]
    return sorted(out, key=repr)


def found(docs, items, best, index=None):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in search.ranked_search(docs, items, best=best, index=index).collect()), key=repr)


def corpus(seed=1, n=140, words=90):
    r = random.Random(seed)
    pick = lambda: f"{r.choice('AbÉ9')}{min(r.randrange(words), r.randrange(words))}"
    docs = [(i, r.choice([" ", ", ", "\n", "'"]).join(pick() for _ in range(r.choice([1, 5, 40, 300])))) for i in range(n)]
    docs += [(7, docs[3][1]), (7, docs[3][1]), (None, docs[3][1]), (None, "A1 A1 É2"), (-4, "É2 a1 A1"), (1 << 60, "a1 a1 é2"), (900, None), (901, " .,- "), (902, "x" * 3000)]
    items = [(k, " ".join(pick() for _ in range(r.choice([1, 3, 12])))) for k in range(12)]
    return docs, items + [(3, items[3][1]), (3, "A1"), (50, None), (51, ""), (None, "É2 a1"), (52, "unknownterm"), (53, "x" * 3000)]


def test_by_hand(spark, monkeypatch):
    docs, items = corpus()
    want = by_hand(docs, items, 5)
    table, asked = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    for parts, block in ((1, 3), (6, 1), (3, 128)):
        assert found(table, asked, 5, search.build_index(table.repartition(parts), block_docs=block)) == want
    assert found(table, asked, 50) == by_hand(docs, items, 50)
    monkeypatch.setattr(search, "ITEMS", 2)
    assert found(table, asked, 5, search.build_index(table, block_bytes=400)) == want


def test_blocks_are_skipped(monkeypatch):
    docs = [(i, f"common {'rare ' * (i % 9 == 0)}w{i}") for i in range(400)]
    ids, n = np.arange(400), 4
    known = search.Queries.of(["rare"])
    rows = []
    for at in range(0, 400, n):
        w = words_of([t for _, t in docs[at : at + n]], search._SEPARATE)
        key, times = np.unique(np.stack((w.text.astype(np.uint64), w.hash)), axis=1, return_counts=True)
        rows.append(search._block(ids[at : at + n], np.bincount(w.text, minlength=n), key[0].astype(np.int64), key[1], times))
    known = known.weigh(np.array([45]), 400, sum(r[1] for r in rows))
    bounds = [int(known.bounds(r[2], r[4], r[5])[0]) for r in rows]
    tops = [int(search.Block(known, r[2], r[6], r[7], r[8], r[9], r[10]).scores(known.flat).max()) for r in rows]
    assert all(b >= t for b, t in zip(bounds, tops)) and bounds.count(0) > 50


def test_edges(edges, nothing, spark):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    items = [(1, "negative ID"), (2, "w7 w8 w9"), (3, "more large 1"), (None, None)]
    asked = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'clash' as doc_id", "'clash' as k", "1 as score")
    assert found(edges, asked, 50) == by_hand(rows, items, 50)
    assert found(nothing, asked, 50) == []
    assert found(edges, asked.limit(0), 50) == []


def test_numbers_are_packed():
    for top in (0, 1, 255, 256, 65535, 65536, 1 << 32, 1 << 40):
        values = np.array([0, top, top // 2])
        assert search.unpack(search.pack(values)).tolist() == values.tolist()
    assert search.unpack(search.pack(np.zeros(0, np.int64))).tolist() == []


def test_words_at_once():
    r = random.Random(2)
    texts = ["", " ", "a", "A b", "x" * 700, "y" * 256 + "z" * 256, "z" * 256 + "y" * 256] + ["".join(r.choice("aB é\n-.9") for _ in range(r.randrange(30))) for _ in range(200)]
    got = words_of(texts, search._SEPARATE)
    want = [(i, w) for i, t in enumerate(texts) for w in terms(t)]
    assert got.text.tolist() == [i for i, _ in want]
    assert [got.raw[b : b + n].tobytes().decode() for b, n in zip(got.begin.tolist(), got.size.tolist())] == [w for _, w in want]
    assert len({(h, w) for h, (_, w) in zip(got.hash.tolist(), want)}) == len(set(got.hash.tolist())) == len({w for _, w in want})
    assert table_of((1, 2)).sum() == 2 and len(words_of([], search._SEPARATE).begin) == 0
