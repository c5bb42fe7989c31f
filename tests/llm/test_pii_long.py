"""Folds over many spans of one text against plain Python, on a text that quadratic work would not finish."""

import random

from pyspark.sql import functions as F

from cytoframe.llm import pii

SPANS = "id int, s array<struct<kind:string,start:int,stop:int>>, o array<struct<kind:string,start:int,stop:int>>"


def test_clear_spans(spark):
    rng = random.Random(3)
    rows = []
    for i in range(40):
        draw = lambda kind, n: [(kind, a, a + rng.randint(1, 9)) for a in sorted(rng.sample(range(0, 3000, 10), n))]  # noqa: E731, B023
        rows.append((i, draw("id", i * 7), draw("email", rng.randint(0, 200)) + draw("ip", i)))
    got = spark.createDataFrame(rows, SPANS).select("id", pii._clear(F.col("s"), F.col("o")).alias("c")).collect()
    want = {i: [s for s in mine if not any(o[1] < s[2] and s[1] < o[2] for o in others)] for i, mine, others in rows}
    assert {r.id: [tuple(c) for c in r.c] for r in got} == want


def test_surroundings(spark):
    text = "é token: sk_live_0123456789abcdefAB Mr Xy, Anna Bell\t123-45-6789 " * 50
    row = spark.createDataFrame([(text,)], "text string").select(pii.candidate_spans(F.col("text")).alias("c")).first()
    assert len(row.c) >= 150
    for c in row.c:
        assert (c.m, c.left, c.after) == (text[c.start : c.stop], text[max(0, c.start - pii.CONTEXT) : c.start], text[c.stop : c.stop + 1])


def test_redact_long_text(spark):
    piece = "hé a@b.co x 1.2.3.4 "
    n = 100_000
    docs = spark.createDataFrame([(1, piece * n, 0)], "doc_id bigint, text string, n_chars bigint")
    row = pii.redacted_documents(docs).first()
    assert row.text == "hé <email> x <ip> " * n and row.n_chars == len(row.text)
