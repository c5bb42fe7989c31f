"""The pipeline's stages, each judged on its own input."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from llm_cases import CLASH
from test_llm_operators import brute_fingerprint, brute_spans, components_of

from cytoframe.llm import bpe, quality, queries


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    """The input of each stage and the last result."""
    home = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(str(home / str(k)))
        docs = spark.read.parquet(str(home / str(k)))
        out.append(docs)
    return out


def test_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality_stage(spark, small, stages):
    model = quality.quality_fit(stages[0], spark.read.parquet(f"{small}/labels.parquet"))
    keep = {r["doc_id"] for r in quality.quality_scores(stages[0], model).where("score >= 0.7").collect()}
    assert {r["doc_id"] for r in stages[1].collect()} == keep


def test_dedup_stage(stages):
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in stages[1].collect()}
    assert Counter(r["doc_id"] for r in stages[2].collect()) == Counter(set(components_of(fps).values()))


def test_pii_stage(stages):
    before = {r["doc_id"]: r for r in stages[2].collect()}
    for r in stages[3].collect():
        old = before[r["doc_id"]]["text"]
        assert not brute_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not brute_spans(old) and "token" not in old:
            assert r["text"] == old


def test_mixing_stage(stages):
    rows = Counter(r["doc_id"] for r in stages[4].collect())
    known = {r["doc_id"] for r in stages[3].collect()}
    assert set(rows) <= known and max(rows.values()) <= 3
    words = lambda df: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in df.collect())
    assert abs(words(stages[4]) - words(stages[3])) < 0.15 * words(stages[3])


def test_token_stage(stages):
    enc = bpe.encoding(queries.ranks_path(), queries.split_pattern())
    want = Counter((r["doc_id"], tuple(enc.encode_ordinary(r["text"]))) for r in stages[4].collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in stages[5].collect()) == want


def test_run_equals_stages(spark, small, stages):
    got = corpus_pipeline.run(spark, small)
    assert got.columns == stages[-1].columns and got.count() == stages[-1].count()


def test_edges_pass_every_stage(spark, edges, nothing, labels, tmp_path):
    for name, docs in (("edges", edges), ("nothing", nothing)):
        home = tmp_path / name
        docs.write.parquet(str(home / "documents.parquet"))
        labels.write.parquet(str(home / "labels.parquet"))
        cur = spark.read.parquet(str(home / "documents.parquet"))
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, cur, str(home)).write.parquet(str(home / f"s{k}"))
            cur = spark.read.parquet(str(home / f"s{k}"))
            if k < 4:
                assert cur.columns == docs.columns
                if name == "edges":
                    assert all(r[c] == "clash" for r in cur.collect() for c in CLASH)
    assert cur.count() == 0
