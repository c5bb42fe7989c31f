"""Every operator on nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

import hashlib
from collections import Counter

import pytest
from llm_cases import CLASH, edge_rows
from pyspark.sql import functions as F

from cytoframe.llm import bpe, fingerprints, langid, mixing, passages, pii, quality, sharding, simhash, telephony
from cytoframe.llm.queries import ranks_path, split_pattern

ROWS = edge_rows()
IDS = Counter(r[0] for r in ROWS)


def ids_of(df):
    return Counter(r["doc_id"] for r in df.collect())


def test_language(edges, nothing):
    model = langid.train(["the cat sat on the mat and then"] * 4 + ["der hund und die katze sind da"] * 4, ["en"] * 4 + ["de"] * 4, steps=3)
    got = langid.languages(edges, model).collect()
    assert Counter(r["doc_id"] for r in got) == IDS
    assert all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by[1] == by[2] == by[3] == by[11] == "und" and by[10] in ("en", "de")
    assert langid.languages(nothing, model).count() == 0
    assert langid.language_fit(nothing).languages == []
    assert {r["lang_pred"] for r in langid.languages(edges, langid.LanguageModel([], [])).collect()} == {"und"}
    fitted = langid.language_fit(edges)
    assert set(fitted.languages) <= {"en", "de", "fr", "es"}


def test_quality(edges, nothing, labels):
    model = quality.quality_fit(edges, labels)
    got = quality.quality_scores(edges, model)
    assert ids_of(got) == IDS
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    assert quality.quality_scores(nothing, model).count() == 0
    assert quality.quality_fit(nothing, labels.limit(0)).weights == [0.5]
    kept = quality.accepted_documents(edges, quality.QualityModel(None, None, False, [0.9]))
    assert kept.columns == edges.columns and kept.count() == len(ROWS)
    good, bad = [f"good words number {i} run on and on" for i in range(40)], [f"### $$$ {i} &&& %%%" for i in range(40)]
    two = quality.fit_texts(good, bad, 0.5).scorer()
    assert two.scores(["good words number 3000 run on"])[0] > 0.5 > two.scores(["### $$$ 77 &&& %%% ###"])[0]
    assert len(two.scores(["", "x" * 100000])) == 2


def test_bpe(edges, nothing):
    import tiktoken  # noqa: F401

    got = bpe.bpe_digests(edges, ranks_path(), split_pattern())
    assert ids_of(got) == IDS
    want = Counter((r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in ROWS)
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in got.collect()) == want
    tokens = bpe.bpe_tokens(edges, ranks_path(), split_pattern())
    back = bpe.bpe_texts(tokens, ranks_path(), split_pattern()).collect()
    assert Counter((r["doc_id"], bytes(r["decoded"])) for r in back) == Counter((r[0], (r[1] or "").encode()) for r in ROWS)
    assert bpe.bpe_digests(nothing, ranks_path(), split_pattern()).count() == 0


def test_telephony(edges, nothing):
    got = telephony.telephony_digests(edges).collect()
    assert Counter(r["doc_id"] for r in got) == IDS
    for r in got:
        assert r["payload_bytes"] % 192 == 0 and r["payload_bytes"] >= 192
    empty = [r for r in got if r["doc_id"] in (1, 2)]
    assert len({r["media_sha256"] for r in empty}) == 1 and empty[0]["payload_sha256"] == hashlib.sha256(b" " * 192).hexdigest()
    media = telephony.telephony_media(edges).where("doc_id = 5").first()
    assert telephony.load(bytes(media["media"]))[1].rstrip(b" ").decode() == ROWS[4][1]
    assert telephony.telephony_digests(nothing).count() == 0


def test_pii(edges, nothing):
    model = pii.pii_fit(edges)
    got = pii.pii_spans(edges, model)
    assert ids_of(got) == IDS
    assert got.columns == [{"base": "base_input", "added": "added_input"}.get(c, c) for c in edges.columns] + ["base", "added"]
    assert all(r[{"base": "base_input", "added": "added_input"}.get(c, c)] == "clash" for r in got.collect() for c in CLASH)
    assert "base_input_input" in pii.pii_spans(nothing.withColumns({"base": F.lit(1), "base_input": F.lit(2)}), model).columns
    kinds = Counter(s["kind"] for r in got.collect() if r["doc_id"] is None for s in r["base"])
    assert kinds == {"phone": 1, "email": 1}
    clean = pii.redacted_documents(edges)
    assert clean.columns == edges.columns
    rows = clean.collect()
    assert Counter(r["doc_id"] for r in rows) == IDS and all(r[c] == "clash" for r in rows for c in CLASH)
    text = next(r["text"] for r in rows if r["doc_id"] is None and r["text"])
    assert text == "one text without an id <phone> <email>"
    assert sum(r["text"] is None for r in rows) == 2
    assert pii.pii_spans(nothing, pii.pii_fit(nothing)).count() == 0
    assert pii.redacted_documents(nothing).count() == 0


def test_fingerprints(edges, nothing, spark):
    got = fingerprints.document_fingerprints(edges)
    assert ids_of(got) == IDS
    rows = sorted(((r[0] if r[0] is not None else fingerprints._NONE, r[1] or "") for r in ROWS))
    want = Counter()
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        want[(None if i == fingerprints._NONE else i, hashlib.sha256(fingerprints.edited(t, nxt).encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in got.collect()) == want
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got.collect())
    assert fingerprints.document_fingerprints(nothing).count() == 0
    one = fingerprints.document_fingerprints(nothing.unionByName(spark.createDataFrame([(3, "abc def", "en", "a", 7)], nothing.schema))).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_passages(edges, nothing):
    got = passages.repeated_passages(edges).collect()
    assert {r["doc_id"] for r in got} == {5, 6, 7}
    assert all(r["class_id"] == 5 for r in got)
    assert passages.repeated_passages(nothing).count() == 0


def test_shards(edges, nothing):
    for limit in (50, 20000, 1 << 30):
        got = sharding.assign_shards(edges, limit).collect()
        assert Counter(r["doc_id"] for r in got) == IDS
        size = Counter()
        for r in got:
            size[r["shard"]] += r["n_bytes"]
        assert all(size[r["shard"]] == r["shard_bytes"] for r in got)
        assert all(r["over"] or r["shard_bytes"] <= limit for r in got)
        assert all(not r["over"] or r["n_bytes"] > limit for r in got)
    assert sharding.assign_shards(nothing, 100).count() == 0


def test_write_shards(edges, spark, tmp_path):
    sharding.write_shards(edges.drop("shard"), str(tmp_path / "out"), 20000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(ROWS) and set(edges.columns) == set(back.columns)


def test_mixing(edges, nothing):
    got = mixing.mix_copies(edges).collect()
    assert Counter(r["doc_id"] for r in got) == IDS
    for r in got:
        assert 0 <= r["copies"] <= 3
    again = mixing.mix_copies(edges.repartition(7)).collect()
    assert Counter((r["doc_id"], r["source"], r["copies"]) for r in got) == Counter((r["doc_id"], r["source"], r["copies"]) for r in again)
    rows = mixing.mixed_documents(edges)
    assert rows.columns == edges.columns and rows.count() == sum(r["copies"] for r in got)
    assert mixing.mix_copies(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def test_simhash(edges, nothing):
    got = simhash.simhash_groups(edges).collect()
    assert Counter(r["doc_id"] for r in got) == IDS
    by = {(r["doc_id"]): r["component_id"] for r in got}
    assert by[1] == by[2] == by[3] == 1 and by[6] == 5
    kept = simhash.keep_one(edges)
    assert kept.columns == edges.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 6 not in ids and {1, 4, 5} <= set(ids)
    assert simhash.simhash_groups(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


@pytest.mark.parametrize("size", [0, 1, 5])
def test_one_column_of_nulls(spark, size):
    rows = [(None, None, None, None, None)] * size
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert mixing.mix_copies(df).count() == size
    assert simhash.simhash_groups(df).count() == size
    assert sharding.assign_shards(df, 10).count() == size
    assert fingerprints.document_fingerprints(df).count() == size
    assert simhash.keep_one(df).count() == min(size, 1)
