"""Ids of other types, extreme ids, and keys with very many rows in the near-duplicate operator."""

import random
from collections import Counter

import pytest
from test_llm_operators import brute_fingerprint, components_of

from cytoframe.llm import simhash


def test_string_ids(spark):
    rows = [("b", "same words in this text"), ("a", "same words in this text"), ("10", "quite another text stands here"), ("9", "quite another text stands here"), (None, "alone")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert Counter(r["doc_id"] for r in simhash.keep_one(df).collect()) == Counter(["a", "10", None])
    by = {r["doc_id"]: r["component_id"] for r in simhash.simhash_groups(df).collect()}
    assert by == {"a": "a", "b": "a", "9": "10", "10": "10", None: None}


def test_the_least_id_is_an_id(spark):
    least = -(1 << 63)
    df = spark.createDataFrame([(least, "one two three"), (None, "one two three"), (7, "one two three"), (None, "four five six seven"), (None, "four five six seven")], "doc_id bigint, text string")
    assert Counter((r["doc_id"], r["text"]) for r in simhash.keep_one(df).collect()) == Counter([(least, "one two three"), (None, "four five six seven")])


@pytest.mark.parametrize("parts", [1, 9])
def test_keys_with_very_many_rows(spark, parts):
    """A third of all rows repeat one id and text, a third have no text, some share an id but not the text."""
    r = random.Random(4)
    rows = [(3, "a row that a third of all others repeat", f"x{i % 5}") for i in range(600)]
    rows += [(1000 + i, None if i % 2 else "", "e") for i in range(600)]
    rows += [(2000 + i % 500, " ".join(f"w{r.randrange(40)}" for _ in range(4)), f"y{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n string").repartition(parts)
    fps = Counter((i, t) for i, t, _ in rows)
    by_fp: dict = {}
    for i, t in fps:
        by_fp.setdefault(brute_fingerprint(t or ""), []).append(i)
    roots = components_of({fp: fp for fp in by_fp})
    least: dict = {}
    for fp, ids in by_fp.items():
        least[roots[fp]] = min([*ids, least.get(roots[fp], 1 << 62)])
    got = simhash.simhash_groups(df).collect()
    want = Counter((i, least[roots[brute_fingerprint(t or "")]]) for i, t, _ in rows)
    assert Counter((g["doc_id"], g["component_id"]) for g in got) == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert Counter(k["doc_id"] for k in kept.collect()) == Counter(least.values())
    assert all((k["doc_id"], k["text"], k["n"]) in set(rows) for k in kept.collect())
