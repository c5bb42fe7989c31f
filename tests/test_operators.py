"""Operators on small literal tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cytoframe.functions import sequences, stats
from cytoframe.operators import features, labels, layers, matching, metrics, noise, profile, umis
from cytoframe.operators.components import components


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_label_assignment(spark):
    obs = spark.createDataFrame([(f"CELL_00{i}",) for i in range(1, 6)], "cell string")
    mapping = spark.createDataFrame([("CELL_001", "Type1"), ("CELL_003", "Type2"), ("CELL_999", "Type1"), ("CELL_005", "Type3"), ("CELL_004", "Other")], "cell string, label string")
    cats = spark.createDataFrame([("Type1",), ("Type2",), ("Type3",), ("Type4",)], "name string")
    got = dict(rows(labels.categorical(obs, mapping, cats, "cell_type"), "cell", "cell_type"))
    assert got == {"CELL_001": "Type1", "CELL_002": None, "CELL_003": "Type2", "CELL_004": None, "CELL_005": "Type3"}


def test_priority_table(spark):
    put = lambda *c: spark.createDataFrame([(x,) for x in c], "cell string")
    lists = {"ambiguous": put("001", "002"), "doublet": put("003", "001"), "missing_cells": put("004"), "unassignable": put("005", "006")}
    given = spark.createDataFrame([("007", "BC123"), ("008", "BC456"), ("001", "BC789")], "cell string, value string")
    assert rows(labels.priority_table(lists, given), "cell", "value") == [("001", "doublet"), ("002", "ambiguous"), ("003", "doublet"), ("004", "missing_cells"), ("005", "unassignable"), ("006", "unassignable"), ("007", "BC123"), ("008", "BC456")]


def test_first_and_last_win(spark):
    t = spark.createDataFrame([("a", "x", 0), ("a", "y", 1), ("b", "z", 2)], "cell string, label string, ord int")
    assert rows(labels.last_wins(t, "cell", "label", "ord"), "cell", "label") == [("a", "y"), ("b", "z")]
    assert rows(labels.first_wins(t, "cell", "label", "ord"), "cell", "label") == [("a", "x"), ("b", "z")]


def test_category_order(spark):
    t = spark.createDataFrame([("s2",), ("filtered",), ("doublets",), ("s1",)], "category string")
    assert [r["category"] for r in labels.category_order(t).orderBy("pos").collect()] == ["s1", "s2", "doublets", "filtered"]


@pytest.fixture(scope="module")
def posterior(spark):
    table = {1: [1.0], 2: [0.0, 1.0], 3: [0.0, 0.0, 1.0], 4: [0.5, 0.3, 0.2], 5: [0.1, 0.2, 0.4, 0.3], 6: [0.25, 0.25, 0.25, 0.25], 7: [0.05, 0.05, 0.1, 0.2, 0.6], 8: [0.7, 0.2, 0.1]}
    data = [(m, c, math.log(p)) for m, ps in table.items() for c, p in enumerate(ps) if p]
    random.Random(0).shuffle(data)
    return spark.createDataFrame(data, "m bigint, c int, log_prob double"), table


def test_point_estimates(spark, posterior):
    post, table = posterior
    off = spark.createDataFrame([(8, 1)], "m bigint, off int")
    mean = dict(rows(noise.mean_noise(post, off), "m", "noise"))
    assert all(abs(mean[m] - sum(c * p for c, p in enumerate(ps)) - (m == 8)) < 1e-9 for m, ps in table.items())
    assert dict(rows(noise.map_noise(post, off), "m", "noise")) == {m: max(range(len(ps)), key=lambda c: (ps[c], -c)) + (m == 8) for m, ps in table.items()}
    cdf = dict(rows(noise.cdf_noise(post, 0.35), "m", "noise"))
    assert cdf == {1: 0, 2: 0, 3: 0, 4: 0, 5: 2, 6: 1, 7: 3, 8: 0}
    draw = dict(rows(noise.sampled_noise(post, 1), "m", "noise"))
    assert all(table[m][c] > 0 for m, c in draw.items()) and draw == dict(rows(noise.sampled_noise(post, 1), "m", "noise"))


@pytest.mark.parametrize("move", [-2, -1, 0, 1, 2, 4])
def test_knapsack_reaches_targets(spark, posterior, move):
    post, table = posterior
    genes = spark.createDataFrame([(m, m % 2) for m in table], "m bigint, gene int")
    best = noise.map_noise(post)
    have = {r["gene"]: r["n"] for r in best.join(genes, "m").groupBy("gene").agg(F.sum("noise").alias("n")).collect()}
    target = spark.createDataFrame([(g, max(0, n + move)) for g, n in have.items()], "gene int, target bigint")
    got = noise.knapsack_noise(post, genes, target).join(genes, "m").groupBy("gene").agg(F.sum("noise").alias("n")).collect()
    room = {g: sum(len(ps) - 1 for m, ps in table.items() if m % 2 == g) for g in have}
    low = {g: sum(next(c for c, p in enumerate(ps) if p) for m, ps in table.items() if m % 2 == g) for g in have}
    assert {r["gene"]: r["n"] for r in got} == {g: min(max(n + move, low[g]), room[g]) for g, n in have.items()}


@pytest.mark.parametrize("alpha", [0.0, 0.5, 1.0])
def test_quantile_regularisation(spark, posterior, alpha):
    post, table = posterior
    got = dict(rows(noise.mean_noise(noise.quantile_regularised(post, alpha)), "m", "noise"))
    for m, ps in table.items():
        mean = sum(c * p for c, p in enumerate(ps))
        std = math.sqrt(sum(p * (c - mean) ** 2 for c, p in enumerate(ps)))
        assert abs(got[m] - min(mean + alpha * std, len(ps) - 1)) < 1e-3


def test_mean_regularisation(spark, posterior):
    post, table = posterior
    genes = spark.createDataFrame([(m, 0) for m in table], "m bigint, gene int")
    target = spark.createDataFrame([(0, 14.0)], "gene int, target double")
    got = noise.map_noise(noise.mean_regularised(post, genes, target)).agg(F.sum("noise")).first()[0]
    assert 10 <= got <= 14


def test_denoised_restores_ignored_genes(spark):
    raw = spark.createDataFrame([("a", 1, 5), ("a", 2, 1), ("b", 1, 2), ("b", 3, 4)], "cell string, gene int, n bigint")
    noise_counts = spark.createDataFrame([("a", 1, 2), ("a", 2, 1), ("b", 1, 1)], "cell string, gene int, noise bigint")
    cells = spark.createDataFrame([("a",)], "cell string")
    out = noise.denoised(raw, noise_counts, cells)
    assert rows(out, "cell", "gene", "n") == [("a", 1, 3)]
    ignored = spark.createDataFrame([(3,)], "gene int")
    assert rows(noise.restored(out, raw, ignored), "cell", "gene", "n") == [("a", 1, 3), ("b", 3, 4)]


def test_sequences(spark):
    df = spark.createDataFrame([("ACGT", "ACTT"), ("AAAA", "TTTT"), ("", ""), ("A", "AC")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(sequences.hamming(a, b)).collect()] == [1, 4, 0, None]
    got = df.where("a = 'ACGT'").select(sequences.neighbours(a).alias("n"), sequences.lowercase_mismatches(a, b).alias("l"), sequences.substrings(a, F.lit(3)).alias("s")).first()
    assert len(set(got["n"])) == 12 and all(sum(x != y for x, y in zip("ACGT", n)) == 1 for n in got["n"])
    assert got["l"] == "ACtT" and [s["part"] for s in got["s"]] == ["ACG", "CGT"]
    ns = spark.createDataFrame([("ANC",), ("NNN",), ("ACG",)], "s string")
    assert [len(r[0]) for r in ns.select(sequences.expand_n(F.col("s"), 2)).collect()] == [4, 0, 1]


def test_lgamma(spark):
    xs = [0.01, 0.5, 1.0, 2.0, 3.7, 10.0, 250.5, 1e5]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(stats.lgamma(F.col("x"))).collect()
    assert all(abs(r[0] - math.lgamma(x)) < 1e-8 * max(1, abs(math.lgamma(x))) for r, x in zip(got, xs))


@pytest.mark.parametrize("stringency,want", [(0, [("c", "f1", 2), ("c", "f2", 1)]), (500, [("c", "f1", 2)]), (1000, [("c", "f1", 1)])])
def test_umi_rules(spark, stringency, want):
    data = [("c", "AAAA", "f1", 3), ("c", "AAAT", "f1", 1), ("c", "AATT", "f2", 1), ("c", "GGGG", "f1", 2)]
    u = spark.createDataFrame(data, "cell string, umi string, feature string, n bigint")
    comps = umis.umi_components(u)
    assert rows(comps, "umi", "root") == [("AAAA", "AAAA"), ("AAAT", "AAAA"), ("AATT", "AAAA"), ("GGGG", "GGGG")]
    assert rows(umis.umi_components(u, most_edges=1), "umi", "root") == rows(comps, "umi", "root")
    assert rows(umis.deduped_counts(u, comps, stringency), "cell", "feature", "n") == want


def test_components_join_long_paths(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101)], "u bigint, v bigint")
    assert {r["node"]: r["root"] for r in components(e).collect()} == {i: 0 for i in range(31)} | {100: 100, 101: 100}


def test_barcodes_are_corrected_or_deferred(spark):
    white = spark.createDataFrame([("AAAA",), ("AAAT",), ("CCCC",), ("GGGG",)], "barcode string")
    reads = spark.createDataFrame([(1, "AAAA"), (2, "CCCG"), (3, "AAAC"), (4, "TTTT"), (5, "GGGN"), (6, "NNGG")], "read_id int, barcode string")
    got = {r["read_id"]: (r["state"], r["corrected"]) for r in matching.correct_barcodes(reads, white).collect()}
    assert got == {1: ("exact", "AAAA"), 2: ("corrected", "CCCC"), 3: ("deferred", None), 4: ("rejected", None), 5: ("corrected", "GGGG"), 6: ("rejected", None)}
    deferred = spark.createDataFrame([(3, "AAAC", "III#", ["AAAA", "AAAT"])], "read_id int, barcode string, qual string, candidates array<string>")
    seen = spark.createDataFrame([("AAAA", 500), ("AAAT", 1)], "barcode string, n bigint")
    assert [(r["read_id"], r["corrected"]) for r in matching.resolve_deferred(deferred, seen).collect()] == [(3, "AAAA")]


def test_top_two_ties_and_singles(spark):
    feat = spark.createDataFrame([("a", "x", 3), ("a", "y", 3), ("b", "x", 4), ("b", "z", 1), ("c", "q", 2)], "cell string, feature string, n bigint")
    obs = spark.createDataFrame([(c,) for c in "abcd"], "cell string")
    got = {r["cell"]: tuple(r)[1:] for r in features.top_two(feat, obs).collect()}
    assert got == {"a": ("", 3, 3), "b": ("x", 4, 1), "c": ("q", 2, 0), "d": ("", None, None)}
    assert rows(features.assign_feature(feat, 2), "cell", "feature") == [("b", "x"), ("c", "q")]


def test_layers_sum_and_align(spark):
    lay = spark.createDataFrame([("s", "a", 1, 2), ("u", "a", 1, 3), ("u", "b", 2, 1)], "layer string, cell string, gene int, n bigint")
    assert rows(layers.sum_layers(lay), "cell", "gene", "n") == [("a", 1, 5), ("b", 2, 1)]
    obs = spark.createDataFrame([("a",), ("z",)], "cell string")
    assert rows(layers.align_with_zeros(obs, spark.createDataFrame([("a", 7)], "cell string, v int"), ["v"]), "cell", "v") == [("a", 7), ("z", 0)]


def test_profile_kinds(spark):
    df = spark.createDataFrame([(0, 0, -3, 0.5, 2.0, -1.5, None), (1, 5, 4, 0.25, 3.0, 4.2, None), (1, 9, 2, 0.75, 9.0, 99.5, None)], "b int, c int, s int, p double, w double, l double, e double")
    got = {r["col_name"]: r["kind"] for r in profile.column_profile(df, df.columns).collect()}
    assert got == {"b": "binary (0/1)", "c": "count data", "s": "signed integers", "p": "normalized/probability values", "w": "float-stored integers", "l": "continuous values", "e": "all missing"}


def test_slots():
    assert [profile.slot_of(*a) for a in ((5, 5, 9), (9, 5, 9), (5, 5, 5), (5, 5, 9, 2), (3, 5, 9))] == ["obs", "var", "obs", "obsm", "uns"]


def test_metrics_guard_empty_totals(spark):
    none = spark.createDataFrame([], "cell string, gene int, n bigint")
    row = metrics.removal_metrics(none, none, spark.createDataFrame([], "cell string")).first()
    assert row["found_cells"] == 0 and row["fraction_counts_removed"] is None


def test_global_positions_and_minima(spark):
    from cytoframe.operators.ranking import global_row_number, running_minimum_from_end

    values = random.Random(2).sample(range(10000), 500)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    got = global_row_number(df, ["v"], "pos")
    assert {r["v"]: r["pos"] for r in got.collect()} == {v: i + 1 for i, v in enumerate(sorted(values))}
    seq = [(i, (i * 7919) % 1009) for i in range(300)]
    low = running_minimum_from_end(spark.createDataFrame(seq, "pos int, v int"), "pos", "v", "least", block=16)
    assert {r["pos"]: r["least"] for r in low.collect()} == {i: min(v for _, v in seq[i:]) for i, _ in seq}


def test_empty_droplets(spark):
    from cytoframe.operators.empty import empty_droplet_test

    r = random.Random(8)
    data = []
    for c in range(300):  # ambient droplets, some of them large
        total = 20 if c < 250 else 150
        for _ in range(total):
            data.append((c, int(30 * r.random() ** 2)))
    for c in range(300, 320):  # cells express other genes
        for _ in range(150):
            data.append((c, 25 + r.randrange(5)))
    x = spark.createDataFrame(data, "cell int, gene int").groupBy("cell", "gene").agg(F.count("*").alias("n"))
    got = {row["cell"]: row["non_empty"] for row in empty_droplet_test(x, lower=50, rounds=400).collect()}
    assert set(got) == set(range(250, 320)) and all(got[c] for c in range(300, 320)) and sum(got[c] for c in range(250, 300)) <= 2
