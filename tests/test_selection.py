"""Selection by digits, ranks without group windows and tilts from steps, against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cytoframe.operators import noise
from cytoframe.operators.ranking import boundaries, rank_in_groups


def test_boundaries(spark):
    r = random.Random(4)
    rows = [(g, r.choice([0, 5, -7, r.randrange(-(1 << 37), 1 << 37), r.randrange(100)]), r.randrange(3)) for g in range(30) for _ in range(r.choice([0, 1, 40, 300]))]
    # one group holds most rows, most of them equal
    rows += [(99, r.choice([1 << 30, 1 << 30, 7]), 1) for _ in range(3000)]
    totals = {g: sum(w for h, _, w in rows if h == g) for g in [*range(30), 99]}
    quotas = [(g, r.choice([-1, 0, n // 2, n - 1, n, n + 5])) for g, n in totals.items()]
    got = {x["g"]: (x["edge"], x["before"]) for x in boundaries(spark.createDataFrame(rows, "g int, k bigint, w bigint"), spark.createDataFrame(quotas, "g int, quota bigint"), "g", "k", F.col("w")).collect()}
    want = {}
    for g, quota in quotas:
        total = 0
        for key in sorted({k for h, k, _ in rows if h == g}):
            own = sum(w for h, k, w in rows if h == g and k == key)
            if total + own > quota:
                want[g] = (key, total)
                break
            total += own
    assert got == want and len(want) > 10


def test_rank_in_groups(spark):
    r = random.Random(5)
    rows = [(r.choice([1, 1, 1, 2, None]), r.randrange(50), i) for i in range(900)]
    got = {x["i"]: x["r"] for x in rank_in_groups(spark.createDataFrame(rows, "g int, k int, i int").repartition(7), "g", ["k", "i"], "r").where("g is not null").collect()}
    want = {i: n for g in (1, 2) for n, (_, i) in enumerate(sorted((k, i) for h, k, i in rows if h == g), 1)}
    assert got == want


@pytest.mark.parametrize("per_gene", [True, False])
def test_tilts(spark, per_gene):
    r = random.Random(6)
    table = {m: {c: math.log(r.choice([0.01, 0.2, 0.5, r.random()])) for c in r.sample(range(12), r.choice([1, 2, 5, 9]))} for m in range(60)}
    offs = {m: r.randrange(3) for m in range(0, 60, 4)}
    gene = {m: m % 4 if per_gene else 0 for m in table}
    post = spark.createDataFrame([(m, c, lp) for m, own in table.items() for c, lp in own.items()], "m bigint, c int, log_prob double")
    best = lambda m, beta: min((-(lp + beta * c), c) for c, lp in table[m].items())[1] + offs.get(m, 0)
    total = lambda g, beta: sum(best(m, beta) for m in table if gene[m] == g)
    for share in (0.0, 0.3, 0.7, 1.2):
        goal = {g: total(g, -90) - 1 + share * (total(g, 90) - total(g, -90)) for g in set(gene.values())}
        tilts = noise.mean_tilts(post, spark.createDataFrame(list(gene.items()), "m bigint, gene int"), spark.createDataFrame(list(goal.items()), "gene int, target double"), 100.0, spark.createDataFrame(list(offs.items()), "m bigint, off int"))
        for x in tilts.collect():
            g, beta = x["gene"], x["beta"]
            steps = sorted({-(q - p) / (d - c) for m in table if gene[m] == g for c, p in table[m].items() for d, q in table[m].items() if d > c})
            ends = [-100.0, *((a + b) / 2 for a, b in zip(steps, steps[1:]) if b - a > 1e-8), 100.0]
            reachable = [t for t in (total(g, b) for b in ends) if t <= goal[g]]
            assert total(g, beta) == (max(reachable) if reachable else total(g, -100))
