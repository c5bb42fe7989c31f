"""Ambient profile and concentration against numpy."""

import math

import numpy as np
from pyspark.sql import functions as F

from cytoframe.operators import empty


def ambient(alpha, cells=400, genes=60, seed=2):
    r = np.random.default_rng(seed)
    share = r.dirichlet(np.full(genes, 0.5))
    out = []
    for c in range(cells):
        own = share if alpha is None else r.dirichlet(alpha * share)
        n = r.multinomial(r.integers(5, 45), own / own.sum())
        out += [(c, g, int(k)) for g, k in enumerate(n) if k]
    # a large droplet shows every gene, so unseen ones need a share
    return out + [(cells, g, 5) for g in range(genes + 5)]


def test_good_turing_by_hand():
    # the published example of prosodic patterns: 120 kinds seen once of a total of 2004
    counts = {1: 120, 2: 40, 3: 24, 4: 13, 5: 15, 6: 5, 7: 11, 8: 2, 9: 2, 10: 1, 12: 3, 14: 2, 15: 1, 16: 1, 17: 3, 19: 1, 20: 3, 21: 2, 23: 3, 24: 3, 25: 3, 26: 2, 27: 2, 28: 1, 31: 2, 32: 2, 33: 1, 34: 2, 36: 2, 41: 3, 43: 1, 45: 3, 46: 1, 47: 1, 50: 1, 71: 1, 84: 1, 101: 1, 105: 1, 121: 1, 124: 1, 146: 1, 162: 1, 193: 1, 199: 1, 224: 1, 226: 1, 254: 1, 257: 1, 339: 1, 421: 1, 456: 1, 481: 1, 483: 1, 1140: 1, 1256: 1, 1322: 1, 1530: 1, 2131: 1, 2395: 1, 6925: 1, 7846: 1}
    total = sum(r * n for r, n in counts.items())
    unseen, share = empty.good_turing(counts)
    assert abs(unseen - 120 / total) < 1e-12 and abs(sum(share[r] * n for r, n in counts.items()) + unseen - 1) < 1e-12
    # the expected times of a kind seen once and of one seen 7846 times, as published: 0.7628 and 7838
    assert abs(share[1] * total - 0.7628) < 0.01 and abs(share[7846] * total - 7838) < 8
    assert empty.good_turing({}) == (1.0, {}) and empty.good_turing({3: 4})[0] == 0.0


def test_shares(spark):
    data = ambient(None)
    x = spark.createDataFrame(data, "cell int, gene int, n int").repartition(4)
    got = {r["gene"]: r["p"] for r in empty.ambient_shares(x, 50).collect()}
    seen = {}
    for c, g, n in data:
        if c < 400:
            seen[g] = seen.get(g, 0) + n
    assert set(got) == set(range(65)) and abs(sum(got.values()) - 1) < 1e-12 and min(got.values()) > 0
    kinds = {}
    for n in seen.values():
        kinds[n] = kinds.get(n, 0) + 1
    unseen, share = empty.good_turing(kinds)
    unseen = unseen or 0.5 / sum(seen.values())
    scale = (1 - unseen) / sum(share[n] for n in seen.values())
    assert all(abs(got[g] - share[n] * scale) < 1e-12 for g, n in seen.items())
    assert all(abs(got[g] - unseen / (65 - len(seen))) < 1e-12 for g in got if g not in seen)


def test_concentration(spark):
    for alpha in (20.0, 300.0):
        data = ambient(alpha)
        x = spark.createDataFrame(data, "cell int, gene int, n int")
        shares = empty.ambient_shares(x, 50)
        p = {r["gene"]: r["p"] for r in shares.collect()}

        def likelihood(a):
            total = 0.0
            for c in range(400):
                own = [(g, n) for d, g, n in by[c]]
                total += math.lgamma(a) - math.lgamma(sum(n for _, n in own) + a) + sum(math.lgamma(n + a * p[g]) - math.lgamma(a * p[g]) for g, n in own)
            return total

        by = {c: [row for row in data if row[0] == c] for c in range(400)}
        got = empty.concentration(x, shares, 50)
        # no better value nearby, and near the one that made the data
        assert likelihood(got) >= max(likelihood(got * 0.98), likelihood(got * 1.02)) and alpha / 2 < got < alpha * 2


def test_likelihoods(spark):
    data = ambient(50.0)
    x = spark.createDataFrame(data, "cell int, gene int, n int")
    shares = empty.ambient_shares(x, 30)
    p = {r["gene"]: r["p"] for r in shares.collect()}
    for alpha in (None, 7.0):
        for r in empty.log_likelihoods(x, shares, 30, alpha).where(F.col("cell") % 40 == 0).collect():
            own = [(g, n) for c, g, n in data if c == r["cell"]]
            t = sum(n for _, n in own)
            want = math.lgamma(t + 1) - sum(math.lgamma(n + 1) for _, n in own)
            want += sum(n * math.log(p[g]) for g, n in own) if alpha is None else math.lgamma(alpha) - math.lgamma(t + alpha) + sum(math.lgamma(n + alpha * p[g]) - math.lgamma(alpha * p[g]) for g, n in own)
            assert r["total"] == t and abs(r["ll"] - want) < 1e-6


def test_simulated_by_shares():
    """Draws by distinct shares against draws from every gene: the same mean, spread and quantiles of the likelihood at each total."""
    import pandas as pd

    p, genes, totals = np.array([0.002, 0.01, 0.1]), np.array([50, 30, 6]), np.array([1, 5, 40, 120])
    every = np.repeat(p, genes)
    assert abs(every.sum() - 1) < 1e-9
    for alpha in (None, 3.0, 200.0):
        frames = empty._simulated(p, genes, totals, 7, alpha)(iter([pd.DataFrame({"id": range(4000)})]))
        got = np.array([f["sim"].to_numpy() for f in frames])
        r = np.random.default_rng(1)
        want = np.empty((4000, len(totals)))
        for k in range(4000):
            own = every if alpha is None else r.dirichlet(alpha * every)
            drawn = r.choice(len(every), totals[-1], p=own)
            for j, t in enumerate(totals):
                n = np.bincount(drawn[:t], minlength=len(every))
                kept = np.flatnonzero(n)
                ll = math.lgamma(t + 1) - sum(math.lgamma(x + 1) for x in n[kept])
                if alpha is None:
                    ll += float((n[kept] * np.log(every[kept])).sum())
                else:
                    ll += math.lgamma(alpha) - math.lgamma(t + alpha) + sum(math.lgamma(x + alpha * q) - math.lgamma(alpha * q) for x, q in zip(n[kept], every[kept]))
                want[k, j] = ll
        # equal likelihoods of few draws differ by errors of rounding
        got, want = got.round(6), want.round(6)
        for j in range(len(totals)):
            # two samples of 4000: four standard errors
            error = math.sqrt((got[:, j].var() + want[:, j].var()) / 4000)
            assert abs(got[:, j].mean() - want[:, j].mean()) < 4 * error + 1e-9
            if j:
                both = np.sort(np.concatenate((got[:, j], want[:, j])))
                gap = np.abs(np.searchsorted(np.sort(got[:, j]), both, "right") - np.searchsorted(np.sort(want[:, j]), both, "right")).max() / 4000
                assert gap < 0.045


def test_driver_sees_no_gene(spark, monkeypatch):
    """However many genes there are, the driver gets a row for each distinct share only."""
    rows = spark.range(30000).selectExpr("id % 500 as cell", "id as gene", "cast(1 + id % 3 as bigint) as n")
    x = rows.where("cell > 50 or gene < 1000")
    frame, fetched = type(x), []
    whole = frame.collect

    def collect(self):
        out = whole(self)
        fetched.append(len(out))
        return out

    monkeypatch.setattr(frame, "collect", collect)
    out = empty.empty_droplet_test(x, lower=100, rounds=20)
    assert max(fetched) < 200
    assert x.select("gene").distinct().count() > 20000 and out.count() > 100
