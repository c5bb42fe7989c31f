"""Droplets that hold a cell: likelihood under the ambient profile, Monte Carlo p-values, adjusted for their number.

The ambient profile is smoothed by simple Good-Turing estimation, so a gene that no ambient droplet shows keeps a share, and
ambient droplets spread around it by a Dirichlet-multinomial whose concentration has the greatest likelihood.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.functions.stats import lgamma
from cytoframe.operators.components import saved
from cytoframe.operators.metrics import benjamini_hochberg


def good_turing(count_of: dict[int, int], confidence: float = 1.96) -> tuple[float, dict[int, float]]:
    """(probability of all unseen kinds, probability of one kind seen r times for each r) from the number of kinds by times seen.

    Simple Good-Turing: Turing's estimates as long as they differ from those of a line through log frequencies, then the line's.
    """
    if not count_of:
        return 1.0, {}
    rs = np.array(sorted(count_of), float)
    ns = np.array([count_of[int(r)] for r in rs], float)
    total = float((rs * ns).sum())
    unseen = count_of.get(1, 0) / total
    if len(rs) < 2:
        return unseen if unseen < 1 else 0.5, {int(r): (1 - unseen if unseen < 1 else 0.5) * r / total for r in rs}
    gaps = np.append(rs[1:], 2 * rs[-1] - rs[-2]) - np.append(0.0, rs[:-1])
    slope, level = np.polyfit(np.log(rs), np.log(2 * ns / gaps), 1)
    smooth = lambda r: np.exp(level + slope * np.log(r))
    line = (rs + 1) * smooth(rs + 1) / smooth(rs)
    out, turing = np.empty(len(rs)), True
    for i, (r, n) in enumerate(zip(rs, ns)):
        after = count_of.get(int(r) + 1, 0)
        x = (r + 1) * after / n
        turing = turing and after > 0 and abs(x - line[i]) > confidence * math.sqrt((r + 1) ** 2 * after / n**2 * (1 + after / n))
        out[i] = x if turing else line[i]
    seen = float((out * ns).sum())
    return unseen, {int(r): float((1 - unseen) * o / seen) for r, o in zip(rs, out)}


def ambient_counts(x: DataFrame, lower: int) -> DataFrame:
    """(cell, gene, n) of the droplets of at most `lower` counts."""
    low = x.groupBy("cell").agg(F.sum("n").alias("t")).where(F.col("t") <= lower).select("cell")
    return x.join(low, "cell", "left_semi").select("cell", "gene", "n")


def ambient_shares(x: DataFrame, lower: int) -> DataFrame:
    """(gene, p): smoothed shares of all genes of x in droplets of at most `lower` counts; they sum to one."""
    seen = ambient_counts(x, lower).groupBy("gene").agg(F.sum("n").alias("s"))
    every = saved(x.select("gene").distinct().join(seen, "gene", "left").select("gene", F.coalesce("s", F.lit(0)).cast("bigint").alias("r")))
    # bounded: distinct totals are no more than the root of twice the sum of all counts
    kinds = {r["r"]: r["k"] for r in every.groupBy("r").agg(F.count("*").alias("k")).collect()}
    missing = kinds.pop(0, 0)
    unseen, shares = good_turing(kinds)
    if missing:
        # what is left for the unseen is dealt to them evenly; without a kind seen once there is nothing to deal but a least share
        unseen = unseen or 0.5 / max(1, sum(r * k for r, k in kinds.items()))
    else:
        unseen = 0.0
    known = sum(shares[r] * k for r, k in kinds.items()) or 1.0
    rows = [(r, (1 - unseen) * p / known if missing else p / known) for r, p in shares.items()] + ([(0, unseen / missing)] if missing else [])
    table = x.sparkSession.createDataFrame(rows or [(0, 1.0)], "r bigint, p double")
    return every.join(F.broadcast(table), "r").select("gene", "p")


def concentration(x: DataFrame, shares: DataFrame, lower: int, lo: float = 1e-2, hi: float = 1e8, points: int = 24, rounds: int = 6) -> float:
    """The Dirichlet-multinomial concentration of the greatest likelihood of the droplets of at most `lower` counts.

    The likelihood needs how many droplets have a total and how many entries have a share and a count, both small tables;
    each round is one aggregate over them for a row of candidates.
    """
    ambient = saved(ambient_counts(x, lower))
    totals = saved(ambient.groupBy("cell").agg(F.sum("n").cast("double").alias("t")).groupBy("t").agg(F.count("*").alias("k")))
    entries = saved(ambient.join(shares, "gene").groupBy("p", F.col("n").cast("double").alias("n")).agg(F.count("*").alias("k")))
    if not totals.limit(1).count():
        return hi
    a, b = math.log(lo), math.log(hi)
    for _ in range(rounds):
        grid = np.exp(np.linspace(a, b, points)).tolist()
        tried = F.explode(F.array(*map(F.lit, grid)))
        outer = totals.withColumn("c", tried).select("c", (F.col("k") * (lgamma(F.col("c")) - lgamma(F.col("t") + F.col("c")))).alias("v"))
        inner = entries.withColumn("c", tried).select("c", (F.col("k") * (lgamma(F.col("n") + F.col("c") * F.col("p")) - lgamma(F.col("c") * F.col("p")))).alias("v"))
        # one row for each candidate
        value = {r["c"]: r["v"] for r in outer.unionByName(inner).groupBy("c").agg(F.sum("v").alias("v")).collect()}
        best = max(range(points), key=lambda i: value[grid[i]])
        a, b = math.log(grid[max(0, best - 1)]), math.log(grid[min(points - 1, best + 1)])
    return math.exp((a + b) / 2)


def log_likelihoods(x: DataFrame, shares: DataFrame, lower: int, alpha: float | None = None) -> DataFrame:
    """(cell, total, ll) of the droplets above `lower`; multinomial without a concentration."""
    n = F.col("n").cast("double")
    of = n * F.ln("p") if alpha is None else lgamma(n + alpha * F.col("p")) - lgamma(alpha * F.col("p"))
    per = x.join(shares, "gene").groupBy("cell").agg(F.sum("n").alias("total"), F.sum(of - lgamma(n + 1)).alias("s")).where(F.col("total") > lower)
    t = F.col("total").cast("double")
    whole = lgamma(t + 1) if alpha is None else lgamma(t + 1) + lgamma(F.lit(alpha)) - lgamma(t + alpha)
    return per.select("cell", "total", (F.col("s") + whole).alias("ll"))


def _simulated(p: np.ndarray, genes: np.ndarray, totals: np.ndarray, seed: int, alpha: float | None):
    """One random sequence of draws for each id; its running likelihood at every total needed, so that draws serve all totals.

    p are the distinct shares and `genes` how many genes have each. Genes of one share are alike, so a draw first takes a share
    (a Dirichlet over shares, as sums of its parts) and then a gene of it by an urn: one of the draws of that share before, or any
    of its genes. That is the distribution of drawing from all genes, without a number for each gene.
    """
    most = int(totals[-1])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = np.arange(most)
        for frame in frames:
            for i in frame["id"]:
                rng = np.random.default_rng([seed, int(i)])
                edges = np.cumsum(p * genes if alpha is None else rng.gamma(alpha * p * genes))
                kinds = np.minimum(np.searchsorted(edges, rng.random(most) * edges[-1], side="right"), len(p) - 1)
                steps = np.argsort(kinds, kind="stable")
                kind = kinds[steps]
                gene = rng.integers(0, genes[kind])
                if alpha is not None:
                    before = at - np.searchsorted(kind, kind)
                    again = rng.random(most) * (before + alpha * p[kind] * genes[kind]) < before
                    source = np.where(again, at - before + np.floor(rng.random(most) * before).astype(np.int64), at)
                    while (source != (source := source[source])).any():
                        pass
                    gene = gene[source]
                order = np.lexsort((gene, kind))
                first = np.concatenate(([True], (np.diff(kind[order]) != 0) | (np.diff(gene[order]) != 0)))
                rank = np.empty(most)
                rank[steps[order]] = at - np.maximum.accumulate(np.where(first, at, 0)) + 1
                step = at + 1
                one = np.log(p[kinds]) if alpha is None else np.log(rank - 1 + alpha * p[kinds]) - np.log(step - 1 + alpha)
                running = np.cumsum(one - np.log(rank) + np.log(step))
                yield pd.DataFrame({"total": totals, "sim": running[totals - 1]})

    return run


def empty_droplet_test(x: DataFrame, lower: int = 100, rounds: int = 1000, fdr: float = 0.01, seed: int = 1, alpha: float | str | None = "fit") -> DataFrame:
    """(cell, total, p, fdr, non_empty) of droplets above `lower` counts; alpha is a concentration, 'fit' to estimate it, or None
    for a plain multinomial.

    The distinct shares of the ambient profile, with the number of genes of each, and the distinct totals go to the simulating
    tasks. Shares are no more than the distinct ambient counts of a gene, totals no more than the largest; neither grows with
    genes or droplets as such.
    """
    spark = x.sparkSession
    shares = saved(ambient_shares(x, lower))
    alpha = concentration(x, shares, lower) if alpha == "fit" else alpha
    seen = log_likelihoods(x, shares, lower, alpha)
    kinds = sorted(tuple(r) for r in shares.groupBy("p").agg(F.count("*").alias("k")).collect())
    p, genes = np.array([r[0] for r in kinds]), np.array([r[1] for r in kinds], np.int64)
    totals = np.array(sorted(r["total"] for r in seen.select("total").distinct().collect()), np.int64)
    if not len(totals):
        return seen.select("cell", "total", F.lit(None).cast("double").alias("p"), F.lit(None).cast("double").alias("fdr"), F.lit(False).alias("non_empty"))
    sims = spark.range(rounds).mapInPandas(_simulated(p, genes, totals, seed, alpha), "total bigint, sim double").groupBy("total").agg(F.collect_list("sim").alias("sims"))
    below = F.size(F.filter("sims", lambda s: s <= F.col("ll")))
    tested = seen.join(sims, "total").select("cell", "total", ((below + 1) / F.lit(rounds + 1.0)).alias("p"))
    return benjamini_hochberg(tested).withColumn("non_empty", F.col("fdr") <= fdr)
