"""Numeric column functions of the count model."""

from __future__ import annotations

import math

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def log_tp10k(value: Column, total: Column) -> Column:
    """log1p of counts per ten thousand; a total of zero counts as one."""
    return F.log1p(value * 10000.0 / F.when(total == 0, F.lit(1)).otherwise(total))


def input_transforms(value: Column, cell: str = "cell", eps: float = 1e-5) -> dict[str, Column]:
    """log, normalize, normalize_log and log_normalize of non-zero entries; zeros stay zero under each."""
    by = Window.partitionBy(cell)
    logged = F.log1p(value)
    part = value / (F.sum(value).over(by) + eps)
    return {"log": logged, "normalize": part, "normalize_log": logged / (F.sum(logged).over(by) + eps), "log_normalize": F.log1p(part)}


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - a.b / (|a| |b| + 1e-10) of two arrays."""
    dot = lambda u, v: F.aggregate(F.zip_with(u, v, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, t: s + t)
    return 1 - dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + 1e-10)


def cell_logit_prior(log_counts: Column, log_cell: float, empty: float, naive: float, sure: float = 10.0) -> Column:
    """Three bands by log counts: surely empty -100, surely a cell `sure`, `naive` between."""
    return F.when(log_counts >= log_cell, F.lit(sure)).when(log_counts <= (math.log(empty) + log_cell) / 2, F.lit(-100.0)).otherwise(F.lit(naive))


def noise_rate(model: str, epsilon: Column, d_empty: Column, chi_ambient: Column | None = None, y: Column | None = None, d_cell: Column | None = None, rho: Column | None = None, chi_bar: Column | None = None) -> Column:
    """Expected noise counts of an entry."""
    if model in ("simple", "ambient"):
        return epsilon * d_empty * chi_ambient
    swapped = rho * chi_bar * (y * d_cell + d_empty)
    if model == "swapping":
        return epsilon * swapped
    if model == "full":
        return epsilon * ((1 - rho) * chi_ambient * d_empty + swapped)
    raise ValueError(f"no such model: {model}")


def signal_mean(model: str, epsilon: Column, d_cell: Column, chi: Column, y: Column | None = None, rho: Column | None = None) -> Column:
    """Expected true counts of an entry."""
    base = epsilon * d_cell * chi
    if model == "simple":
        return base
    if model == "ambient":
        return y * base
    if model in ("swapping", "full"):
        return (1 - rho) * y * base
    raise ValueError(f"no such model: {model}")


def lgamma(x: Column) -> Column:
    """log Gamma for x > 0 by a Stirling series after shifting x above 8, for x up to 1e30."""
    x = x.cast("double")
    y = x + 8
    inv = 1 / y
    series = (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + inv / 12 - F.pow(inv, F.lit(3)) / 360 + F.pow(inv, F.lit(5)) / 1260 - F.pow(inv, F.lit(7)) / 1680 + F.pow(inv, F.lit(9)) / 1188
    product = x
    for k in range(1, 8):
        product = product * (x + k)
    return series - F.ln(product)


def poisson_log_pmf(k: Column, rate: Column) -> Column:
    return k * F.ln(rate) - rate - lgamma(k + 1)


def negative_binomial_log_pmf(k: Column, mean: Column, shape: Column) -> Column:
    """Negative binomial with the given mean and total count `shape`."""
    return lgamma(k + shape) - lgamma(shape) - lgamma(k + 1) + shape * F.ln(shape / (shape + mean)) + k * F.ln(mean / (shape + mean))


def matched_negative_binomial_log_pmf(k: Column, mean: Column, shape: Column, rate: Column) -> Column:
    """Sum of a negative binomial and a Poisson by matching moments; Poisson alone where the mean is negligible."""
    total = mean + rate
    matched = negative_binomial_log_pmf(k, total, total * total * shape / (mean * mean))
    return F.when(mean < 1e-5 * rate, poisson_log_pmf(k, rate)).otherwise(matched)


def noise_log_prob(noise: Column, data: Column, mean: Column, rate: Column, shape: Column | None = None) -> Column:
    """log P(noise counts) + log P(the rest are signal); null where noise exceeds the data."""
    rest = F.greatest(data - noise, F.lit(0))
    signal = poisson_log_pmf(rest, mean) if shape is None else negative_binomial_log_pmf(rest, mean, shape)
    return F.when(noise <= data, poisson_log_pmf(noise, rate) + signal)


def flat_index(cell_pos: Column, gene_pos: Column, genes: int) -> Column:
    """One number for a cell and a gene; there is a way back only where every gene's position is in [0, genes)."""
    return cell_pos.cast("bigint") * genes + gene_pos


def cell_of(index: Column, genes: int) -> Column:
    """Whole-number division, rounded down: a quotient in doubles would err beyond 2**53."""
    return F.call_function("div", index - F.pmod(index, F.lit(genes)), F.lit(genes)).cast("bigint")


def gene_of(index: Column, genes: int) -> Column:
    return F.pmod(index, F.lit(genes)).cast("bigint")
