"""Noise counts from a sparse posterior (m, c, log_prob), with offsets (m, off) and genes (m, gene)."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.operators.components import saved
from cytoframe.operators.ranking import boundaries, rank_in_groups, with_groups


def _with_offsets(est: DataFrame, offsets: DataFrame | None, kind: str = "bigint") -> DataFrame:
    """Add the offset of each entry (0 without one) to its estimate."""
    if offsets is None:
        return est.select("m", F.col("noise").cast(kind).alias("noise"))
    return est.join(offsets, "m", "left").select("m", (F.col("noise") + F.coalesce("off", F.lit(0))).cast(kind).alias("noise"))


def mean_noise(post: DataFrame, offsets: DataFrame | None = None) -> DataFrame:
    """(m, noise): the posterior mean."""
    return _with_offsets(post.groupBy("m").agg(F.sum(F.exp("log_prob") * F.col("c")).alias("noise")), offsets, "double")


def map_noise(post: DataFrame, offsets: DataFrame | None = None) -> DataFrame:
    """(m, noise): the most probable count, the smaller one of equals."""
    return _with_offsets(post.groupBy("m").agg(F.max_by("c", F.struct("log_prob", -F.col("c"))).alias("noise")), offsets)


def cumulative(post: DataFrame) -> DataFrame:
    """Add cdf, the probability of at most c."""
    by = Window.partitionBy("m").orderBy("c").rowsBetween(Window.unboundedPreceding, 0)
    return post.withColumn("cdf", F.sum(F.exp("log_prob")).over(by))


def cdf_noise(post: DataFrame, q: float, offsets: DataFrame | None = None) -> DataFrame:
    """(m, noise): the number of counts whose cumulative probability is at most q."""
    return _with_offsets(cumulative(post).groupBy("m").agg(F.count_if(F.col("cdf") <= q).alias("noise")), offsets)


def sampled_noise(post: DataFrame, seed: int = 0, offsets: DataFrame | None = None) -> DataFrame:
    """(m, noise): one draw for each entry by inverse cumulative probability; the draw is the first 52 bits of the md5 of m and the seed."""
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("m").cast("string"), F.lit(str(seed)))), 1, 13), 16, 10).cast("double") / float(1 << 52)
    total = Window.partitionBy("m")
    rows = cumulative(post).withColumn("_all", F.max("cdf").over(total))
    return _with_offsets(rows.groupBy("m").agg(F.min(F.when(F.col("cdf") > u * F.col("_all"), F.col("c"))).alias("noise")), offsets)


def noise_targets(post: DataFrame, genes: DataFrame, raw: DataFrame, fpr: float, offsets: DataFrame | None = None) -> DataFrame:
    """(gene, target): mean noise plus fpr times the counts that the mean leaves as signal."""
    mean = mean_noise(post, offsets).join(genes, "m").groupBy("gene").agg(F.sum("noise").alias("mean"))
    total = raw.groupBy("gene").agg(F.sum("n").alias("raw"))
    return total.join(mean, "gene", "left").select("gene", (F.coalesce("mean", F.lit(0.0)) + fpr * (F.col("raw") - F.coalesce("mean", F.lit(0.0)))).alias("target"))


def knapsack_noise(post: DataFrame, genes: DataFrame, targets: DataFrame, offsets: DataFrame | None = None, cost_digits: int = 9) -> DataFrame:
    """(m, noise): the most probable counts, moved by the cheapest unit steps until each gene has its target where it can.

    A step's cost is the loss of log probability between neighbouring counts, rounded so that floating-point noise does
    not decide between equal ones; those go by entry and count. Genes below their target step up, genes
    above it down, and settled genes are left out before the windows. The cost at which a gene's target is reached is found
    by summing steps by digits of their cost, so no gene's steps are brought together.
    """
    best = map_noise(post).withColumnRenamed("noise", "map")
    full = _with_offsets(best.withColumnRenamed("map", "noise"), offsets)
    have = full.join(genes, "m").groupBy("gene").agg(F.sum("noise").alias("have"))
    open_ = have.join(targets, "gene").select("gene", (F.col("target").cast("bigint") - F.col("have")).alias("gap")).where("gap <> 0")
    rows = post.join(genes, "m").join(open_, "gene").join(best, "m")
    ahead = rows.where(((F.col("gap") > 0) & (F.col("c") >= F.col("map"))) | ((F.col("gap") < 0) & (F.col("c") <= F.col("map"))))
    order = Window.partitionBy("m").orderBy("c")
    step = F.when(F.col("gap") > 0, F.col("log_prob") - F.lag("log_prob").over(order)).otherwise(F.col("log_prob") - F.lead("log_prob").over(order))
    costs = ahead.withColumn("delta", F.round(F.abs(step), cost_digits)).where("delta is not null and c <> map")
    key = F.round(F.col("delta") * 10**cost_digits).cast("bigint")
    costs = saved(costs.select("gene", "m", "c", "gap", key.alias("key")))
    quota = open_.select("gene", F.abs("gap").alias("quota"))
    edge = boundaries(costs, quota, "gene", "key", F.lit(1).cast("bigint"))
    judged = costs.join(edge.join(quota, "gene"), "gene", "left")
    sure = judged.where(F.col("edge").isNull() | (F.col("key") < F.col("edge"))).select("m", "gap")
    # only steps that cost as much as the last one affordable are ranked
    tied = rank_in_groups(judged.where("key = edge").select("gene", "m", "c", "gap", (F.col("quota") - F.col("before")).alias("left")), "gene", ["m", "c"], "r")
    taken = sure.unionByName(tied.where(F.col("r") <= F.col("left")).select("m", "gap"))
    steps = taken.groupBy("m").agg(F.sum(F.signum("gap").cast("bigint")).alias("steps"))
    return full.join(steps, "m", "left").select("m", (F.col("noise") + F.coalesce("steps", F.lit(0))).alias("noise"))


def denoised(raw: DataFrame, noise: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Raw counts less noise (columns cell, gene, n; noise by cell and gene); entries of other cells and zeros go."""
    kept = raw if cells is None else raw.join(cells.select("cell"), "cell", "left_semi")
    total = noise.groupBy("cell", "gene").agg(F.sum("noise").alias("noise"))
    left = kept.join(total, ["cell", "gene"], "left").withColumn("n", F.col("n") - F.coalesce("noise", F.lit(0))).drop("noise")
    return left.where("n <> 0")


def restored(denoised_counts: DataFrame, raw: DataFrame, ignored_genes: DataFrame) -> DataFrame:
    """Denoised counts with the columns of ignored genes passed on as they came."""
    return denoised_counts.join(ignored_genes, "gene", "left_anti").unionByName(raw.join(ignored_genes, "gene", "left_semi").select(*denoised_counts.columns))


def sparsified(post: DataFrame, least: float = -10.0) -> DataFrame:
    return post.where(F.col("log_prob") >= least)


def normalised(post: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Log probabilities shifted so that those of an entry sum to one (log-sum-exp under a maximum)."""
    by = Window.partitionBy(*(keys or ["m"]))
    top = F.max("log_prob").over(by)
    shifted = post.withColumn("_t", top).withColumn("_z", F.sum(F.exp(F.col("log_prob") - F.col("_t"))).over(by))
    return shifted.withColumn("log_prob", F.col("log_prob") - F.col("_t") - F.ln("_z")).drop("_t", "_z")


def tilted(post: DataFrame, beta: DataFrame, key: str = "m") -> DataFrame:
    """Posterior under the weight exp(beta c), normalised."""
    return normalised(post.join(beta.select(key, "beta"), key).withColumn("log_prob", F.col("log_prob") + F.col("beta") * F.col("c")).drop("beta"))


def _bisect(lo: Column, hi: Column, low_enough: Callable[[Column], Column], rounds: int) -> Column:
    """The point in [lo, hi] where low_enough turns false, by halving inside one expression."""
    start = F.struct(lo.alias("lo"), hi.alias("hi"))

    def halve(acc, _):
        mid = (acc["lo"] + acc["hi"]) / 2
        return F.element_at(F.transform(F.array(mid), lambda m: F.when(low_enough(m), F.struct(m.alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), m.alias("hi")))), 1)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, halve, lambda acc: (acc["lo"] + acc["hi"]) / 2)


def quantile_regularised(post: DataFrame, alpha: float, span: float = 100.0, rounds: int = 60) -> DataFrame:
    """Each entry tilted so that its mean is mean + alpha * standard deviation, as far as its support allows."""
    entry = F.struct(F.col("c").cast("double").alias("c"), F.col("log_prob").alias("lp"))
    total = lambda e, f: F.aggregate(e, F.lit(0.0), lambda s, x: s + f(x))
    one = post.groupBy("m").agg(F.collect_list(entry).alias("e"), F.max("log_prob").alias("t"))
    mean = total(F.col("e"), lambda x: F.exp(x["lp"]) * x["c"]) / total(F.col("e"), lambda x: F.exp(x["lp"]))
    with_mean = one.withColumn("mean", mean)
    var = total(F.col("e"), lambda x: F.exp(x["lp"]) * (x["c"] - F.col("mean")) * (x["c"] - F.col("mean"))) / total(F.col("e"), lambda x: F.exp(x["lp"]))
    goal = with_mean.withColumn("goal", F.col("mean") + alpha * F.sqrt(var)).withColumn("peak", F.array_max(F.transform("e", lambda x: x["c"])))

    def low_enough(beta):
        z = lambda x: F.exp(x["lp"] - F.col("t") + beta * (x["c"] - F.when(beta > 0, F.col("peak")).otherwise(0.0)))
        return total(F.col("e"), lambda x: z(x) * x["c"]) <= F.col("goal") * total(F.col("e"), z)

    beta = goal.select("m", _bisect(F.lit(-span), F.lit(span), low_enough, rounds).alias("beta"))
    return tilted(post, beta)


#: Fractional bits of a tilt.
TILT_BITS = 30


def tilt_steps(post: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((m, c0), (m, key, jump)): the least count of each entry, and the steps of its most probable count as its tilt grows.

    Under the weight exp(beta c) the most probable count runs along the upper hull of log_prob over c, so it is a step function
    of beta: from a count it goes on to that later one which the steepest line leads to, at minus the line's slope. `key` is
    that tilt in units of 2**-TILT_BITS.
    """
    point = F.struct(F.col("c").cast("bigint").alias("c"), F.col("log_prob").alias("lp"))
    one = post.groupBy("m").agg(F.array_sort(F.collect_list(point)).alias("e"))
    # of lines of one slope the longest, so that points on a line give one step
    lines = F.transform(
        "e", lambda p, i: F.struct(p["c"].alias("c"), F.array_max(F.transform(F.slice("e", i + 2, F.size("e")), lambda q: F.struct(((q["lp"] - p["lp"]) / (q["c"] - p["c"])).alias("slope"), q["c"].alias("to")))).alias("line"))
    )
    none = F.array().cast("array<struct<slope:double,to:bigint,jump:bigint>>")
    start = F.struct(F.get("lines", F.lit(0))["c"].alias("at"), none.alias("out"))

    def walk(acc, p):
        step = F.struct(p["line"]["slope"].alias("slope"), p["line"]["to"].alias("to"), (p["line"]["to"] - p["c"]).alias("jump"))
        go = (p["c"] == acc["at"]) & p["line"].isNotNull()
        return F.when(go, F.struct(p["line"]["to"].alias("at"), F.concat(acc["out"], F.array(step)).alias("out"))).otherwise(acc)

    hull = one.select("m", lines.alias("lines")).select("m", F.get("lines", F.lit(0))["c"].alias("c0"), F.aggregate("lines", start, walk, lambda acc: acc["out"]).alias("out"))
    steps = hull.select("m", F.explode("out").alias("s")).select("m", F.round(-F.col("s.slope") * float(1 << TILT_BITS)).cast("bigint").alias("key"), "s.jump")
    return hull.select("m", "c0"), steps


def mean_tilts(post: DataFrame, genes: DataFrame, targets: DataFrame, span: float = 100.0, offsets: DataFrame | None = None) -> DataFrame:
    """(gene, beta): for each gene a tilt inside [-span, span] under which its most probable counts sum to the target, or to as
    much below it as steps at one tilt make necessary; genes without an entry have no row."""
    least, steps = tilt_steps(saved(post.select("m", "c", "log_prob")))
    base = _with_offsets(least.withColumnRenamed("c0", "noise"), offsets).join(genes, "m").groupBy("gene").agg(F.sum("noise").alias("base"))
    quota = saved(base.join(targets, "gene").select("gene", (F.floor("target").cast("bigint") - F.col("base")).alias("quota")))
    rows = saved(steps.join(genes, "m").groupBy("gene", "key").agg(F.sum("jump").alias("jump")))
    # a negative quota is passed by the first step already
    edge = boundaries(rows, quota, "gene", "key", F.col("jump"))
    ends = with_groups(rows, edge.select("gene", "edge"), "gene").where(F.col("key") < F.col("edge")).groupBy("gene").agg(F.max("key").alias("prev"))
    unit = float(1 << TILT_BITS)
    # between the last step that is taken and the first that is not
    middle = F.when(F.col("quota") < 0, -span).when(F.col("edge").isNull(), span).when(F.col("prev").isNull(), F.col("edge") / unit - 1.0).otherwise((F.col("prev") + F.col("edge")) / 2 / unit)
    return quota.join(edge, "gene", "left").join(ends, "gene", "left").select("gene", F.greatest(F.lit(-span), F.least(F.lit(span), middle)).alias("beta"))


def mean_regularised(post: DataFrame, genes: DataFrame, targets: DataFrame, per_gene: bool = True, span: float = 100.0, offsets: DataFrame | None = None) -> DataFrame:
    """One tilt for each gene (or one for all) so that the most probable counts sum to the target.

    The tilt comes from the steps of the most probable counts, by sums over digits, so the posterior is read twice whatever
    the precision.
    """
    one = genes if per_gene else genes.withColumn("gene", F.lit(0))
    goal = targets if per_gene else targets.agg(F.sum("target").alias("target")).select(F.lit(0).alias("gene"), "target")
    beta = mean_tilts(post, one, goal, span, offsets)
    tilt = with_groups(one, beta, "gene").select("m", "beta")
    out = post.join(tilt, "m").withColumn("log_prob", F.col("log_prob") + F.col("beta") * F.col("c"))
    return normalised(out.select("m", "c", "log_prob"))


def log_mean_exp(rows: DataFrame, keys: list[str], value: str, step: float = 256.0) -> DataFrame:
    """(keys, value): the logarithm of the mean of exp(value) over the rows of each key.

    The state is a sum for each scale exp(step * e), so that partial sums merge in any order, none of them overflows, and the
    rows of a key are never kept; the few scales of a key are joined under the largest.
    """
    scale = F.ceil(F.col(value) / step).cast("bigint")
    parts = rows.groupBy(*keys, scale.alias("_e")).agg(F.sum(F.exp(F.col(value) - step * scale)).alias("_s"), F.count("*").alias("_n"))
    one = parts.groupBy(*keys).agg(F.max("_e").alias("_top"), F.collect_list(F.struct("_e", "_s")).alias("_all"), F.sum("_n").alias("_n"))
    total = F.aggregate("_all", F.lit(0.0), lambda acc, x: acc + x["_s"] * F.exp(step * (x["_e"] - F.col("_top"))))
    return one.select(*keys, (step * F.col("_top") + F.ln(total) - F.ln("_n")).alias(value))


#: Logarithms of factorials that are looked up; larger ones come from the series.
FACTORIALS = 1 << 12
_LOG_FACTORIAL = np.array([math.lgamma(k + 1) for k in range(FACTORIALS)])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0, as stats.lgamma."""
    y = x + 8
    inv = 1 / y
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + inv / 12 - inv**3 / 360 + inv**5 / 1260 - inv**7 / 1680 + inv**9 / 1188
    product = x.copy()
    for k in range(1, 8):
        product *= x + k
    return series - np.log(product)


def _log_factorial(k: np.ndarray) -> np.ndarray:
    if k.dtype.kind == "i" and k.max(initial=0) < FACTORIALS:
        return _LOG_FACTORIAL[k]
    return _log_gamma(k + 1.0)


def _starts(column: pa.Array) -> np.ndarray:
    """Whether a row's value, which may be null, differs from that of the row before."""
    now, before = column[1:], column[:-1]
    same = pc.fill_null(pc.equal(now, before), False).to_numpy(zero_copy_only=False) | (now.is_null().to_numpy(zero_copy_only=False) & before.is_null().to_numpy(zero_copy_only=False))
    return np.concatenate(([True], ~same))


def _whole_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, sorted by their first column, in batches that cut none of its values' rows apart."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        begin = np.flatnonzero(_starts(b.column(0)))
        if held:
            last = held[-1].column(0)
            if not _starts(pa.concat_arrays([last.slice(len(last) - 1), b.column(0).slice(0, 1)]))[1]:
                if len(begin) == 1:
                    held.append(b)
                    continue
                held.append(b.slice(0, begin[1]))
                b, begin = b.slice(begin[1]), begin[1:] - begin[1]
            yield pa.concat_batches(held)
        if begin[-1]:
            yield b.slice(0, begin[-1])
        held = [b.slice(begin[-1])]
    if held:
        yield pa.concat_batches(held)


def _floats(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column, np.nan).to_numpy(zero_copy_only=False)


def _posterior(counts: int, least: float, samples: bool, shapes: bool):
    """Batches of (m, n, mean, rate[, shape][, sample]), all rows of an m in one, to (m, c, off, log_prob)."""

    def of(b: pa.RecordBatch) -> pa.RecordBatch:
        entry = np.cumsum(_starts(b.column(0))) - 1
        known = np.ones(b.num_rows, bool)
        for i in range(1, 5 if shapes else 4):
            known &= b.column(i).is_valid().to_numpy(zero_copy_only=False)
        n = b.column(1).fill_null(0).to_numpy(zero_copy_only=False)
        mean, rate = _floats(b.column(2)), _floats(b.column(3))
        middle = rate
        if samples:
            some = b.column(3).is_valid().to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore", divide="ignore"):
                middle = (np.bincount(entry, np.where(some, rate, 0.0)) / np.bincount(entry, some))[entry]
        # without a logarithm an entry has no probabilities
        known &= ~(mean <= 0) & ~(rate <= 0) & ~(n < 0)
        at = np.flatnonzero(known)
        shape = _floats(b.column(4)) if shapes else None
        if shapes:
            at = at[shape[at] > 0]
        sample = np.zeros(b.num_rows, np.int64)
        if samples:
            code = b.column(b.num_columns - 1).dictionary_encode()
            sample = pc.fill_null(code.indices, -1).to_numpy(zero_copy_only=False)
            at = at[np.lexsort((sample[at], entry[at]))]
        n, mean, rate, entry, sample = n[at], mean[at], rate[at], entry[at], sample[at]
        off = np.maximum(np.minimum(np.trunc(middle[at] - counts / 2), np.trunc(n - counts + 1)), 0).astype(np.int64)
        noise = off[:, None] + np.arange(counts)
        valid = noise <= n[:, None]
        rest = np.maximum(n[:, None] - noise, 0)
        prob = noise * np.log(rate)[:, None] - rate[:, None] - _log_factorial(noise)
        if shapes:
            s, mu = shape[at][:, None], mean[:, None]
            prob += _log_gamma(rest + s) - _log_gamma(s) - _log_factorial(rest) + s * np.log(s / (s + mu)) + rest * np.log(mu / (s + mu))
        else:
            prob += rest * np.log(mean)[:, None] - mean[:, None] - _log_factorial(rest)
        prob[~valid] = -np.inf
        if len(at):
            first = np.flatnonzero(np.concatenate(([True], (entry[1:] != entry[:-1]) | (sample[1:] != sample[:-1]))))
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
            top = np.maximum.reduceat(prob.max(axis=1), first)
            total = np.add.reduceat(np.exp(prob - top[group][:, None]).sum(axis=1), first)
            prob -= (top + np.log(total))[group][:, None]
        if samples and len(at):
            order = np.lexsort((off, entry))
            prob, valid, entry, off, at = prob[order], valid[order], entry[order], off[order], at[order]
            first = np.flatnonzero(np.concatenate(([True], (entry[1:] != entry[:-1]) | (off[1:] != off[:-1]))))
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
            top = np.maximum.reduceat(prob, first, axis=0)
            top[top == -np.inf] = 0.0
            rows = np.add.reduceat(valid.astype(np.int64), first, axis=0)
            with np.errstate(divide="ignore"):
                prob = top + np.log(np.add.reduceat(np.exp(prob - top[group]), first, axis=0)) - np.log(np.maximum(rows, 1))
            valid, off, at = rows > 0, off[first], at[first]
        row, c = np.nonzero(valid & ~(prob < least))
        return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at[row])), pa.array(c.astype(np.int32)), pa.array(off[row]).cast(pa.int32()), pa.array(prob[row, c])], names=["m", "c", "off", "log_prob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(of, _whole_entries(batches))

    return run


def posterior_from_latents(entries: DataFrame, counts: int = 20, least: float = -10.0, dealt: bool = False) -> DataFrame:
    """(m, c, log_prob) and offsets from entries (m, n, mean, rate[, shape][, sample]) of trained latents.

    Counts start at max(0, min(rate - counts / 2, n - counts + 1)); the offset is their start. Where an entry has several samples
    of its latents, each one's probabilities are normalised and then averaged, and the start comes from their mean rate.

    Entries, not their counts, are shuffled, so that those of one m meet (`dealt`: they are side by side in one partition
    already); their counts are a matrix inside the task.
    """
    names = entries.columns
    whole = dict(entries.dtypes)["n"] in ("tinyint", "smallint", "int", "bigint")
    number = [F.col(k).cast("double").alias(k) for k in ("mean", "rate", "shape") if k in names]
    rows = entries.select("m", F.col("n").cast("bigint" if whole else "double").alias("n"), *number, *[k for k in ("sample",) if k in names])
    if not dealt:
        rows = rows.repartition("m").sortWithinPartitions("m")
    return rows.mapInArrow(_posterior(counts, least, "sample" in names, "shape" in names), f"m {dict(entries.dtypes)['m']}, c int, off int, log_prob double")
