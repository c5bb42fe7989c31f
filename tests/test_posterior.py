"""Posteriors of trained latents against sums by hand."""

import math
import random
from collections import defaultdict

import pyarrow as pa
import pytest

from cytoframe.operators import noise


def by_hand(rows, counts, least):
    """rows are (m, n, mean, rate, shape, sample)."""
    of = defaultdict(list)
    for r in rows:
        of[r[0]].append(r)
    out = []
    for m, own in of.items():
        rates = [r[3] for r in own if r[3] is not None]
        every = defaultdict(list)
        for m_, n, mean, rate, shape, sample in own:
            if None in (n, mean, rate) or mean <= 0 or rate <= 0:
                continue
            # without samples each entry keeps its own start
            first = max(min(int((rate if sample is None else sum(rates) / len(rates)) - counts / 2), int(n - counts + 1)), 0)
            for c in range(counts):
                k = first + c
                if k <= n:
                    r = n - k
                    lp = k * math.log(rate) - rate - math.lgamma(k + 1)
                    if shape is None:
                        lp += r * math.log(mean) - mean - math.lgamma(r + 1)
                    else:
                        lp += math.lgamma(r + shape) - math.lgamma(shape) - math.lgamma(r + 1) + shape * math.log(shape / (shape + mean)) + r * math.log(mean / (shape + mean))
                    every[sample].append((c, first, lp))
        found = []
        for sample, each in every.items():
            top = max(lp for *_, lp in each)
            z = top + math.log(sum(math.exp(lp - top) for *_, lp in each))
            found += [(c, off, lp - z) for c, off, lp in each]
        if own[0][5] is not None:
            groups = defaultdict(list)
            for c, off, lp in found:
                groups[c, off].append(lp)
            found = [(c, off, max(v) + math.log(sum(math.exp(x - max(v)) for x in v) / len(v))) for (c, off), v in groups.items()]
        out += [(m, c, off, lp) for c, off, lp in found if lp >= least]
    return sorted(out, key=lambda r: (str(r[0]), r[2], r[1], r[3]))


def cases(r, samples, shapes):
    rows = []
    for m in [*range(40), None, -3]:
        # some entries share an m
        for _ in range(r.choice((1, 1, 1, 2, 3))):
            n = r.choice((0, 1, 7, 30, 300, 9000))
            for s in r.sample(range(3), 3) if samples else [None]:
                rows.append((m, n, n * 0.8 + r.random(), n * 0.1 * (1 + (s or 0)) + r.random(), 2.5 + r.random() if shapes else None, s))
    if not samples:
        rows += [(900, None, 1.0, 1.0, 1.0 if shapes else None, None), (901, 3, 0.0, 1.0, 1.0 if shapes else None, None), (902, 3, 1.0, None, 1.0 if shapes else None, None), (3, 4, None, 1.0, 1.0 if shapes else None, None)]
    return rows


@pytest.mark.parametrize("samples,shapes,dealt", [(False, False, False), (False, True, False), (True, False, False), (True, True, False), (True, False, True)])
def test_by_hand(spark, samples, shapes, dealt):
    r = random.Random(3)
    rows = cases(r, samples, shapes)
    df = spark.createDataFrame(rows, "m bigint, n bigint, mean double, rate double, shape double, sample int").repartition(5)
    df = df.drop(*[c for c, here in (("sample", samples), ("shape", shapes)) if not here])
    if dealt:
        df = df.repartition("m").sortWithinPartitions("m")
    for counts, least in ((10, -10.0), (20, -60.0)):
        out = noise.posterior_from_latents(df, counts, least, dealt)
        assert dict(out.dtypes) == {"m": "bigint", "c": "int", "off": "int", "log_prob": "double"}
        got, want = sorted(map(tuple, out.collect()), key=lambda r: (str(r[0]), r[2], r[1], r[3])), by_hand(rows, counts, least)
        assert [r[:3] for r in got] == [r[:3] for r in want]
        assert all(abs(a[3] - b[3]) < 1e-7 for a, b in zip(got, want))


def test_no_count_is_shuffled(spark):
    """Entries are shuffled once; the table of all their counts, many times as large, never is."""
    df = spark.createDataFrame([(1, 2, 1.0, 1.0)], "m bigint, n bigint, mean double, rate double")
    plan = noise.posterior_from_latents(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" not in plan and "Window" not in plan


def test_entries_across_batches():
    rows = [0, 0, 1, 1, 1, 1, 1, 2, 3, 3, None, None, 4]
    for width in (1, 2, 3, 5, 20):
        whole = pa.record_batch([pa.array(rows), pa.array(range(len(rows)))], names=["m", "i"])
        got = [b.to_pydict() for b in noise._whole_entries(whole.slice(i, width) for i in range(0, len(rows), width))]
        assert [i for b in got for i in b["i"]] == list(range(len(rows)))
        seen = [set(b["m"]) for b in got]
        assert sum(map(len, seen)) == len(set().union(*seen)) == 6
    assert list(noise._whole_entries(iter([]))) == []
