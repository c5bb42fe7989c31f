"""Every registered query of the count operators against DuckDB on the whole small tables."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from cytoframe.plans import proxies as P
from cytoframe.plans import feature_queries, noise_queries, qc_queries, registry, sequence_queries  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as from '{small}/{t}.parquet'")
    return c


def norm(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def one(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return list(v) if isinstance(v, (list, tuple)) else v

    return sorted((tuple(one(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_against_sql(spark, small, con, name):
    got, want = registry.QUERIES[name](spark, small), con.sql(registry.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert norm(map(tuple, got.collect()), got.columns) == norm(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_rows_only(spark, small, name):
    assert registry.QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1500
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_matching_over_all_features(spark, small):
    """Reads against every row of part, by brute force."""
    import numpy as np

    letters = lambda texts: np.array([list(t) for t in texts])
    rows = sequence_queries.reads(spark, small).collect()
    dna = {r["k"]: r["s"] for r in spark.read.parquet(f"{small}/part.parquet").select(F.col("p_partkey").alias("k"), P.dna(F.col("p_partkey"), 10).alias("s")).collect()}
    first = {s: k for k, s in sorted(dna.items(), reverse=True)}
    names, reads = [f"F{k}" for k in first.values()], letters([r["read"] for r in rows])
    far = np.stack([(reads[:, None, p : p + 10] != letters(first)[None]).sum(axis=2) for p in range(15)], axis=2)

    def alone(dist, most):
        """(feature, distance) of each read, where one feature alone is nearest."""
        low = dist.min(axis=1)
        return {i: (int(dist[i].argmin()), int(low[i])) for i in np.flatnonzero((low <= most) & ((dist == low[:, None]).sum(axis=1) == 1))}

    shown = lambda found, place: {(rows[i]["read_id"], names[f], n, place(i, f)) for i, (f, n) in found.items()}
    scan = lambda i, f: int(far[i, f].argmin()) + 1
    got = lambda name: {(r["read_id"], r["feature"], r["distance"], r["place"]) for r in registry.QUERIES[name](spark, small).collect()}
    assert got("hamming_pairs_all") == shown(alone(far.min(axis=2), 2), scan)
    fixed, free = alone(far[:, :, 2], 3), alone(far.min(axis=2), 3)
    assert got("match_at_place_all") == shown(fixed, lambda i, f: 3)
    better = {i: v for i, v in free.items() if i not in fixed or v[1] < fixed[i][1]}
    assert got("match_reads_all") == shown(better, scan) | shown({i: v for i, v in fixed.items() if i not in better}, lambda i, f: 3)
    short: dict = {}
    for k, s in sorted(dna.items()):
        short.setdefault(s[:4], f"F{k}")
    want = {(r["read_id"], f) for r in rows for s, f in short.items() if s in r["read"]}
    assert {(r["read_id"], r["feature"]) for r in registry.QUERIES["contained_features_all"](spark, small).collect()} == want
