"""Spectral clusters against the dense graph in numpy, and averages of log probabilities."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from cytoframe.operators import clustering, noise


def rings(n=240, seed=1):
    """Two rings, one inside the other, and a blob: no clustering by distance to centres separates them."""
    r = np.random.default_rng(seed)
    turn = r.random(n) * 2 * np.pi
    radius = np.where(np.arange(n) % 3 == 0, 1.0, 4.0) + r.normal(0, 0.05, n)
    points = np.stack((radius * np.cos(turn), radius * np.sin(turn)), 1)
    blob = np.arange(n) % 3 == 2
    points[blob] = r.normal(0, 0.3, (int(blob.sum()), 2)) + [12, 0]
    return points, np.where(blob, 2, np.where(np.arange(n) % 3 == 0, 0, 1))


def same(a, b):
    return len({*zip(a, b)}) == len(set(a)) == len(set(b))


def test_rings_and_dense_graph(spark):
    points, truth = rings()
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)] + [(9999, None)], "id bigint, v array<double>").repartition(5)
    got = dict(clustering.spectral_clusters(df, "id", "v", 3, landmarks=120, nearest=4).collect())
    labels = [got[i] for i in range(len(points))]
    assert 9999 not in got and same(labels, truth.tolist()) and labels[0] == 0
    # the dense normalised graph has the same leading space
    rows = {r["id"]: r["spectral"] for r in clustering.spectral_embedding(df, "id", "v", 3, landmarks=120, nearest=4, gamma=2.0).collect()}
    chosen = [r["v"] for r in df.where("v is not null").orderBy(F.xxhash64("v"), "id").limit(120).collect()]
    at, w = clustering.affinities(points, np.unique(np.array(chosen), axis=0), 4, 2.0)
    z = np.zeros((len(points), len(chosen)))
    np.put_along_axis(z, at, w, 1)
    dense = z / np.where(z.sum(0) > 0, z.sum(0), np.inf) @ z.T
    assert np.allclose(dense.sum(1), 1)
    value, vector = np.linalg.eigh(dense)
    top = vector[:, np.argsort(-value)[:3]]
    own = np.array([rows[i] for i in range(len(points))])
    top /= np.linalg.norm(top, axis=1, keepdims=True)
    assert np.allclose(own @ own.T, top @ top.T, atol=1e-6)


def test_no_rows_and_few_rows(spark):
    none = spark.createDataFrame([], "id bigint, v array<float>")
    assert clustering.spectral_clusters(none, "id", "v", 3).count() == 0
    few = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [9.0, 9.0])], "id bigint, v array<float>")
    got = dict(clustering.spectral_clusters(few, "id", "v", 2).collect())
    assert got == {1: 0, 2: 0, 3: 1}


def test_log_mean_exp(spark):
    r = random.Random(3)
    rows = [(k, v) for k in range(20) for v in [r.uniform(-3000, 900) if k % 2 else r.uniform(-5, 5) for _ in range(r.randrange(1, 40))]]
    got = {x["k"]: x["v"] for x in noise.log_mean_exp(spark.createDataFrame(rows, "k int, v double").repartition(7), ["k"], "v").collect()}
    for k in range(20):
        own = [v for j, v in rows if j == k]
        top = max(own)
        assert abs(got[k] - (top + math.log(sum(math.exp(v - top) for v in own) / len(own)))) < 1e-9 * max(1, abs(top))
