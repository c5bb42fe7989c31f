"""Spectral clustering of an array column over a landmark graph.

Rows are joined to their nearest landmarks (a bounded sample of rows, by hash) with Gaussian weights that sum to one, so two rows
are as alike as the landmarks that they share: the affinity is A = Z D^-1 Z', with D the weights that landmarks receive, and
all rows have degree one. The leading eigenvectors of the normalised graph are then those of H'H, H = Z D^-1/2, one small matrix
that is summed over all rows; a row's coordinates are H v / sigma. Two passes over the rows, no pairs of rows, and k-means on
the coordinates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.operators.components import saved

LANDMARKS, NEAREST = 256, 5


def affinities(points: np.ndarray, landmarks: np.ndarray, nearest: int, gamma: float) -> tuple[np.ndarray, np.ndarray]:
    """(landmark indices, weights) of each point's nearest landmarks; weights sum to one."""
    far = np.maximum((points**2).sum(1)[:, None] + (landmarks**2).sum(1)[None] - 2 * points @ landmarks.T, 0)
    at = np.argsort(far, axis=1, kind="stable")[:, :nearest]
    own = np.take_along_axis(far, at, 1)
    # relative to the nearest one, so that a point far from all of them has weights too
    w = np.exp(-gamma * (own - own[:, :1]))
    return at, w / w.sum(1, keepdims=True)


def _points(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for i in range(0, b.num_rows, 4096):
            part = b.slice(i, 4096)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(float)
            if len(flat) != part.num_rows * width:
                raise ValueError("arrays of one length are needed")
            yield part, flat.reshape(-1, width)


def spectral_embedding(table: DataFrame, key: str, array: str, k: int, landmarks: int = LANDMARKS, nearest: int = NEAREST, gamma: float | None = None) -> DataFrame:
    """(key, spectral): the coordinates of each row on the k leading eigenvectors, at unit length; rows without an array are left out.

    gamma defaults to one over the mean squared distance of a landmark to its nearest ones.
    """
    rows = table.where(F.col(array).isNotNull()).select(F.col(key).alias("key"), F.col(array).cast("array<double>").alias("v"))
    # bounded: `landmarks` rows
    chosen = np.array([r["v"] for r in rows.orderBy(F.xxhash64("v"), "key").limit(landmarks).collect()], float)
    if not len(chosen):
        return table.select(key, F.col(array).cast("array<double>").alias("spectral")).limit(0)
    chosen = np.unique(chosen, axis=0)
    nearest, width = min(nearest, len(chosen)), chosen.shape[1]
    if gamma is None:
        far = np.sort(((chosen[:, None] - chosen[None]) ** 2).sum(2), axis=1)[:, 1 : nearest + 1]
        gamma = 1.0 / max(float(far.mean()) if far.size else 1.0, 1e-300)
    m = len(chosen)

    def summed(batches):
        gram = np.zeros((m, m))
        for _, points in _points(batches, width):
            at, w = affinities(points, chosen, nearest, gamma)
            z = np.zeros((len(points), m))
            np.put_along_axis(z, at, w, 1)
            gram += z.T @ z
        i, j = np.nonzero(gram)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(gram[i, j])], names=["i", "j", "g"])

    gram = np.zeros((m, m))
    # bounded: the square of the number of landmarks
    for r in rows.mapInArrow(summed, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        gram[r["i"], r["j"]] = r["g"]
    # a row's weights sum to one, so what a landmark receives is the sum of its line
    scale = 1 / np.sqrt(np.where(gram.sum(1) > 0, gram.sum(1), np.inf))
    value, vector = np.linalg.eigh(gram * scale[:, None] * scale[None])
    lead = np.argsort(-value, kind="stable")[:k]
    lead = lead[value[lead] > 1e-9]
    basis = scale[:, None] * vector[:, lead] / np.sqrt(value[lead])
    kind = dict(table.dtypes)[key]

    def placed(batches):
        for part, points in _points(batches, width):
            at, w = affinities(points, chosen, nearest, gamma)
            u = (basis[at] * w[:, :, None]).sum(1)
            u /= np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-300)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.FixedSizeListArray.from_arrays(pa.array(u.ravel()), u.shape[1]).cast(pa.list_(pa.float64()))], names=["key", "spectral"])

    return rows.mapInArrow(placed, f"key {kind}, spectral array<double>").withColumnRenamed("key", key)


def spectral_clusters(table: DataFrame, key: str, array: str, k: int, seed: int = 0, **options) -> DataFrame:
    """(key, cluster): clusters 0 to k - 1, numbered by their least key."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    at = saved(spectral_embedding(table, key, array, k, **options).orderBy(key)).withColumn("_v", array_to_vector("spectral"))
    if not at.limit(1).count():
        return at.select(key, F.lit(0).alias("cluster"))
    found = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="_c", maxIter=50, tol=1e-9).fit(at).transform(at).select(key, "_c")
    # one row for each cluster
    order = [r["_c"] for r in found.groupBy("_c").agg(F.min(key).alias("first")).orderBy("first").collect()]
    number = F.create_map(*[F.lit(x) for i, c in enumerate(order) for x in (c, i)])
    return found.select(key, F.element_at(number, F.col("_c")).alias("cluster"))
