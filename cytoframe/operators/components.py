"""Connected components of an edge table by repeated steps to the smallest neighbour."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def saved(df: DataFrame) -> DataFrame:
    """A reliable copy in the session's checkpoint folder (a temporary one where none is set in local mode, as in tests)."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        known = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not known and sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(known or tempfile.mkdtemp(prefix="cytoframe-"))
    return df.checkpoint()


#: A node with more edges than both is a hub; a table of E edges has at most HUBS of them.
HUB_EDGES, HUBS = 256, 1024


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of all nodes with an edge (columns u, v): root is the component's smallest node.

    Edges are replaced by edges to the smallest neighbour, once for larger and once for smaller neighbours, until a round
    changes nothing; the table never outgrows its first size. A hub's edges stay where they are: its smallest neighbour is a
    minimum that combines before it shuffles, and comes to them by broadcast (HUBS rows at most). A loop makes its node a
    component; null ends are ignored.
    """
    flat = edges.select("u", "v").where("u is not null and v is not null")
    alone = flat.where("u = v").select("u").distinct()
    cur = saved(flat.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(cur)
    for _ in range(rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = _with_least(both, 2 * mark[0]).withColumn("m", F.least("m", "u"))
        large = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _with_least(large, mark[0]).select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        cur = saved(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct())
        before, mark = mark, _mark(cur)
        if mark == before:
            break
    else:
        raise RuntimeError("the components did not settle")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    linked = cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
    lone = alone.withColumnRenamed("u", "node").join(linked.select("node"), "node", "left_anti").select("node", F.col("node").alias("root"))
    return linked.unionByName(lone)


def _with_least(rows: DataFrame, most: int) -> DataFrame:
    """rows (u, v) with m, the least v among the rows of one u; `most` bounds the number of rows."""
    low = rows.groupBy(F.col("u").alias("_k")).agg(F.min("v").alias("m"), F.count("*").alias("_n"))
    full = max(HUB_EDGES, most // HUBS)
    split = rows.join(F.broadcast(low.where(F.col("_n") > full).select("_k", "m")), F.col("u") == F.col("_k"), "left").drop("_k")
    rest = split.where("m is null").drop("m").join(low.where(F.col("_n") <= full).select("_k", "m"), F.col("u") == F.col("_k")).drop("_k")
    return split.where("m is not null").unionByName(rest)


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
