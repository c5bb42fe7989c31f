"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.common import checkpoint

#: A node with more edges than both is a hub; a table of E edges has at most HUBS of them.
HUB_EDGES, HUBS = 256, 1024


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node that has an edge; root is the component's smallest node.

    Every round replaces edges by edges to the smallest neighbour, so a hub's edges are never paired among
    themselves: the table never outgrows its first size. Rounds stop when nothing changes; the number of rounds
    grows with the logarithm of the longest path. A hub's edges are not brought together either: its smallest neighbour
    is a minimum with partial aggregation and comes to the edges by broadcast (`HUBS` rows at most), while all other nodes
    have few edges and are joined by shuffle. An empty edge table gives an empty result; loops and nulls are ignored,
    repeated edges count once.
    """
    flat = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    cur = checkpoint(flat.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(cur)
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = with_least(both, "u", "v", "m", 2 * mark[0]).withColumn("m", F.least("m", "u"))
        large = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = with_least(large, "u", "v", "m", mark[0]).select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        nxt = checkpoint(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct())
        seen = _mark(nxt)
        cur, done = nxt, seen == mark
        mark = seen
        if done:
            break
    else:
        raise RuntimeError("the components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def with_least(rows: DataFrame, key: str, value: str, least: str, most: int) -> DataFrame:
    """rows with the column `least`: the least value among the rows of the same key, neither of them null. `most` bounds the number of rows.

    Rows of a key that has very many stay where they are; its least value comes to them by broadcast.
    """
    low = rows.groupBy(F.col(key).alias("__k")).agg(F.min(value).alias("__m"), F.count("*").alias("__n"))
    full = max(HUB_EDGES, most // HUBS)
    # bounded: HUBS keys at most have more than most / HUBS rows
    split = rows.join(F.broadcast(low.where(F.col("__n") > full).select("__k", "__m")), F.col(key) == F.col("__k"), "left").drop("__k")
    rest = split.where("__m is null").drop("__m").join(low.where(F.col("__n") <= full).select("__k", "__m"), F.col(key) == F.col("__k")).drop("__k")
    return split.where("__m is not null").unionByName(rest).withColumnRenamed("__m", least)


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
