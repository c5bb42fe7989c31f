"""UMI graphs: connected UMIs of a cell count as one molecule, which a stringency rule gives to a feature."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.operators.components import components, saved

#: Edges of one cell that a task joins in memory; cells with more go through the distributed steps.
MOST_EDGES = 2_000_000


def umi_counts(reads: DataFrame) -> DataFrame:
    """(cell, umi, feature, n)."""
    return reads.groupBy("cell", "umi", "feature").agg(F.count("*").alias("n"))


def _roots(edges: list[tuple[str, str]]) -> dict[str, str]:
    """Smallest member of each node's component, by union-find with path halving."""
    up: dict[str, str] = {}

    def find(n: str) -> str:
        while (p := up.setdefault(n, n)) != n:
            up[n] = n = up[p]
        return n

    for u, v in edges:
        a, b = find(u), find(v)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: find(n) for n in up}


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, umi, root) from edges (cell, u, v) sorted by cell; one cell's edges are held at a time."""

    def made(cell, edges: list[tuple[str, str]], kind: pa.DataType) -> pa.RecordBatch:
        roots = _roots(edges)
        return pa.RecordBatch.from_arrays([pa.array([cell] * len(roots), kind), pa.array(list(roots), pa.string()), pa.array(list(roots.values()), pa.string())], names=["cell", "umi", "root"])

    held, edges, kind = None, [], None
    for b in batches:
        kind = b.schema.field(0).type
        for at in range(0, b.num_rows, 4096):
            part = b.slice(at, 4096).to_pydict()
            for c, u, v in zip(part["cell"], part["u"], part["v"]):
                if edges and c != held:
                    yield made(held, edges, kind)
                    edges = []
                held = c
                edges.append((u, v))
    if edges:
        yield made(held, edges, kind)


def umi_components(umis: DataFrame, most_edges: int = MOST_EDGES) -> DataFrame:
    """(cell, umi, root): UMIs of a cell linked at Hamming distance one; root is the component's smallest UMI.

    UMIs that agree but for one place meet under the text with that place masked, one row for each base; such a group
    holds as many UMIs as there are letters, and a star around its smallest one links them all. As components never cross cells, a task joins the edges of one cell at a time; cells with more than `most_edges` edges
    go through distributed steps to the smallest neighbour instead, with the same result.
    """
    keys = umis.select("cell", "umi").distinct()
    masked = F.transform(F.sequence(F.lit(1), F.length("umi")), lambda i: F.concat(F.substring("umi", F.lit(1), i - 1), F.lit("."), F.substring("umi", i + 1, F.length("umi"))))
    alike = keys.where("umi <> ''").select("cell", "umi", F.explode(masked).alias("mask")).groupBy("cell", "mask").agg(F.collect_set("umi").alias("us")).where(F.size("us") > 1)
    edges = saved(alike.select("cell", F.array_min("us").alias("u"), F.explode("us").alias("v")).where("u <> v"))
    kind = edges.schema["cell"].dataType.simpleString()
    big = saved(edges.groupBy("cell").count().where(F.col("count") > most_edges).select("cell"))
    any_big = big.limit(1).count() > 0
    small = edges.join(big, "cell", "left_anti") if any_big else edges
    linked = small.repartition("cell").sortWithinPartitions("cell").mapInArrow(_joined, f"cell {kind}, umi string, root string")
    if any_big:
        node = lambda c: F.struct(F.col("cell").alias("cell"), F.col(c).alias("umi"))
        found = components(edges.join(big, "cell", "left_semi").select(node("u").alias("u"), node("v").alias("v")))
        linked = linked.unionByName(found.select(F.col("node.cell").alias("cell"), F.col("node.umi").alias("umi"), F.col("root.umi").alias("root")))
    return keys.join(linked, ["cell", "umi"], "left").select("cell", "umi", F.coalesce("root", "umi").alias("root"))


def deduped_counts(umis: DataFrame, comps: DataFrame, stringency: int = 500, min_counts: int = 0) -> DataFrame:
    """(cell, feature, n): molecules by the stringency rule.

    0: each feature of a component above min_counts gets one; above 999: the only feature of a component whose total is
    above min_counts; between: the one largest feature where it exceeds total * stringency / 1000.
    """
    per = umis.join(comps, ["cell", "umi"]).groupBy("cell", "root", "feature").agg(F.sum("n").alias("n"))
    if stringency == 0:
        kept = per.where(F.col("n") > min_counts).select("cell", "feature")
    else:
        pair = F.struct(F.col("n"), F.col("feature"))
        one = per.groupBy("cell", "root").agg(F.max(pair).alias("top"), F.sum("n").alias("total"), F.count("*").alias("k"), F.collect_list("n").alias("ns"))
        ties = F.size(F.filter("ns", lambda v: v == F.col("top.n")))
        ok = F.col("k") == 1 if stringency > 999 else (ties == 1) & (F.col("top.n") > F.col("total") * F.lit(stringency / 1000.0))
        kept = one.where(ok & (F.col("total") > min_counts)).select("cell", F.col("top.feature").alias("feature"))
    return kept.groupBy("cell", "feature").agg(F.count("*").alias("n"))
