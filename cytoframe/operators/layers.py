"""Layers of count matrices: addition, merging, alignment, subsets and concatenation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_layers(layers: DataFrame, value: str = "n") -> DataFrame:
    """X as the sum of its layers."""
    return layers.groupBy("cell", "gene").agg(F.sum(value).alias(value))


def layer_totals(layers: DataFrame, by: str = "gene", value: str = "n") -> DataFrame:
    return layers.groupBy("layer", by).agg(F.sum(value).alias("total"))


def add_aligned_layer(x: DataFrame, obs: DataFrame, var: DataFrame, new: DataFrame, name: str, value: str = "n") -> tuple[DataFrame, DataFrame]:
    """Entries of `new` at the cells and genes of the data set as a layer, and obs with is_<name> for cells it knows."""
    inside = new.join(obs.select("cell"), "cell", "left_semi").join(var.select("gene"), "gene", "left_semi")
    known = new.select("cell").distinct().withColumn("_hit", F.lit(True))
    flagged = obs.join(known, "cell", "left").select(*obs.columns, F.coalesce("_hit", F.lit(False)).alias(f"is_{name}"))
    return inside.select(F.lit(name).alias("layer"), "cell", "gene", value), flagged


def merge_outer(a: DataFrame, b: DataFrame, names: tuple[str, str], value: str = "n") -> DataFrame:
    """Entries of two matrices over the union of their cells and genes, each as its own layer."""
    tag = lambda df, n: df.select(F.lit(n).alias("layer"), "cell", "gene", value)
    return tag(a, names[0]).unionByName(tag(b, names[1]))


def merge_annotations(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Full outer union of rows and columns; where both know a column, the second's value wins."""
    both = a.alias("a").join(b.alias("b"), key, "full_outer")
    shared = [c for c in a.columns if c in b.columns and c != key]
    cols = [F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) for c in shared]
    cols += [F.col(f"a.{c}") for c in a.columns if c not in shared and c != key]
    cols += [F.col(f"b.{c}") for c in b.columns if c not in shared and c != key]
    return both.select(key, *cols)


def merge_left_genes(a: DataFrame, a_var: DataFrame, b: DataFrame, names: tuple[str, str], value: str = "n") -> DataFrame:
    """As merge_outer, with the genes of the first matrix only."""
    return merge_outer(a, b.join(a_var.select("gene"), "gene", "left_semi"), names, value)


def align_with_zeros(obs: DataFrame, table: DataFrame, columns: list[str], key: str = "cell") -> DataFrame:
    """The columns of `table` for every cell of obs, 0 where it has none."""
    return obs.join(table, key, "left").select(*obs.columns, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in columns])


def transfer_annotations(a: DataFrame, b: DataFrame, key: str, flag_a: str, flag_b: str) -> tuple[DataFrame, DataFrame]:
    """Each obs table with the other's columns (its own stay) and a flag for cells that the other knows."""

    def one(left: DataFrame, right: DataFrame, flag: str) -> DataFrame:
        fresh = [c for c in right.columns if c not in left.columns]
        marked = right.select(key, *fresh).withColumn("_hit", F.lit(True))
        return left.join(marked, key, "left").select(*left.columns, *fresh, F.coalesce("_hit", F.lit(False)).alias(flag))

    return one(a, b, flag_a), one(b, a, flag_b)


def common_subset(matrices: list[DataFrame]) -> list[DataFrame]:
    """Each matrix restricted to the cells and genes that all of them have."""
    cells, genes = (matrices[0].select(k).distinct() for k in ("cell", "gene"))
    for m in matrices[1:]:
        cells, genes = cells.join(m, "cell", "left_semi"), genes.join(m, "gene", "left_semi")
    return [m.join(cells, "cell", "left_semi").join(genes, "gene", "left_semi") for m in matrices]


def subset_cells(x: DataFrame, obs: DataFrame, mask: str | Column) -> DataFrame:
    """Entries of the cells that the mask keeps."""
    return x.join(obs.where(mask).select("cell"), "cell", "left_semi")


def zero_rows(x: DataFrame, cells: DataFrame) -> DataFrame:
    """Entries without those of the listed cells."""
    return x.join(cells.select("cell"), "cell", "left_anti")


def overwrite_columns(x: DataFrame, other: DataFrame, genes: DataFrame) -> DataFrame:
    """x with the columns of the listed genes taken from another matrix."""
    pick = genes.select("gene")
    return x.join(pick, "gene", "left_anti").unionByName(other.join(pick, "gene", "left_semi").select(*x.columns))


def concat_samples(parts: dict[str, DataFrame], method: str | None = None) -> DataFrame:
    """Union of data sets, cells suffixed _<sample>; columns that a part lacks are null."""
    out = None
    for sample, df in parts.items():
        one = suffixed(df.withColumn("sample", F.lit(sample)))
        if method:
            one = one.withColumn("method", F.lit(method))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def suffixed(x: DataFrame, cell: str = "cell", sample: str = "sample") -> DataFrame:
    return x.withColumn(cell, F.concat_ws("_", F.col(cell).cast("string"), F.col(sample)))


def compare_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, rows): rows that only one of two tables has, repeats counted."""
    one = lambda l, r, s: l.exceptAll(r.select(*l.columns)).groupBy().agg(F.count("*").alias("n_rows")).select(F.lit(s).alias("side"), "n_rows")  # noqa: E731, E741
    return one(a, b, "left").unionByName(one(b, a, "right"))


def dense_fill(table: DataFrame, key: str, positions: int, fill: float, value: str = "log_prob") -> DataFrame:
    """Every key with every position 0..positions-1; `fill` where the table has no entry."""
    grid = table.select(key).distinct().withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(positions - 1))))
    return grid.join(table, [key, "c"], "left").select(key, "c", F.coalesce(F.col(value), F.lit(fill)).alias(value))


def sparse_rows(dense: DataFrame, key: str, array: str, value: str = "n") -> DataFrame:
    """(key, c, value): the non-zero elements of an array column."""
    return dense.select(key, F.posexplode(array).alias("c", value)).where(F.col(value) != 0)
