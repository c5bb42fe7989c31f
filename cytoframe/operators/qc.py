"""Cell quality control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def membership_flag(obs: DataFrame, listed: DataFrame, name: str, key: str = "cell", present: int = 1) -> DataFrame:
    """Add an int column: `present` for keys in the list, 1 - present for others."""
    hit = listed.select(key).distinct().withColumn("_hit", F.lit(True))
    return obs.join(hit, key, "left").select(*obs.columns, F.when(F.col("_hit"), present).otherwise(1 - present).alias(name))


def cell_metrics(x: DataFrame, obs: DataFrame, mt_genes: DataFrame, value: str = "n") -> DataFrame:
    """Add n_genes, total_counts, mt_counts and mt_pct to obs; cells without counts get zeros."""
    marked = x.join(mt_genes.select("gene").distinct().withColumn("_mt", F.lit(True)), "gene", "left")
    v = F.col(value)
    per = marked.groupBy("cell").agg(
        F.count_if(v > 0).alias("n_genes"), F.sum(v).alias("total_counts"), F.sum(F.when(F.col("_mt"), v).otherwise(0)).alias("mt_counts")
    )
    out = obs.join(per, "cell", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    filled = out.select(*obs.columns, zero("n_genes"), zero("total_counts"), zero("mt_counts"))
    return filled.withColumn("mt_pct", F.when(F.col("total_counts") == 0, 0.0).otherwise(100.0 * F.col("mt_counts") / F.nullif(F.col("total_counts"), F.lit(0))))


def with_singlets(obs: DataFrame) -> DataFrame:
    return obs.withColumn("singlet", (F.col("non_empty") == 1) & (F.col("doublet") == 0))


def adaptive_max(metrics: DataFrame, mask: str = "singlet", column: str = "n_genes", n_mad: float = 3) -> DataFrame:
    """One row: median, unscaled MAD and the truncated median + n_mad * MAD of the masked cells.

    Both medians come from counts of distinct values, so the single last task sees as many rows as there are values.
    """
    counts = metrics.where(F.col(mask)).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("w"))
    med = F.expr("percentile(v, 0.5, w)")
    with_med = counts.crossJoin(F.broadcast(counts.agg(med.alias("median"))))
    return with_med.agg(F.first("median").alias("median"), F.expr("percentile(abs(v - median), 0.5, w)").alias("mad")).select(
        "median", "mad", F.floor(F.col("median") + n_mad * F.col("mad")).cast("int").alias("max_genes")
    )


def qc_filter(metrics: DataFrame, min_genes: int | Column, max_genes: int | Column, mt_pct: float, name: str = "filter") -> DataFrame:
    """Add the filter column; all bounds are inclusive."""
    ok = (F.col("n_genes") >= min_genes) & (F.col("n_genes") <= max_genes) & (F.col("mt_pct") <= mt_pct)
    return metrics.withColumn(name, ok)


def qc_filter_adaptive(metrics: DataFrame, min_genes: int, mt_pct: float, n_mad: float = 3) -> DataFrame:
    """qc_filter whose upper bound is the adaptive one, and singlet_filtered."""
    bound = adaptive_max(metrics, n_mad=n_mad).select("max_genes")
    return qc_filter(metrics.crossJoin(F.broadcast(bound)), min_genes, F.col("max_genes"), mt_pct).drop("max_genes").withColumn("singlet_filtered", F.col("singlet") & F.col("filter"))


def filter_stats(filtered: DataFrame) -> DataFrame:
    return filtered.agg(
        F.sum("non_empty").cast("bigint").alias("num_non_empty"), F.count_if("singlet").alias("num_singlets"), F.count_if("filter").alias("num_filtered"), F.count_if("singlet_filtered").alias("num_singlet_filtered")
    )


def gene_histogram(metrics: DataFrame, bins: int = 20, close_last_bin: bool = False) -> DataFrame:
    """(bin, lo, hi, n_cells, mean_mt_pct) over [0, max n_genes].

    Counts close the last bin on the right. The mean leaves out the cells at the maximum unless close_last_bin is set;
    an empty bin has mean 0.
    """
    top = metrics.agg(F.max("n_genes").alias("top"))
    at = F.when(F.col("top") == 0, 0).otherwise(F.least(F.floor(F.col("n_genes") * bins / F.nullif("top", F.lit(0))), F.lit(bins - 1)))
    placed = metrics.crossJoin(F.broadcast(top)).withColumn("bin", at.cast("int"))
    inner = (F.col("n_genes") < F.col("top")) | F.lit(close_last_bin)
    per = placed.groupBy("bin").agg(F.count("*").alias("n_cells"), F.avg(F.when(inner, F.col("mt_pct"))).alias("mean_mt_pct"))
    grid = top.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "top")
    out = grid.join(per, "bin", "left")
    edge = lambda k: (F.col("top") * (F.col("bin") + k) / bins)
    return out.select("bin", edge(0).alias("lo"), edge(1).alias("hi"), F.coalesce("n_cells", F.lit(0)).alias("n_cells"), F.coalesce("mean_mt_pct", F.lit(0.0)).alias("mean_mt_pct"))


def numeric_histograms(table: DataFrame, columns: list[str], bins: int = 20, positive_only: bool = False, start_at_zero: bool = True) -> DataFrame:
    """(col_name, bin, n): right-closed bins of each numeric column, the lowest value included in the first.

    The range begins at 0 where no value is negative (if start_at_zero), else at the minimum.
    """
    stack = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    long = table.selectExpr(f"stack({len(columns)}, {stack}) as (col_name, v)").where("v is not null")
    if positive_only:
        long = long.where("v > 0")
    ends = long.groupBy("col_name").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    if start_at_zero:
        ends = ends.withColumn("lo", F.when(F.col("lo") >= 0, 0.0).otherwise(F.col("lo")))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.greatest(F.least(F.ceil((F.col("v") - F.col("lo")) / F.nullif(width, F.lit(0.0))) - 1, F.lit(bins - 1)), F.lit(0)))
    return long.join(F.broadcast(ends), "col_name").groupBy("col_name", at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def split_by_name(var: DataFrame, name: str, mark: str) -> DataFrame:
    """Add is_gene: names that hold the mark; all true where none does."""
    hit = F.col(name).contains(mark)
    flag = var.agg(F.max(hit.cast("int")).alias("any"))
    return var.crossJoin(F.broadcast(flag)).select(*var.columns, (hit | (F.coalesce("any", F.lit(0)) == 0)).alias("is_gene"))
