"""Writers. Row order is given by sorts, so equal input gives equal files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.operators.ranking import global_row_number
from cytoframe.sources.matrix import Bundle


def write_bundle(data: Bundle, path: str, mask: str | None = None) -> None:
    """Parquet tables obs, var, x and layers; with a mask only the cells it keeps."""
    obs = data.obs if mask is None else data.obs.where(mask)
    keep = lambda df: df if mask is None else df.join(obs.select("cell"), "cell", "left_semi")
    obs.write.parquet(f"{path}/obs")
    data.var.write.parquet(f"{path}/var")
    keep(data.x).write.parquet(f"{path}/x")
    if data.layers is not None:
        keep(data.layers).write.partitionBy("layer").parquet(f"{path}/layers")


def write_barcodes(obs: DataFrame, path: str, mask: str | None = None, cell: str = "cell") -> None:
    """One barcode to a line, no header."""
    rows = obs if mask is None else obs.where(mask)
    rows.select(F.col(cell).cast("string").alias("value")).orderBy("value").write.text(path)


def dense_index(x: DataFrame, key: str) -> DataFrame:
    """(key, idx): 1-based positions of the keys that have entries, in order."""
    return global_row_number(x.select(key).distinct(), [key], "idx")


def mtx_entries(counts: DataFrame, row: str = "gene", col: str = "cell", value: str = "n") -> DataFrame:
    """(row_idx, col_idx, n) of a coordinate file; keys without entries have no index."""
    rows, cols = dense_index(counts, row).withColumnRenamed("idx", "row_idx"), dense_index(counts, col).withColumnRenamed("idx", "col_idx")
    return counts.join(rows, row).join(cols, col).select("row_idx", "col_idx", F.col(value).alias("n"))


def write_mtx(counts: DataFrame, path: str, row: str = "gene", col: str = "cell", value: str = "n") -> None:
    """matrix (header, dimensions, entries), barcodes and features as folders of text."""
    entries = mtx_entries(counts, row, col, value)
    dims = entries.agg(F.coalesce(F.max("row_idx"), F.lit(0)).alias("r"), F.coalesce(F.max("col_idx"), F.lit(0)).alias("c"), F.count("*").alias("k"))
    head = dims.select(F.explode(F.array(F.struct(F.lit(-2).alias("o"), F.lit("%%MatrixMarket matrix coordinate integer general").alias("value")), F.struct(F.lit(-1).alias("o"), F.concat_ws(" ", "r", "c", "k").alias("value")))).alias("h")).select(F.col("h.o").cast("bigint").alias("o"), F.lit(0).cast("bigint").alias("p"), "h.value")
    body = entries.select(F.col("col_idx").cast("bigint").alias("o"), F.col("row_idx").cast("bigint").alias("p"), F.concat_ws(" ", "row_idx", "col_idx", "n").alias("value"))
    head.unionByName(body).orderBy("o", "p").select("value").write.text(f"{path}/matrix.mtx")
    dense_index(counts, col).orderBy("idx").select(F.col(col).cast("string").alias("value")).write.text(f"{path}/barcodes.txt")
    dense_index(counts, row).orderBy("idx").select(F.col(row).cast("string").alias("value")).write.text(f"{path}/features.txt")


def write_stats(stats: DataFrame, path: str) -> None:
    """One 'name value' line for each column of a one-row table."""
    stack = ", ".join(f"'{c}', cast(`{c}` as string)" for c in stats.columns)
    stats.selectExpr(f"stack({len(stats.columns)}, {stack}) as (k, v)").select(F.concat_ws(" ", "k", "v").alias("value")).coalesce(1).write.text(path)


def stats_lines(stats: DataFrame) -> DataFrame:
    """(line, value): the six lines of a run's statistics file, from one row (total_counts, deduped_counts, distinct_keys, cells,
    unmatched, cells_with_feature); shares of nothing are 0.00."""
    pct = lambda a, b: F.format_string("%.2f", F.when(b == 0, 0.0).otherwise(100.0 * a / F.nullif(b.cast("double"), F.lit(0.0))))
    c = {n: F.col(n) for n in ("total_counts", "deduped_counts", "distinct_keys", "cells", "unmatched", "cells_with_feature")}
    # fixed wording of the file
    lines = [
        ("Total feature counts", c["total_counts"].cast("string")),
        ("Total deduped feature counts", c["deduped_counts"].cast("string")),
        ("Total unique barcode UMIs", c["distinct_keys"].cast("string")),
        ("Total whitelisted barcodes", c["cells"].cast("string")),
        ("Percentage features assigned to barcode", pct(c["total_counts"] - c["unmatched"], c["total_counts"])),
        ("Percentage barcodes assigned feature", pct(c["cells_with_feature"], c["cells"])),
    ]
    rows = F.array(*[F.struct(F.lit(i).alias("line"), F.concat_ws(" ", F.lit(k), v).alias("value")) for i, (k, v) in enumerate(lines)])
    return stats.select(F.explode(rows).alias("x")).select("x.line", "x.value")


def write_stats_lines(stats: DataFrame, path: str) -> None:
    """The six lines as one text file."""
    stats_lines(stats).coalesce(1).sortWithinPartitions("line").select("value").write.text(path)


def write_table(table: DataFrame, path: str, order: list[str], sep: str = "\t", header: bool = True) -> None:
    table.orderBy(*order).write.csv(path, sep=sep, header=header)


def coexpression_lines(pairs: DataFrame, features: list[str]) -> DataFrame:
    """The co-expression totals as a matrix: one row for each feature_i, one column for each of the given features and one for none."""
    cells = F.coalesce("feature_j", F.lit("none"))
    return pairs.withColumn("_j", cells).groupBy("feature_i").pivot("_j", ["none", *features]).agg(F.sum("total")).na.fill(0).orderBy("feature_i")
