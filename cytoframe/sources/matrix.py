"""Matrix Market triples and the directory layouts that hold them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.functions.names import strip_version
from cytoframe.operators.layers import sum_layers
from cytoframe.sources.text import _exists, barcode_list, numbered_lines


@dataclass
class Bundle:
    """A data set: cells, genes, the main matrix and named layers, zeros absent."""

    obs: DataFrame
    var: DataFrame
    x: DataFrame
    layers: DataFrame | None = None


def matrix_market(spark: SparkSession, path: str, cells_first: bool = False) -> tuple[DataFrame, tuple[int, int, int]]:
    """Entries (cell_pos, gene_pos, value), 1-based, and the dimension line (rows, columns, entries); comments are skipped."""
    lines = numbered_lines(spark, path).withColumn("value", F.trim("value")).where((F.col("value") != "") & ~F.col("value").startswith("%"))
    top = lines.agg(F.min(F.struct("line", "value"))).first()[0]
    if top is None:
        raise ValueError(f"{path} has no dimension line")
    dims = tuple(int(v) for v in top["value"].split())
    if len(dims) != 3:
        raise ValueError(f"{path} begins with {top['value']!r}, not with three numbers")
    parts = F.split("value", r"\s+")
    row, col = parts[0].cast("bigint"), parts[1].cast("bigint")
    cell, gene = (row, col) if cells_first else (col, row)
    body = lines.where(F.col("line") > top["line"])
    return body.select(cell.alias("cell_pos"), gene.alias("gene_pos"), parts[2].cast("double").alias("value")), dims


def names_by_position(spark: SparkSession, path: str, column: int = 0, sep: str = r"\t", header: bool = False) -> DataFrame:
    """(pos, name), 1-based: one field of each line."""
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    first = 1 if header else 0
    field = F.split("value", sep)
    name = F.coalesce(F.try_element_at(field, F.lit(column + 1)), F.element_at(field, 1))
    return lines.where(F.col("line") >= first).select((F.col("line") + 1 - first).alias("pos"), F.trim(name).alias("name"))


def read_triple(spark: SparkSession, matrix: str, barcodes: str, genes: str, cells_first: bool = False, gene_column: int = 0, gene_sep: str = r"\t", gene_header: bool = False, check: bool = True) -> Bundle:
    """obs(cell), var(gene), x(cell, gene, value) of one matrix with its names; dimensions must agree with the names."""
    entries, dims = matrix_market(spark, matrix, cells_first)
    obs = names_by_position(spark, barcodes)
    var = names_by_position(spark, genes, gene_column, gene_sep, gene_header)
    if check:
        want = dims[:2] if cells_first else (dims[1], dims[0])
        have = (obs.count(), var.count())
        if want != have:
            raise ValueError(f"{matrix} says {want} cells and genes, the name files hold {have}")
    x = entries.join(obs.select(F.col("pos").alias("cell_pos"), F.col("name").alias("cell")), "cell_pos").join(var.select(F.col("pos").alias("gene_pos"), F.col("name").alias("gene")), "gene_pos")
    return Bundle(obs.select(F.col("name").alias("cell")), var.select(F.col("name").alias("gene")), x.select("cell", "gene", "value").where("value <> 0"))


def find_file(spark: SparkSession, folder: str, *names: str) -> str:
    """The first of the names, plain or gzipped, that the folder holds."""
    for n in names:
        for p in (f"{folder}/{n}", f"{folder}/{n}.gz"):
            if _exists(spark, p):
                return p
    raise FileNotFoundError(f"none of {names} in {folder}")


def layout_of(spark: SparkSession, folder: str) -> str | None:
    """flex, kallisto, fry, solo or cellranger by the sub-folder present, in that order; None for others."""
    for kind, sub in (("flex", "demux"), ("kallisto", "counts_unfiltered"), ("fry", "af_quant"), ("solo", "Solo.out"), ("cellranger", "outs")):
        if _exists(spark, f"{folder}/{sub}"):
            return kind
    return None


def _tenx(spark: SparkSession, folder: str) -> Bundle:
    return read_triple(spark, find_file(spark, folder, "matrix.mtx"), find_file(spark, folder, "barcodes.tsv", "barcodes.txt"), find_file(spark, folder, "features.tsv", "genes.tsv"))


def flagged(obs: DataFrame, called: DataFrame, name: str = "is_cell") -> DataFrame:
    hit = called.select(F.col("barcode").alias("cell"), F.lit(True).alias("_hit")).distinct()
    return obs.join(hit, "cell", "left").select(*obs.columns, F.coalesce("_hit", F.lit(False)).alias(name))


def read_cellranger(spark: SparkSession, folder: str) -> Bundle:
    raw = _tenx(spark, f"{folder}/outs/raw_feature_bc_matrix")
    called = barcode_list(spark, find_file(spark, f"{folder}/outs/filtered_feature_bc_matrix", "barcodes.tsv"), missing_ok=False)
    return Bundle(flagged(raw.obs, called), raw.var, raw.x)


def _named_layers(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, x in parts.items():
        one = x.select(F.lit(name).alias("layer"), "cell", "gene", "value")
        out = one if out is None else out.unionByName(one)
    return out


def read_kallisto(spark: SparkSession, folder: str) -> Bundle:
    """Four matrices over the same cells and genes, cells first; total is X, gene versions are dropped."""
    at = f"{folder}/counts_unfiltered"
    one = lambda kind: read_triple(spark, find_file(spark, at, f"cells_x_genes.{kind}.mtx"), find_file(spark, at, "cells_x_genes.barcodes.txt"), find_file(spark, at, "cells_x_genes.genes.txt"), cells_first=True)
    parts = {k: one(v) for k, v in (("total", "total"), ("unspliced", "nascent"), ("spliced", "mature"), ("ambiguous", "ambiguous"))}
    bare = lambda df: df.withColumn("gene", strip_version(F.col("gene")))
    layers = _named_layers({k: bare(b.x) for k, b in parts.items() if k != "total"})
    return Bundle(parts["total"].obs, bare(parts["total"].var), bare(parts["total"].x), layers)


def read_fry(spark: SparkSession, folder: str, layers: dict[str, str] | None = None) -> Bundle:
    """Genes come as name-S, name-U, name-A blocks; each is a layer and X is their sum."""
    at = f"{folder}/af_quant/alevin"
    all_ = read_triple(spark, find_file(spark, at, "quants_mat.mtx"), find_file(spark, at, "quants_mat_rows.txt"), find_file(spark, at, "quants_mat_cols.txt"), cells_first=True)
    kinds = layers or {"U": "unspliced", "A": "ambiguous", "S": "spliced"}
    tag = F.regexp_extract("gene", r"-([USA])$", 1)
    name = F.lit("spliced")
    for k, v in kinds.items():
        name = F.when(tag == k, v).otherwise(name)
    tagged = all_.x.select(name.alias("layer"), "cell", F.regexp_replace("gene", r"-[USA]$", "").alias("gene"), "value")
    return Bundle(all_.obs, all_.var.select(F.regexp_replace("gene", r"-[USA]$", "").alias("gene")).distinct(), sum_layers(tagged, "value"), tagged)


def read_solo(spark: SparkSession, folder: str) -> Bundle:
    """GeneFull raw matrix with the cell call, Velocyto matrices as layers."""
    at = f"{folder}/Solo.out"
    raw = _tenx(spark, f"{at}/GeneFull/raw")
    called = barcode_list(spark, find_file(spark, f"{at}/GeneFull/filtered", "barcodes.tsv"), missing_ok=False)
    velo = f"{at}/Velocyto/raw"
    parts = {k: read_triple(spark, find_file(spark, velo, f"{k}.mtx"), find_file(spark, velo, "barcodes.tsv"), find_file(spark, velo, "features.tsv")).x for k in ("spliced", "unspliced", "ambiguous")}
    return Bundle(flagged(raw.obs, called), raw.var, raw.x, _named_layers(parts))


def read_flex(spark: SparkSession, folder: str) -> dict[str, Bundle]:
    return {k: _tenx(spark, f"{folder}/{k}") for k in ("gex", "demux")}


def read_features(spark: SparkSession, folder: str) -> Bundle:
    """A feature matrix whose names are the first column of a space-separated file with a header."""
    return read_triple(spark, find_file(spark, folder, "matrix.mtx", "features_matrix.mtx"), find_file(spark, folder, "barcodes.txt", "barcodes.tsv"), find_file(spark, folder, "features.txt"), gene_sep=r"\s+", gene_header=True)


READERS = {"kallisto": read_kallisto, "fry": read_fry, "solo": read_solo, "cellranger": read_cellranger}


def read_any(spark: SparkSession, folder: str) -> Bundle:
    """The data set of a folder by its layout; of a flex folder the gene expression."""
    kind = layout_of(spark, folder)
    if kind is None:
        raise ValueError(f"{folder} has no known layout")
    return read_flex(spark, folder)["gex"] if kind == "flex" else READERS[kind](spark, folder)


def read_bundle(spark: SparkSession, path: str) -> Bundle:
    """The native store: Parquet tables obs, var, x and layers."""
    get = lambda n: spark.read.parquet(f"{path}/{n}")
    return Bundle(get("obs"), get("var"), get("x"), get("layers") if _exists(spark, f"{path}/layers") else None)
