"""A reference of labelled cells from the data sets of many samples."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.functions.names import is_label
from cytoframe.operators.metrics import lognorm_10k
from cytoframe.sources.matrix import Bundle, read_bundle

Part = tuple[str, str, Bundle]


def find_parts(spark: SparkSession, root: str, name: str) -> list[Part]:
    """(sample, method, data set) of every bundle root/<sample>/<method>/<name>, by name."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/*/{name}")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    out = []
    for at in sorted(f.getPath().toString() for f in found if f.isDirectory()):
        *_, sample, method, _ = at.split("/")
        out.append((sample, method, read_bundle(spark, at)))
    return out


def labelled_cells(part: Bundle, label: str) -> DataFrame:
    """obs of the cells that are singlets and passed the filter (where that is known) and have a label (where there are labels)."""
    obs = part.obs
    if "singlet_filtered" in obs.columns:
        obs = obs.where(F.coalesce(F.col("singlet_filtered").cast("boolean"), F.lit(False)))
    return obs.where(is_label(F.col(label))) if label in obs.columns else obs


def build_reference(parts: list[Part], label: str = "celltype", value: str = "n") -> Bundle:
    """One data set of the labelled cells of all samples: counts as log1p of ten thousand a cell, genes of any of them.

    Cells are named <cell>_<sample>, or <cell>_<sample>_<method> where a sample has several methods, so that names stay apart.
    Annotations that a part lacks are null; a gene's annotation stays where all parts that have one agree.
    """
    if not parts:
        raise ValueError("no data set to build a reference from")
    times = Counter(sample for sample, _, _ in parts)
    obs = genes = x = None
    for sample, method, part in parts:
        suffix = sample if times[sample] == 1 else f"{sample}_{method}"
        cells = labelled_cells(part, label)
        renamed = lambda df, suffix=suffix: df.withColumn("cell", F.concat_ws("_", F.col("cell").cast("string"), F.lit(suffix)))
        counts = part.x.join(cells.select("cell"), "cell", "left_semi").select("cell", "gene", F.col(value).alias("n"))
        one = renamed(cells).withColumn("sample", F.lit(sample)).withColumn("method", F.lit(method))
        values = renamed(lognorm_10k(counts))
        obs = one if obs is None else obs.unionByName(one, allowMissingColumns=True)
        genes = part.var if genes is None else genes.unionByName(part.var, allowMissingColumns=True)
        x = values if x is None else x.unionByName(values)
    notes = [c for c in genes.columns if c != "gene"]
    agreed = [F.when(F.min(c).eqNullSafe(F.max(c)), F.min(c)).alias(c) for c in notes]
    var = genes.groupBy("gene").agg(*agreed) if notes else genes.select("gene").distinct()
    return Bundle(obs, var, x)


def cells_by_label(reference: Bundle, label: str = "celltype") -> DataFrame:
    """(label, n), the most frequent first."""
    return reference.obs.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "label")


def write_reference(reference: Bundle, path: str) -> str:
    """Commit the reference's tables to a store, all at once; returns the version."""
    from cytoframe.sinks.committed import commit

    return commit(reference.x.sparkSession, path, {"obs": reference.obs, "var": reference.var, "x": reference.x})


def read_reference(spark: SparkSession, path: str) -> Bundle:
    from cytoframe.sinks.committed import read_committed

    return Bundle(*[read_committed(spark, path, n) for n in ("obs", "var", "x")])
