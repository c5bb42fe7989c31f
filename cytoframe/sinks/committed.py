"""A store of several tables that changes all at once: readers see the old set or the new one, never half of either.

Every write goes to a folder of its own. When all its tables stand, a manifest that names the folder takes the place of the
one before by a single rename. A job that fails on its way leaves a folder that no manifest names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cytoframe.operators.metrics import removal_metrics
from cytoframe.operators.noise import denoised

MANIFEST = "manifest.json"


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and rename it over what is there."""
    jvm = spark._jvm
    beside, files = _hadoop(spark, f"{path}.{uuid.uuid4().hex}")
    out = files.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    place, _ = _hadoop(spark, path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(files.makeQualified(beside), files.makeQualified(place), options)


def manifest(spark: SparkSession, path: str) -> dict | None:
    """What the store at this path holds now: its version and, for each table, the format; None before the first commit."""
    place, files = _hadoop(spark, f"{path}/{MANIFEST}")
    if not files.exists(place):
        return None
    return json.loads("\n".join(r["value"] for r in spark.read.text(f"{path}/{MANIFEST}").collect()))


def commit(spark: SparkSession, path: str, tables: dict[str, DataFrame], formats: dict[str, str] | None = None) -> str:
    """Write tables (as Parquet, or CSV with a header where formats says 'csv') and make them the store's content. Returns the version."""
    formats = formats or {}
    version = uuid.uuid4().hex
    for name, table in tables.items():
        to = f"{path}/{version}/{name}"
        if formats.get(name) == "csv":
            table.write.csv(to, header=True)
        else:
            table.write.parquet(to)
    schemas = {name: {"format": formats.get(name, "parquet"), "schema": table.schema.jsonValue()} for name, table in tables.items()}
    _put(spark, f"{path}/{MANIFEST}", json.dumps({"version": version, "tables": schemas}))
    return version


def read_committed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of the last version that was committed whole."""
    now = manifest(spark, path)
    if now is None or name not in now["tables"]:
        raise FileNotFoundError(f"{path} holds no committed table {name}")
    at, kind = f"{path}/{now['version']}/{name}", now["tables"][name]
    if kind["format"] == "csv":
        return spark.read.schema(StructType.fromJson(kind["schema"])).csv(at, header=True)
    return spark.read.parquet(at)


def write_denoised(raw: DataFrame, noise: DataFrame, probability: DataFrame, path: str, cutoff: float = 0.5, expected_cells: int | None = None, fpr: float | None = None) -> str:
    """Commit the outcome of noise removal: denoised counts, those of cells alone, the cells' names in order, and the metrics.

    raw has cell, gene and n; noise has cell, gene and noise; probability has cell and p. A cell is a droplet above the cutoff;
    droplets that are no cell are zero in the output.
    """
    spark = raw.sparkSession
    cells = called_cells(probability, cutoff)
    full = denoised(raw, noise, cells)
    metrics = removal_metrics(raw, full, cells, expected_cells=expected_cells, fpr=fpr)
    long = metrics.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in metrics.columns])).alias("x")).select("x.*")
    tables = {"denoised": full, "probability": probability, "filtered": full.join(cells, "cell", "left_semi"), "metrics": long.coalesce(1), "cell_barcodes": cells.select(F.col("cell").cast("string").alias("barcode")).orderBy("barcode")}
    return commit(spark, path, tables, {"metrics": "csv", "cell_barcodes": "csv"})


def called_cells(probability: DataFrame, cutoff: float = 0.5, inclusive: bool = False) -> DataFrame:
    """(cell): droplets whose probability is above the cutoff; the metrics of a run also count those at it."""
    return probability.where(F.col("p") >= cutoff if inclusive else F.col("p") > cutoff).select("cell")
