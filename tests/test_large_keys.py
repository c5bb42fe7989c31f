"""Queries on keys beyond those of the small tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from cytoframe.functions import stats
from cytoframe.plans import noise_queries, registry  # noqa: F401


@pytest.mark.parametrize("shift", [0, 99_990, 1_000_000, -40])
def test_index_of_many_genes(spark, tmp_path, small, shift):
    rows = spark.read.parquet(f"{small}/orders.parquet").withColumn("o_custkey", F.col("o_custkey") + shift)
    rows.write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.sql(f"create view orders as from '{tmp_path}/orders.parquet/*.parquet'")
    got, want = registry.QUERIES["index_round_trip"](spark, str(tmp_path)), con.sql(registry.SQL["index_round_trip"])
    assert got.columns == want.columns and [t for _, t in got.dtypes] == ["bigint"] * 5
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_index_is_exact_beyond_doubles(spark):
    cells = [(1 << 46) + 1, (1 << 46) + 3]
    df = spark.createDataFrame([(c, g) for c in cells for g in (0, 1, 99_999)], "cell bigint, gene bigint").withColumn("m", stats.flat_index(F.col("cell"), F.col("gene"), 100_000))
    assert all((r["cell"], r["gene"]) == (r["c"], r["g"]) for r in df.select("*", stats.cell_of(F.col("m"), 100_000).alias("c"), stats.gene_of(F.col("m"), 100_000).alias("g")).collect())
