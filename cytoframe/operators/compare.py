"""Comparison of tables and of whole data sets, repeats counted and order left aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.sources.matrix import Bundle

#: Buckets of rows by hash; only those whose sums differ are compared row by row.
BUCKETS = 4096


def _shown(df: DataFrame, columns: list[str], digits: int | None) -> list[Column]:
    """Columns in the form in which they are compared; numbers of any type as doubles or whole numbers, doubles rounded if asked."""
    out = []
    for c, t in df.select(*columns).dtypes:
        v = F.col(f"`{c}`")
        if t in ("tinyint", "smallint", "int", "bigint"):
            v = v.cast("bigint")
        elif t in ("float", "double") or t.startswith("decimal"):
            v = v.cast("double") + F.lit(0.0)
            v = v if digits is None else F.round(v, digits)
        elif t.startswith("map"):
            v = F.array_sort(F.map_entries(v))
        out.append(v.alias(c))
    return out


def bucket_sums(df: DataFrame, columns: list[str], digits: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, low, high): of each bucket of rows the number and two sums of halves of their hashes, which do not depend on order."""
    h = F.xxhash64(*_shown(df, columns, digits)) if columns else F.lit(0).cast("bigint")
    rows = df.select(h.alias("h"))
    return rows.groupBy(F.pmod("h", F.lit(buckets)).cast("int").alias("bucket")).agg(F.count("*").alias("n"), F.sum(F.col("h").bitwiseAND(F.lit((1 << 32) - 1))).alias("low"), F.sum(F.shiftright("h", 32)).alias("high"))


def differing_rows(a: DataFrame, b: DataFrame, columns: list[str] | None = None, digits: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(columns, only_left, only_right): rows that one table has more often than the other, and how much more often.

    Each table is read once to sum hashes by bucket, and again for the buckets that differ; equal tables are never shuffled.
    """
    columns = [c for c in a.columns if c in b.columns] if columns is None else columns
    left, right = bucket_sums(a, columns, digits, buckets), bucket_sums(b, columns, digits, buckets)
    both = left.join(right.select("bucket", *[F.col(c).alias(f"{c}_r") for c in ("n", "low", "high")]), "bucket", "full_outer")
    # bounded: one number for each bucket
    apart = [r["bucket"] for r in both.where(~F.struct("n", "low", "high").eqNullSafe(F.struct("n_r", "low_r", "high_r"))).select("bucket").collect()]

    def picked(df: DataFrame, side: int) -> DataFrame:
        shown = df.select(*_shown(df, columns, digits))
        h = F.xxhash64(*[F.col(f"`{c}`") for c in columns]) if columns else F.lit(0).cast("bigint")
        return shown.where(F.pmod(h, F.lit(buckets)).isin(apart)).withColumn("_side", F.lit(side))

    rows = picked(a, 1).unionByName(picked(b, -1))
    net = rows.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum("_side").alias("_net")).where("_net <> 0")
    return net.select(*[F.col(f"`{c}`") for c in columns], F.greatest("_net", F.lit(0)).cast("bigint").alias("only_left"), F.greatest(-F.col("_net"), F.lit(0)).cast("bigint").alias("only_right"))


def _part(name: str, a: DataFrame | None, b: DataFrame | None, digits: int | None) -> DataFrame:
    some = a if a is not None else b
    spark = some.sparkSession
    own = lambda df: df.columns if df is not None else []
    lacks = lambda x, y: ",".join(sorted(c for c in own(x) if c not in own(y)))
    n = lambda df: df.agg(F.count("*").alias("n")) if df is not None else spark.range(1).select(F.lit(0).cast("bigint").alias("n"))
    shared = [c for c in own(a) if c in own(b)]
    if shared:
        apart = differing_rows(a, b, shared, digits).agg(F.coalesce(F.sum("only_left"), F.lit(0)).alias("only_left"), F.coalesce(F.sum("only_right"), F.lit(0)).alias("only_right"))
        row = n(a).withColumnRenamed("n", "n_left").crossJoin(n(b).withColumnRenamed("n", "n_right")).crossJoin(apart)
    else:
        row = n(a).withColumnRenamed("n", "n_left").crossJoin(n(b).withColumnRenamed("n", "n_right")).select("n_left", "n_right", F.col("n_left").alias("only_left"), F.col("n_right").alias("only_right"))
    out = row.select(F.lit(name).alias("part"), "n_left", "n_right", "only_left", "only_right", F.lit(lacks(a, b)).alias("columns_left"), F.lit(lacks(b, a)).alias("columns_right"))
    return out.withColumn("same", (F.col("only_left") == 0) & (F.col("only_right") == 0) & (F.col("columns_left") == "") & (F.col("columns_right") == ""))


def compare_bundles(a: Bundle, b: Bundle, digits: int | None = None) -> DataFrame:
    """(part, n_left, n_right, only_left, only_right, columns_left, columns_right, same): obs, var, x and layers of two data sets.

    Rows are compared on the columns that both have; columns of one side alone are named. A part that one side lacks counts as
    empty; layers are compared together, each row with its layer's name.
    """
    out = None
    for name in ("obs", "var", "x", "layers"):
        one, two = getattr(a, name), getattr(b, name)
        if one is None and two is None:
            continue
        row = _part(name, one, two, digits)
        out = row if out is None else out.unionByName(row)
    return out
