"""Profiles of tables and matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(table: DataFrame, column: str, top: int = 10) -> DataFrame:
    """(value, n): the most frequent values, ties by value, and '(other)' for the rest."""
    per = table.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    first = per.orderBy(F.col("n").desc(), "value").limit(top)
    # what is not among the first is a difference of two sums, so nothing else is ranked
    rest = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all")).crossJoin(first.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("top")))
    return first.select("value", "n").unionByName(rest.select(F.lit("(other)").alias("value"), (F.col("all") - F.col("top")).alias("n")).where("n > 0"))


def sparsity(x: DataFrame, obs: DataFrame, var: DataFrame) -> DataFrame:
    """One row: non-zeros, cells, genes and the share of zeros."""
    row = x.agg(F.count("*").alias("nnz")).crossJoin(obs.agg(F.count("*").alias("n_cells"))).crossJoin(var.agg(F.count("*").alias("n_genes")))
    size = F.col("n_cells").cast("double") * F.col("n_genes")
    return row.withColumn("sparsity", F.when(size == 0, 0.0).otherwise(1 - F.col("nnz") / F.nullif(size, F.lit(0.0))))


def layer_ranges(layers: DataFrame, value: str = "n") -> DataFrame:
    """(layer, n_values, least, most, n_distinct) of stored entries."""
    return layers.groupBy("layer").agg(F.count("*").alias("n_values"), F.min(value).alias("least"), F.max(value).alias("most"), F.count_distinct(value).alias("n_distinct"))


def column_profile(table: DataFrame, columns: list[str]) -> DataFrame:
    """(col_name, n_rows, nulls, n_distinct, least, most, whole, kind) in one pass: numeric columns with a semantic kind."""
    parts = []
    for c in columns:
        v = F.col(c)
        num = v.cast("double")
        parts.append(F.struct(F.lit(c).alias("col_name"), F.count("*").alias("n_rows"), F.count_if(v.isNull()).alias("nulls"), F.count_distinct(v).alias("n_distinct"), F.min(num).alias("least"), F.max(num).alias("most"), F.coalesce(F.bool_and(num == F.floor(num)), F.lit(True)).alias("whole")))
    rows = table.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")
    kinds = {c: t in ("double", "float") for c, t in table.dtypes}
    real = F.col("col_name").isin(*[c for c in columns if kinds[c]])
    return rows.withColumn("kind", numeric_kind(real))


def numeric_kind(real: Column, least: Column | None = None, most: Column | None = None, whole: Column | None = None) -> Column:
    """Semantic type of a numeric column from its range and distinct count; `real` says whether it is stored as floating point."""
    lo, hi = (F.col("least") if least is None else least), (F.col("most") if most is None else most)
    whole = F.col("whole") if whole is None else whole
    zero_one = (F.col("n_distinct") == 2) & (lo == 0) & (hi == 1)
    return (
        F.when(F.col("n_rows") == F.col("nulls"), "all missing")
        .when(zero_one, "binary (0/1)")
        .when(~real & (F.col("n_distinct") == 2), "binary")
        .when(~real & (lo >= 0) & (hi <= 1), "indicator integers")
        .when(~real & (lo >= 0), "count data")
        .when(~real, "signed integers")
        .when((lo >= 0) & (hi <= 1), "normalized/probability values")
        .when((lo >= 0) & whole, "float-stored integers")
        .when(lo >= 0, "positive continuous values")
        .when((lo > -20) & (hi < 20), "continuous values (possibly log-transformed)")
        .otherwise("continuous values")
    )


#: Values of each column that decide on its kind.
SAMPLE = 1000


def sampled_profile(table: DataFrame, key: list[str] | None = None, sample: int = SAMPLE, seed: int = 0) -> DataFrame:
    """(col_name, stored, n_rows, nulls, least, most, n_sampled, n_distinct, kind, examples) of every column of a table.

    Kinds come from a sample of each column, its values in the rows of the least hashes among those where it is not null: the
    first 13 hexadecimal digits of the md5 of the seed and the key columns (or of a hash of all columns). Every column is
    sampled by the one aggregate that also counts it: rows whose hash is below a threshold, which the number of rows sets so
    that about four samples pass, and of those the least. A column that is null too often for that is sampled again without it.
    """
    names = list(table.columns)
    who = F.concat_ws(":", F.lit(str(seed)), *[F.col(f"`{c}`").cast("string") for c in key]) if key else F.concat_ws(":", F.lit(str(seed)), F.xxhash64(*[F.col(f"`{c}`") for c in names]).cast("string"))
    spaces = 1 << 52
    rows = table.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.conv(F.substring(F.md5(who), 1, 13), 16, 10).cast("bigint").alias("_h"))
    n = table.count()
    out = None
    for limit in (min(spaces, int(4 * (sample + 16) / max(n, 1) * spaces)), spaces):
        todo = list(range(len(names))) if out is None else [i for i, r in enumerate(out) if r["n_sampled"] < min(sample, r["n_rows"] - r["nulls"])]
        if not todo:
            break
        parts = []
        for i in todo:
            v = F.col(f"c{i}")
            number = v.cast("double") if _numeric(table, names[i]) else F.lit(None).cast("double")
            text = v.cast("string") if _plain(table, names[i]) else F.to_json(F.array(v))
            low = F.slice(F.array_sort(F.collect_list(F.when(v.isNotNull() & (F.col("_h") < limit), F.struct(F.col("_h").alias("h"), text.alias("v"))))), 1, sample)
            parts.append(F.struct(F.lit(i).alias("i"), F.count("*").alias("n_rows"), F.count_if(v.isNull()).alias("nulls"), F.min(number).alias("least"), F.max(number).alias("most"), F.transform(low, lambda x: x["v"]).alias("s")))
        row = rows.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*", F.size("p.s").alias("n_sampled"))
        got = {r["i"]: r for r in row.collect()}
        out = [got.get(i) or out[i] for i in range(len(names))]
    # one row for each column, with a bounded sample
    spark = table.sparkSession
    data = [(names[i], dict(table.dtypes)[names[i]], r["n_rows"], r["nulls"], r["least"], r["most"], r["n_sampled"], r["s"]) for i, r in enumerate(out)]
    told = spark.createDataFrame(data, "col_name string, stored string, n_rows bigint, nulls bigint, least double, most double, n_sampled int, s array<string>").withColumn("n_distinct", F.size(F.array_distinct("s")).cast("bigint"))
    numbers = F.col("stored").isin("tinyint", "smallint", "int", "bigint", "float", "double") | F.col("stored").startswith("decimal")
    real = F.col("stored").isin("float", "double") | F.col("stored").startswith("decimal")
    seen = F.transform("s", lambda v: v.cast("double"))
    # the decision sees the sample, as if it were the column
    of_sample = told.select("*", F.when(numbers, F.array_min(seen)).alias("_lo"), F.when(numbers, F.array_max(seen)).alias("_hi"), F.when(numbers, F.forall(seen, lambda v: v == F.floor(v))).alias("_whole"))
    number_kind = numeric_kind(real, F.col("_lo"), F.col("_hi"), F.col("_whole"))
    kind = F.when(F.col("n_rows") == F.col("nulls"), "all missing").when(F.col("stored") == "boolean", "binary").when(numbers, number_kind).when(F.col("n_distinct") < 0.5 * F.col("n_sampled"), "categorical").otherwise("text")
    return of_sample.select("col_name", "stored", "n_rows", "nulls", "least", "most", "n_sampled", "n_distinct", kind.alias("kind"), F.slice("s", 1, 5).alias("examples"))


def _numeric(table: DataFrame, column: str) -> bool:
    return dict(table.dtypes)[column].split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _plain(table: DataFrame, column: str) -> bool:
    return not dict(table.dtypes)[column].startswith(("array", "map", "struct", "binary"))


def profile_bundle(data, sample: int = SAMPLE, seed: int = 0) -> DataFrame:
    """(part, col_name, stored, n_rows, nulls, least, most, n_sampled, n_distinct, kind, examples): one call for a whole data set.

    Parts are obs and var with their columns, x and every layer with their values, and `matrix` with its share of zeros as
    `most` of the row `sparsity`.
    """
    out = None
    add = lambda part, df: df.select(F.lit(part).alias("part"), "*")
    value = [c for c in data.x.columns if c not in ("cell", "gene")]
    tables = [("obs", data.obs, ["cell"]), ("var", data.var, ["gene"]), ("x", data.x.select(*value, "cell", "gene"), ["cell", "gene"])]
    if data.layers is not None:
        tables += [(f"layer {r['layer']}", data.layers.where(F.col("layer") == r["layer"]).drop("layer"), ["cell", "gene"]) for r in data.layers.select("layer").distinct().orderBy("layer").collect()]
    for part, df, key in tables:
        one = add(part, sampled_profile(df, key, sample, seed))
        one = one if part in ("obs", "var") else one.where(~F.col("col_name").isin("cell", "gene"))
        out = one if out is None else out.unionByName(one)
    share = sparsity(data.x, data.obs, data.var)
    none = F.lit(None)
    total = share.select(
        F.lit("matrix").alias("part"), F.lit("sparsity").alias("col_name"), F.lit("double").alias("stored"), (F.col("n_cells") * F.col("n_genes")).alias("n_rows"), (F.col("n_cells") * F.col("n_genes") - F.col("nnz")).alias("nulls"),
        F.lit(0.0).alias("least"), F.col("sparsity").alias("most"), F.lit(0).alias("n_sampled"), F.lit(0).cast("bigint").alias("n_distinct"), none.cast("string").alias("kind"), none.cast("array<string>").alias("examples"),
    )
    return out.unionByName(total)


def text_kind(table: DataFrame, column: str) -> DataFrame:
    """One row: categorical where fewer than half of the values are distinct."""
    row = table.agg(F.count_distinct(column).alias("n_distinct"), F.count("*").alias("n_rows"))
    return row.select(F.lit(column).alias("col_name"), "n_distinct", F.when(F.col("n_distinct") < 0.5 * F.col("n_rows"), "categorical").otherwise("text").alias("kind"))


def slot_of(length: int, n_cells: int, n_genes: int, depth: int = 1) -> str:
    """Where a loaded array belongs by its length: cells before genes; matrices go to obsm or varm."""
    if length == n_cells:
        return "obs" if depth == 1 else "obsm"
    if length == n_genes:
        return "var" if depth == 1 else "varm"
    return "uns"
