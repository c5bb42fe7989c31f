"""Labels of cells: lookups, priorities and categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(obs: DataFrame, table: DataFrame, value: str, key: str | list[str] = "cell", default: object = None) -> DataFrame:
    """Add a value by key; `default` (null unless given) where the table has none. The table's keys are unique."""
    keys = [key] if isinstance(key, str) else key
    got = obs.join(table.select(*keys, value), keys, "left")
    return got if default is None else got.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def last_wins(table: DataFrame, key: str, value: str, order: str | Column) -> DataFrame:
    return table.groupBy(key).agg(F.max_by(value, order).alias(value))


def first_wins(table: DataFrame, key: str, value: str, order: str | Column) -> DataFrame:
    return table.groupBy(key).agg(F.min_by(value, order).alias(value))


def categorical(obs: DataFrame, mapping: DataFrame, categories: DataFrame, name: str) -> DataFrame:
    """Add the label of each cell, null where it has none or the label is no declared category."""
    known = mapping.join(categories.select(F.col("name").alias("label")).distinct(), "label", "left_semi")
    return obs.join(known.select("cell", F.col("label").alias(name)), "cell", "left")


#: Lists in rising priority: a later one overwrites an earlier one.
TABLE_ORDER = ("ambiguous", "doublet", "missing_cells", "unassignable")
CATEGORY_ORDER = ("missing", "low_support", "ambiguous", "doublets")


def _ranked(lists: dict[str, DataFrame], order: tuple[str, ...]) -> DataFrame:
    """(cell, value): of the lists that hold a cell, the one of highest priority."""
    out = None
    for rank, name in enumerate(order):
        if name in lists:
            one = lists[name].select("cell", F.lit(rank).alias("rank"), F.lit(name).alias("value"))
            out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no list given")
    return out.groupBy("cell").agg(F.max_by("value", "rank").alias("value"))


def priority_table(lists: dict[str, DataFrame], assigned: DataFrame) -> DataFrame:
    """(cell, value): listed cells under their list, all others under their assignment."""
    special = _ranked(lists, TABLE_ORDER)
    return special.unionByName(assigned.join(special, "cell", "left_anti").select("cell", "value"))


def priority_category(obs: DataFrame, lists: dict[str, DataFrame], assigned: DataFrame, name: str = "category", rest: str = "filtered") -> DataFrame:
    """Add a category: the special list of highest priority, else the assigned sample, else `rest`."""
    special = _ranked(lists, CATEGORY_ORDER).withColumnRenamed("value", "_s")
    joined = obs.join(special, "cell", "left").join(assigned.select("cell", F.col("value").alias("_a")), "cell", "left")
    return joined.select(*obs.columns, F.coalesce("_s", "_a", F.lit(rest)).alias(name))


def category_order(categories: DataFrame, name: str = "category", rest: str = "filtered") -> DataFrame:
    """(category, pos): sample names sorted, then the special ones in fixed order."""
    special = [*CATEGORY_ORDER, rest]
    rank = F.lit(-1)
    for i, s in enumerate(special):
        rank = F.when(F.col(name) == s, i).otherwise(rank)
    from pyspark.sql import Window

    return categories.select(name).distinct().withColumn("_r", rank).withColumn("pos", F.row_number().over(Window.orderBy("_r", name)) - 1).drop("_r")


def by_position(assigned: DataFrame, names: DataFrame) -> DataFrame:
    """(cell, value): 1-based indices replaced by names, fallback to the index as text."""
    joined = assigned.join(names.select(F.col("pos").alias("idx"), "name"), "idx", "left")
    return joined.select("cell", F.coalesce("name", F.col("idx").cast("string")).alias("value"))


def sample_names(assigned: DataFrame, names: DataFrame) -> DataFrame:
    """(cell, value): feature barcodes replaced by sample names, the barcode itself where it has none."""
    joined = assigned.join(names.select(F.col("barcode").alias("value"), "sample"), "value", "left")
    return joined.select("cell", F.coalesce("sample", "value").alias("value"))


def categories_of(barcodes: DataFrame, number: str, prefix: str = "BC") -> DataFrame:
    """(name): the fixed categories, then one for each distinct barcode number of a table."""
    own = barcodes.where(F.col(number).isNotNull()).select(F.concat(F.lit(prefix), F.col(number).cast("string")).alias("name")).distinct()
    fixed = barcodes.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in TABLE_ORDER])).alias("name"))
    return fixed.unionByName(own)


def generated_categories(spark, count: int = 245979, prefix: str = "BC") -> DataFrame:
    """(name): the fixed categories, then prefix1..prefix<count>."""
    fixed = spark.createDataFrame([(n,) for n in TABLE_ORDER], "name string")
    return fixed.unionByName(spark.range(1, count + 1).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("name")))
