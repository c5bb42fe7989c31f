"""Global positions without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.operators.components import saved

#: Rows that one window of a running minimum covers.
BLOCK = 100_000


def global_row_number(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """Add 1-based positions in a total order.

    A range-partitioned sort is saved, so that its partitions stand; rows are numbered inside them and shifted by the
    counts before, a table with one row for each partition.
    """
    ordered = saved(df.orderBy(*order).withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}))
    parts = ordered.groupBy("_p").agg(F.count("*").alias("n"), F.min("_i").alias("least"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = parts.select("_p", (before - F.col("least") + 1).alias("_shift"))
    return ordered.join(F.broadcast(shift), "_p").select(*df.columns, (F.col("_i") + F.col("_shift")).alias(name))


def running_minimum_from_end(df: DataFrame, position: str, value: str, name: str, block: int = BLOCK) -> DataFrame:
    """Add the least value at this position or a later one: inside blocks of positions, then over the blocks' minima."""
    at = df.withColumn("_b", F.floor(F.col(position) / block))
    inner = F.min(value).over(Window.partitionBy("_b").orderBy(F.col(position).desc()).rowsBetween(Window.unboundedPreceding, 0))
    least = at.groupBy("_b").agg(F.min(value).alias("_m"))
    later = least.select("_b", F.min("_m").over(Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)).alias("_later"))
    return at.withColumn("_in", inner).join(later, "_b").select(*df.columns, F.least("_in", "_later").alias(name))


#: Rows of a table with one row for each group that go to every task at most.
SMALL = 1 << 19


def with_groups(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """rows joined to a table of one narrow row for each group: by broadcast if the groups are few, by shuffle otherwise."""
    return rows.join(F.broadcast(groups) if groups.limit(SMALL + 1).count() <= SMALL else groups, key)


def boundaries(rows: DataFrame, quotas: DataFrame, group: str, key: str, weight: Column, shifts: tuple[int, ...] = (24, 12, 0)) -> DataFrame:
    """(group, edge, before): the least key (a bigint) of each group up to which the weights sum to more than the group's quota,
    and the sum of the weights of lesser keys. A group whose weights do not exceed its quota has no row.

    Selection by digits: each round sums the weights by group and leading digits, which combines before it shuffles, and goes
    on inside the one bin where the quota is passed; no group's rows are brought together. quotas has (group, quota), and
    weights are not negative.
    """
    state = saved(quotas.select(group, "quota", F.lit(0).cast("bigint").alias("before"), F.lit(None).cast("bigint").alias("bin")))
    last = None
    for shift in shifts:
        digits = F.shiftright(key, shift)
        own = with_groups(rows.select(group, F.col(key).alias("_k"), weight.alias("_w")).withColumnRenamed("_k", key), state, group)
        inside = own if last is None else own.where(F.shiftright(key, last) == F.col("bin"))
        sums = inside.groupBy(group, digits.alias("_bin")).agg(F.sum("_w").alias("_w"), F.first("quota").alias("quota"), F.first("before").alias("before"))
        total = F.sum("_w").over(Window.partitionBy(group).orderBy("_bin"))
        passed = sums.withColumn("_to", F.col("before") + total).where(F.col("_to") > F.col("quota"))
        state = saved(passed.groupBy(group).agg(F.min(F.struct("_bin", "_to", "_w", "quota")).alias("x")).select(group, "x.quota", (F.col("x._to") - F.col("x._w")).alias("before"), F.col("x._bin").alias("bin")))
        last = shift
    return state.select(group, F.col("bin").alias("edge"), "before")


def rank_in_groups(df: DataFrame, group: str, order: list[Column | str], name: str) -> DataFrame:
    """Add 1-based positions inside each group, in a total order, without a window over a group.

    As in global_row_number, a range-partitioned sort stands; each range tells how many rows of which group it has and where
    they begin.
    """
    ordered = saved(df.orderBy(group, *order).withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}))
    parts = ordered.groupBy("_p", group).agg(F.count("*").alias("_n"), F.min("_i").alias("_least"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = parts.select("_p", group, (before - F.col("_least") + 1).alias("_shift"))
    return ordered.join(shift, ["_p", group]).select(*df.columns, (F.col("_i") + F.col("_shift")).alias(name))


def in_blocks(df: DataFrame, position: str, before: int, block: int = BLOCK) -> DataFrame:
    """Rows by blocks of positions (_b), each block led in by the `before` rows ahead of it (_own false), so that a window over
    one block sees what a window over the whole table would, for frames of no more than `before` rows back."""
    at = F.col(position)
    number = F.floor((at - 1) / block).cast("bigint")
    # a row leads into the next block if it stands among the last rows of its own
    twice = F.pmod(at - 1, F.lit(block)) >= block - before
    return df.withColumn("_b", F.explode(F.when(twice, F.array(number, number + 1)).otherwise(F.array(number)))).withColumn("_own", F.col("_b") == number)
