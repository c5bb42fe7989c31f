"""Feature calling on small feature matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_two(feat: DataFrame, obs: DataFrame | None = None, value: str = "n") -> DataFrame:
    """(cell, best_feature, feature1_count, feature2_count).

    The best feature is named only where it is strictly ahead; a single feature has second count 0. Cells of obs
    without features get '' and null counts. A cell's list is as long as there are features, which are few.
    """
    pair = F.struct(F.col(value).alias("v"), F.col("feature").alias("f"))
    ordered = feat.groupBy("cell").agg(F.slice(F.sort_array(F.collect_list(pair), asc=False), 1, 2).alias("top"))
    first, second = F.element_at("top", 1), F.try_element_at("top", F.lit(2))
    two = F.coalesce(second["v"], F.lit(0))
    out = ordered.select("cell", F.when(first["v"] > two, first["f"]).otherwise("").alias("best_feature"), first["v"].alias("feature1_count"), two.alias("feature2_count"))
    if obs is None:
        return out
    return obs.select("cell").join(out, "cell", "left").withColumn("best_feature", F.coalesce("best_feature", F.lit("")))


def assign_feature(feat: DataFrame, min_counts: int, value: str = "n") -> DataFrame:
    """(cell, feature): the first largest feature (by name) where it reaches min_counts and the second at most half of it."""
    by = Window.partitionBy("cell").orderBy(F.col(value).desc(), "feature")
    ranked = feat.withColumn("_r", F.row_number().over(by)).withColumn("_second", F.coalesce(F.lead(value).over(by), F.lit(0)))
    return ranked.where((F.col("_r") == 1) & (F.col(value) >= min_counts) & (2 * F.col("_second") <= F.col(value))).select("cell", "feature")


def coexpression(feat: DataFrame, value: str = "n") -> DataFrame:
    """(feature_i, feature_j, total): for cells with several features count_i at every (i, j) of them, j = i included; single ones at (i, null) and (null, i)."""
    sized = feat.where(F.col(value) > 0).withColumn("k", F.count("*").over(Window.partitionBy("cell")))
    several, alone = sized.where("k > 1"), sized.where("k = 1")
    pairs = several.select("cell", F.col("feature").alias("feature_i"), value).join(several.select("cell", F.col("feature").alias("feature_j")), "cell")
    none = F.lit(None).cast("string")
    rows = pairs.select("feature_i", "feature_j", value)
    rows = rows.unionByName(alone.select(F.col("feature").alias("feature_i"), none.alias("feature_j"), value)).unionByName(alone.select(none.alias("feature_i"), F.col("feature").alias("feature_j"), value))
    return rows.groupBy("feature_i", "feature_j").agg(F.sum(value).alias("total"))


def feature_histogram(feat: DataFrame, value: str = "n") -> DataFrame:
    """(feature, n_features, n_cells): for each feature, cells by the number of features they hold."""
    sized = feat.where(F.col(value) > 0).withColumn("n_features", F.count("*").over(Window.partitionBy("cell")))
    return sized.groupBy("feature", "n_features").agg(F.count("*").alias("n_cells"))


def feature_totals(deduped: DataFrame, raw: DataFrame, value: str = "n") -> DataFrame:
    """(feature, raw_counts, deduped_counts)."""
    total = lambda df, n: df.groupBy("feature").agg(F.sum(value).alias(n))
    return total(raw, "raw_counts").join(total(deduped, "deduped_counts"), "feature", "full_outer").select("feature", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("raw_counts", "deduped_counts")])


def run_stats(umis: DataFrame, deduped: DataFrame, unmatched: int = 0) -> DataFrame:
    """One row: totals, distinct keys and the share of assigned reads."""
    a = umis.agg(F.sum("n").cast("bigint").alias("total_counts"), F.count_distinct("cell", "umi").alias("distinct_keys"), F.count_distinct("cell").alias("cells"))
    b = deduped.agg(F.sum("n").cast("bigint").alias("deduped_counts"))
    both = a.crossJoin(F.broadcast(b))
    reads = F.col("total_counts") + unmatched
    return both.withColumn("pct_assigned", F.when(reads == 0, 0.0).otherwise(100.0 * F.col("total_counts") / F.nullif(reads, F.lit(0))))


def matched_sequences(matches: DataFrame) -> DataFrame:
    """(feature_index, feature, sequence, distance, n) of matched reads (columns feature_index, feature, reference, sequence), mismatches in lower case, in report order."""
    from cytoframe.functions.sequences import hamming, lowercase_mismatches

    per = matches.groupBy("feature_index", "feature", "reference", "sequence").agg(F.count("*").alias("n"))
    ref, seq = F.col("reference"), F.col("sequence")
    out = per.select("feature_index", "feature", lowercase_mismatches(ref, seq).alias("sequence"), hamming(ref, seq).alias("distance"), "n")
    return out.orderBy("feature_index", "distance", F.col("n").desc(), "sequence")
