"""Summaries of noise removal and of count matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b.cast("double"), F.lit(0.0))


def removal_metrics(raw: DataFrame, out: DataFrame, cells: DataFrame, analysed: int | None = None, expected_cells: int | None = None, fpr: float | None = None) -> DataFrame:
    """One row of totals before and after, over all barcodes and over called cells."""
    total = raw.agg(F.sum("n").cast("bigint").alias("total_raw_counts"), F.count_distinct("cell").alias("_barcodes"))
    inside = raw.join(cells.select("cell"), "cell", "left_semi").agg(F.sum("n").cast("bigint").alias("total_raw_counts_in_cells"))
    after = out.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_output_counts"))
    found = cells.agg(F.count_distinct("cell").alias("found_cells"))
    row = total.crossJoin(inside).crossJoin(after).crossJoin(found)
    a, b, c, k = (F.col(n) for n in ("total_raw_counts", "total_output_counts", "total_raw_counts_in_cells", "found_cells"))
    seen = F.lit(analysed) if analysed is not None else F.col("_barcodes")
    return row.select(
        a, b, (a - b).alias("total_counts_removed"), _ratio(a - b, a).alias("fraction_counts_removed"), c, (c - b).alias("total_counts_removed_from_cells"),
        _ratio(c - b, c).alias("fraction_counts_removed_from_cells"), _ratio(c - b, k).alias("average_counts_removed_per_cell"), F.lit(fpr).cast("double").alias("target_fpr"),
        F.lit(expected_cells).cast("bigint").alias("expected_cells"), k, _ratio(b, k).alias("output_average_counts_per_cell"), _ratio(k, F.lit(expected_cells)).alias("ratio_of_found_cells_to_expected_cells"),
        (seen - k).alias("found_empties"), _ratio(k, seen).alias("fraction_of_analyzed_droplets_that_are_nonempty"),
    )


def gene_removal(raw: DataFrame, out: DataFrame) -> DataFrame:
    """(gene, raw, kept, removed, fraction_removed), the fraction guarded by 1e-5."""
    a = raw.groupBy("gene").agg(F.sum("n").alias("raw"))
    b = out.groupBy("gene").agg(F.sum("n").alias("kept"))
    both = a.join(b, "gene", "left").select("gene", "raw", F.coalesce("kept", F.lit(0)).alias("kept")).withColumn("removed", F.col("raw") - F.col("kept"))
    return both.withColumn("fraction_removed", F.col("removed") / (F.col("raw") + 1e-5))


def top_removed(removal: DataFrame, k: int = 10, percentile: float = 0.9) -> DataFrame:
    """The k genes of largest removed fraction among those above a percentile of raw counts."""
    cut = removal.agg(F.percentile("raw", F.lit(percentile)).alias("cut"))
    return removal.crossJoin(F.broadcast(cut)).where("raw > cut").drop("cut").orderBy(F.col("fraction_removed").desc(), "gene").limit(k)


def top_removed_by_genome(removal: DataFrame, genome: Column, k: int = 2, percentile: float = 0.9) -> DataFrame:
    tagged = removal.withColumn("genome", genome)
    cut = tagged.agg(F.percentile("raw", F.lit(percentile)).alias("cut"))
    by = Window.partitionBy("genome").orderBy(F.col("fraction_removed").desc(), "gene")
    return tagged.crossJoin(F.broadcast(cut)).where("raw > cut").drop("cut").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def fano(x: DataFrame, cells: DataFrame) -> DataFrame:
    """(gene, mean, variance, fano): variance / (mean + 1e-10) over all cells, zeros included."""
    n = cells.agg(F.count("*").alias("n_cells"))
    per = x.groupBy("gene").agg(F.sum(F.col("n").cast("double")).alias("s"), F.sum(F.col("n").cast("double") * F.col("n")).alias("q"))
    moments = per.crossJoin(F.broadcast(n)).withColumn("mean", F.col("s") / F.col("n_cells")).withColumn("variance", F.col("q") / F.col("n_cells") - F.col("mean") * F.col("mean"))
    return moments.select("gene", "mean", "variance", (F.col("variance") / (F.col("mean") + 1e-10)).alias("fano"))


def log_pearson(a: DataFrame, b: DataFrame, key: str, value: str, cutoff: float = 1e-6) -> DataFrame:
    """One row: correlation of the logs where both values are above the cutoff."""
    both = a.select(key, F.col(value).cast("double").alias("u")).join(b.select(key, F.col(value).cast("double").alias("v")), key)
    return both.where((F.col("u") > cutoff) & (F.col("v") > cutoff)).agg(F.corr(F.ln("u"), F.ln("v")).alias("r"), F.count("*").alias("n"))


def ambient_profile(x: DataFrame, least: int, most: int) -> DataFrame:
    """(gene, share): the counts of cells with totals in [least, most], normalised to one."""
    total = x.groupBy("cell").agg(F.sum("n").alias("t")).where(F.col("t").between(least, most)).select("cell")
    per = x.join(total, "cell", "left_semi").groupBy("gene").agg(F.sum("n").alias("s"))
    return per.crossJoin(F.broadcast(per.agg(F.sum("s").alias("z")))).select("gene", (F.col("s") / F.col("z")).alias("share"))


def percentile_cutoffs(x: DataFrame, points: list[float]) -> DataFrame:
    """(p, cut): exact percentiles of the cells' totals."""
    total = x.groupBy("cell").agg(F.sum("n").alias("t"))
    got = total.agg(F.percentile("t", F.array(*map(F.lit, points))).alias("c"))
    return got.select(F.explode(F.arrays_zip(F.array(*map(F.lit, points)).alias("p"), F.col("c").alias("cut"))).alias("z")).select(F.col("z.p").alias("p"), F.col("z.cut").alias("cut"))


def cell_accuracy(called: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: cell_tpr = called and true / true; cell_fdr = called and not true / called."""
    both = called.select("cell", F.lit(1).alias("c")).join(truth.select("cell", F.lit(1).alias("t")), "cell", "full_outer")
    hit = both.agg(F.count_if(F.col("c").isNotNull() & F.col("t").isNotNull()).alias("ct"), F.count("c").alias("nc"), F.count("t").alias("nt"))
    return hit.select(_ratio(F.col("ct"), F.col("nt")).alias("cell_tpr"), _ratio(F.col("nc") - F.col("ct"), F.col("nc")).alias("cell_fdr"))


def count_accuracy(raw: DataFrame, truth: DataFrame, out: DataFrame, cells: DataFrame) -> DataFrame:
    """One row: mean and population deviation over true cells of removed noise found, and of signal lost, and contamination."""
    tag = lambda df, n: df.select("cell", "gene", F.col("n").alias(n))
    e = tag(raw, "r").join(tag(truth, "t"), ["cell", "gene"], "full_outer").join(tag(out, "o"), ["cell", "gene"], "full_outer").join(cells.select("cell"), "cell", "left_semi").na.fill(0, ["r", "t", "o"])
    noise, removed = F.col("r") - F.col("t"), F.col("r") - F.col("o")
    per = e.groupBy("cell").agg(
        F.sum(F.least(noise, removed)).alias("tp"), F.sum(F.greatest(removed - noise, F.lit(0))).alias("fp"), F.sum(F.greatest(noise - removed, F.lit(0))).alias("fn"), F.sum(F.least("t", "o")).alias("tn"),
        F.sum("r").alias("r"), F.sum("o").alias("o"), F.sum("t").alias("t"), F.sum(F.greatest(F.col("o") - F.col("t"), F.lit(0))).alias("left"),
    )
    tpr, tnr = _ratio(F.col("tp"), F.col("tp") + F.col("fn")), _ratio(F.col("tn"), F.col("tn") + F.col("fp"))
    before, after = _ratio(F.col("r") - F.col("t"), F.col("r")), _ratio(F.col("left"), F.col("o"))
    return per.agg(F.avg(tpr).alias("tpr_mean"), F.stddev_pop(tpr).alias("tpr_std"), (1 - F.avg(tnr)).alias("fpr_mean"), F.avg(before).alias("contamination_before"), F.avg(after).alias("contamination_after"), F.count("*").alias("n_cells"))


def species_contamination(x: DataFrame, genome: Column) -> DataFrame:
    """(cell, main, contamination): cells of one genome (0 or 1) by a factor above ten, with the other's share."""
    per = x.withColumn("g", genome).groupBy("cell").agg(F.sum(F.when(F.col("g") == 0, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("g") == 1, F.col("n")).otherwise(0)).alias("b"))
    share = F.least("a", "b") / (F.col("a") + F.col("b") + 1e-10)
    return per.where((F.col("a") > 10 * F.col("b")) | (F.col("b") > 10 * F.col("a"))).select("cell", F.when(F.col("a") > F.col("b"), 0).otherwise(1).alias("main"), share.alias("contamination"))


def centroids(table: DataFrame, label: str, array: str) -> DataFrame:
    """(label, centroid): mean array of each label."""
    flat = table.select(label, F.posexplode(array).alias("i", "v")).groupBy(label, "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    ordered = flat.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("z"))
    return ordered.select(label, F.transform("z", lambda s: s["v"]).alias("centroid"))


def cosine_matrix(means: DataFrame, label: str) -> DataFrame:
    """(label_a, label_b, distance): cosine distances of all centroids; clusters are few, so this is a small product."""
    from cytoframe.functions.stats import cosine_distance

    a, b = means.select(F.col(label).alias("label_a"), F.col("centroid").alias("u")), means.select(F.col(label).alias("label_b"), F.col("centroid").alias("v"))
    return a.crossJoin(b).select("label_a", "label_b", cosine_distance(F.col("u"), F.col("v")).alias("distance"))


def _steps(curve: DataFrame, window: int) -> DataFrame:
    """(i, epoch, train, step, roll): positions from 1, the change to the row before, and the sum of the last `window` changes; by blocks of rows."""
    from cytoframe.operators.ranking import global_row_number, in_blocks

    placed = in_blocks(global_row_number(curve.select("epoch", "train"), ["epoch"], "i"), "i", window)
    order = Window.partitionBy("_b").orderBy("i")
    back = order.rowsBetween(1 - window, 0)
    rows = placed.withColumn("step", F.col("train") - F.lag("train").over(order))
    rows = rows.withColumn("roll", F.when(F.count("step").over(back) == window, F.sum("step").over(back)))
    return rows.where("_own").select("i", "epoch", "train", "step", "roll")


def learning_curve(curve: DataFrame, spike: float = 0.05, deviation: float = 0.25, window: int = 20) -> DataFrame:
    """One row of checks on (epoch, train): range, spikes, deviations, final dip and the least rolling sum of changes."""
    n = curve.agg(F.count("*").alias("n"), F.expr("percentile(train, 0.95) - percentile(train, 0.05)").alias("span"), F.max("train").alias("top"), F.max_by("train", "epoch").alias("last"))
    rows = _steps(curve, window).withColumn("i", F.col("i") - 1).crossJoin(F.broadcast(n))
    half, end = F.floor(F.col("n") / 2), F.floor(F.col("n") * 3 / 4)
    med = rows.where(F.col("i") >= half).agg(F.median("train").alias("mid"))
    mid = rows.where((F.col("i") >= half) & (F.col("i") < end)).agg(F.stddev_pop("train").alias("typical"))
    full = rows.crossJoin(F.broadcast(med)).crossJoin(F.broadcast(mid))
    late = F.col("i") >= 46
    return full.agg(
        F.first("span").alias("range"), F.bool_or(late & (F.col("step") < -F.col("span") * spike)).alias("spikes"), F.bool_or((F.col("i") >= half) & (F.col("train") < F.col("mid") - F.col("span") * deviation)).alias("deviates"),
        F.first("typical").alias("typical_variation"), F.bool_or(F.col("last") < F.col("top") - 5 * F.col("typical")).alias("ends_low"), (F.count_if(late & (F.col("step") < -3 * F.col("typical"))) / F.first("n")).alias("non_monotonic"), F.min("roll").alias("least_rolling_change"),
    )


def convergence_indicator(curve: DataFrame) -> DataFrame:
    """One row: mean absolute change of the two steps before the last, over the deviation of the last twenty; null below 21 epochs. Overall change along."""
    # the last 21 rows tell all but the first value
    tail = curve.orderBy(F.col("epoch").desc()).limit(21)
    order = Window.orderBy(F.col("epoch").desc())
    rows = tail.withColumn("back", F.row_number().over(order)).withColumn("step", F.col("train") - F.lead("train").over(order))
    last = rows.agg(F.when(F.count("*") > 20, F.avg(F.when(F.col("back").isin(2, 3), F.abs("step"))) / F.stddev_pop(F.when(F.col("back") <= 20, F.col("train")))).alias("convergence_indicator"))
    return last.crossJoin(curve.agg((F.max_by("train", "epoch") - F.min_by("train", "epoch")).alias("overall_change")))


def principal_components(table: DataFrame, array: str, k: int = 2) -> DataFrame:
    """Add pca, the first k principal components of an array column."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    vec = table.withColumn("_v", array_to_vector(F.transform(array, lambda v: v.cast("double"))))
    return PCA(k=k, inputCol="_v", outputCol="_p").fit(vec).transform(vec).withColumn("pca", vector_to_array("_p")).drop("_v", "_p")


def lognorm_10k(x: DataFrame) -> DataFrame:
    """(cell, gene, value): log1p of counts per ten thousand of the cell."""
    from cytoframe.functions.stats import log_tp10k

    return x.select("cell", "gene", log_tp10k(F.col("n"), F.sum("n").over(Window.partitionBy("cell"))).alias("value"))


def trimmed(x: DataFrame, top_genes: int | None = None, top_cells: int | None = None, least_counts: int = 0, rank_from: int = 0) -> DataFrame:
    """Entries of the largest genes and of the cells ranked [rank_from, rank_from + top_cells), ties by id, above a least total."""
    out = x
    if top_genes is not None:
        genes = x.groupBy("gene").agg(F.sum("n").alias("t")).orderBy(F.col("t").desc(), "gene").limit(top_genes)
        out = out.join(genes.select("gene"), "gene", "left_semi")
    cells = x.groupBy("cell").agg(F.sum("n").alias("t")).where(F.col("t") >= least_counts)
    if top_cells is not None:
        ranked = cells.orderBy(F.col("t").desc(), "cell").limit(rank_from + top_cells)
        cells = ranked.withColumn("r", F.row_number().over(Window.orderBy(F.col("t").desc(), "cell"))).where(F.col("r") > rank_from)
    return out.join(cells.select("cell"), "cell", "left_semi")


def ignored_genes(x: DataFrame, var: DataFrame, cells: DataFrame, expected_cells: int, feature_types: list[str] | None = None, feature_type: str = "feature_type", least_ambient: float = 0.1) -> DataFrame:
    """(gene): genes that noise removal leaves alone: those of other feature types than the ones given, and those of which the
    ambient profile (droplets that are no cell) projects fewer than `least_ambient` counts into all expected cells."""
    empty = x.join(cells.select("cell"), "cell", "left_anti")
    size = empty.agg(F.count_distinct("cell").alias("_k"))
    per = empty.groupBy("gene").agg(F.sum("n").alias("_s")).crossJoin(F.broadcast(size)).select("gene", (F.col("_s") / F.col("_k") * expected_cells).alias("projected"))
    told = var.join(per, "gene", "left")
    other = F.lit(False) if feature_types is None else ~F.coalesce(F.col(feature_type).isin(feature_types), F.lit(False))
    return told.where(other | (F.coalesce("projected", F.lit(0.0)) < least_ambient)).select("gene")


def trimmed_for_removal(x: DataFrame, ignored: DataFrame, total_droplets: int, least_counts: int = 5) -> tuple[DataFrame, DataFrame]:
    """(entries that noise removal sees, entries that pass through unchanged): the largest droplets of at least `least_counts`
    counts, ties by name, without the ignored genes; and the entries of ignored genes."""
    own = x.join(ignored.select("gene"), "gene", "left_anti")
    return trimmed(own, top_cells=total_droplets, least_counts=least_counts), x.join(ignored.select("gene"), "gene", "left_semi")


def against_other_output(raw: DataFrame, out: DataFrame, least_empty: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What another tool's output leaves of a raw matrix: (raw entries of its cells and genes, ambient profile (gene, share),
    one row with the median counts of empty droplets). Empty droplets are those it lacks with more than `least_empty` counts
    over its genes; shares are guarded by 1e-10."""
    genes = out.select("gene").distinct()
    inside = raw.join(genes, "gene", "left_semi")
    cells = out.select("cell").distinct()
    empty = inside.join(cells, "cell", "left_anti")
    size = empty.groupBy("cell").agg(F.sum("n").alias("t")).where(F.col("t") > least_empty)
    per = empty.join(size.select("cell"), "cell", "left_semi").groupBy("gene").agg(F.sum("n").alias("s"))
    share = genes.join(per, "gene", "left").select("gene", F.coalesce("s", F.lit(0)).alias("s")).crossJoin(F.broadcast(per.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("z"))))
    return inside.join(cells, "cell", "left_semi"), share.select("gene", (F.col("s") / (F.col("z") + 1e-10)).alias("share")), size.agg(F.median("t").alias("median_empty"))


def sampled_cells(cells: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """k cells by the order of the md5 of their name and the seed."""
    return cells.orderBy(F.md5(F.concat_ws(":", F.col("cell").cast("string"), F.lit(str(seed)))), "cell").limit(k)


def benjamini_hochberg(tests: DataFrame, p: str = "p") -> DataFrame:
    """Add fdr: p-values times their number over their rank, with a running minimum from the largest down; null stays null."""
    from cytoframe.operators.ranking import global_row_number, running_minimum_from_end

    known = global_row_number(tests.where(F.col(p).isNotNull()), [F.col(p)], "_r")
    n = known.agg(F.count("*").alias("_n"))
    raw = known.crossJoin(F.broadcast(n)).withColumn("_raw", F.least(F.lit(1.0), F.col(p) * F.col("_n") / F.col("_r"))).drop("_n")
    out = running_minimum_from_end(raw, "_r", "_raw", "fdr").select(*tests.columns, "fdr")
    return out.unionByName(tests.where(F.col(p).isNull()).withColumn("fdr", F.lit(None).cast("double")))
