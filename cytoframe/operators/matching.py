"""Matching reads to barcodes and features with bounded mismatches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.functions.sequences import error_probability, expand_n, hamming_up_to, neighbours, substrings
from cytoframe.operators import probing

#: Candidates that a read may have before it is rejected rather than deferred.
MOST_CANDIDATES = 3
ACCEPT = 0.975


def correct_barcodes(reads: DataFrame, whitelist: DataFrame, max_n: int = 1) -> DataFrame:
    """(read_id, barcode, state, corrected, candidates) of reads (read_id, barcode).

    exact: in the whitelist; corrected: the one whitelisted barcode at distance one, or the one whitelisted expansion of
    its Ns; deferred: two or three candidates; rejected: others. Exact reads leave by an equi-join before neighbours are
    generated, and those meet the whitelist by an equi-join again.
    """
    white = whitelist.select("barcode").distinct()
    distinct = reads.select("barcode").distinct()
    exact = distinct.join(white, "barcode", "left_semi").select("barcode", F.lit("exact").alias("state"), F.array("barcode").alias("candidates"))
    rest = distinct.join(white, "barcode", "left_anti")
    has_n = F.col("barcode").contains("N")
    tried = rest.select("barcode", F.explode(F.when(has_n, expand_n(F.col("barcode"), max_n)).otherwise(neighbours(F.col("barcode")))).alias("other"))
    hits = tried.join(white.select(F.col("barcode").alias("other")), "other").groupBy("barcode").agg(F.sort_array(F.collect_list("other")).alias("candidates"))
    k = F.size("candidates")
    state = F.when(k == 1, "corrected").when(~has_n & (k <= MOST_CANDIDATES), "deferred").otherwise("rejected")
    fuzzy = rest.join(hits, "barcode", "left").select("barcode", F.when(F.col("candidates").isNull(), "rejected").otherwise(state).alias("state"), F.coalesce("candidates", F.array().cast("array<string>")).alias("candidates"))
    known = exact.unionByName(fuzzy)
    joined = reads.join(known, "barcode")
    return joined.select(*reads.columns, "state", F.when(F.col("state").isin("exact", "corrected"), F.element_at("candidates", 1)).alias("corrected"), F.when(F.col("state") == "deferred", F.col("candidates")).alias("candidates"))


def resolve_deferred(deferred: DataFrame, exact_counts: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(read_id, corrected): candidates weighed by (1 + exact reads) times the error probability of the changed base.

    deferred has read_id, barcode, qual and candidates; exact_counts has barcode and n. A read is resolved where one
    candidate holds more than `accept` of the weight.
    """
    each = deferred.select("read_id", "barcode", "qual", F.explode("candidates").alias("cand"))
    i = F.element_at(F.filter(F.sequence(F.lit(1), F.length("barcode")), lambda p: F.substring("barcode", p, F.lit(1)) != F.substring("cand", p, F.lit(1))), 1)
    scored = each.withColumn("i", i).join(exact_counts.select(F.col("barcode").alias("cand"), F.col("n").alias("seen")), "cand", "left")
    weight = (1 + F.coalesce("seen", F.lit(0))) * error_probability(F.substring("qual", F.col("i"), F.lit(1)))
    rows = scored.withColumn("w", weight)
    total = rows.withColumn("share", F.col("w") / F.sum("w").over(Window.partitionBy("read_id")))
    return total.where(F.col("share") > accept).select("read_id", F.col("cand").alias("corrected"), "share")


def match_features(reads: DataFrame, features: DataFrame, max_distance: int) -> DataFrame:
    """(read_id, feature, distance, place): the feature nearest to any substring of the read, if one alone is nearest.

    Features that fit into one table go to the reads, which are not shuffled; more of them are joined by shuffle.
    """
    if known := probing.collected(features):
        return probing.scan_reads(reads, *known, max_distance)
    return joined_features(reads, features, max_distance)


def joined_features(reads: DataFrame, features: DataFrame, max_distance: int) -> DataFrame:
    """match_features for any number of features.

    A read within d mismatches of a feature holds one of d + 1 pieces of it at its place unchanged, so reads and
    features meet by an equi-join on pieces; distances are computed for the pairs that meet only.
    """
    d = max_distance
    # pieces of nearly equal length: piece i covers characters floor(i L / (d + 1)) to floor((i + 1) L / (d + 1))
    edge = lambda i: F.floor(i * F.length("sequence") / F.lit(d + 1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.lit(d)), lambda i: F.struct(edge(i).alias("off"), F.substring("sequence", edge(i) + 1, edge(i + 1) - edge(i)).alias("piece")))
    pieces = features.select("feature", "sequence", F.explode(F.filter(cut, lambda p: p["piece"] != "")).alias("p")).select("feature", "sequence", "p.off", "p.piece")
    longest = features.agg(F.max(F.length("sequence"))).first()[0] or 0
    lengths = pieces.select(F.length("piece").alias("len")).distinct()
    grams = reads.select("read_id", "read").join(F.broadcast(lengths)).select("read_id", "read", F.explode(substrings(F.col("read"), F.col("len"))).alias("g")).select("read_id", "read", "g.at", F.col("g.part").alias("piece"))
    met = grams.join(pieces, "piece").withColumn("begin", F.col("at") - F.col("off")).where((F.col("begin") >= 1) & (F.col("begin") + F.length("sequence") - 1 <= F.length("read")))
    near = met.select("read_id", "feature", "begin", hamming_up_to(F.substring("read", F.col("begin"), F.length("sequence")), F.col("sequence"), longest).alias("distance")).where(F.col("distance") <= d)
    best = near.groupBy("read_id", "feature").agg(F.min(F.struct("distance", "begin")).alias("b")).select("read_id", "feature", F.col("b.distance").alias("distance"), F.col("b.begin").alias("place"))
    return nearest(best)


def nearest(candidates: DataFrame) -> DataFrame:
    """Of each read the candidate of least distance, where only one has it."""
    by = Window.partitionBy("read_id")
    least = candidates.withColumn("_m", F.min("distance").over(by)).where("distance = _m")
    return least.withColumn("_k", F.count("*").over(by)).where("_k = 1").drop("_m", "_k")


def match_at(reads: DataFrame, features: DataFrame, at: int, max_distance: int, max_n: int = 3) -> DataFrame:
    """(read_id, feature, distance, place): features compared at one fixed place, exactly first, then with Ns resolved, then by distance."""
    if known := probing.collected(features):
        return probing.fixed_reads(reads, *known, at, max_distance, max_n)
    return joined_at(reads, features, at, max_distance, max_n)


def joined_at(reads: DataFrame, features: DataFrame, at: int, max_distance: int, max_n: int = 3) -> DataFrame:
    """match_at for any number of features."""
    lengths = features.select(F.length("sequence").alias("len")).distinct()
    part = reads.select("read_id", "read").join(F.broadcast(lengths)).select("read_id", F.substring("read", F.lit(at), F.col("len")).alias("sequence")).where(F.length("sequence") == F.col("len"))
    exact = part.join(features, "sequence").select("read_id", "feature", F.lit(0).alias("distance"))
    rest = part.join(exact.select("read_id"), "read_id", "left_anti")
    ns = rest.where(F.col("sequence").contains("N")).select("read_id", F.explode(expand_n(F.col("sequence"), max_n)).alias("sequence")).join(features, "sequence")
    only = ns.withColumn("_k", F.count("*").over(Window.partitionBy("read_id"))).where("_k = 1").select("read_id", "feature", F.lit(0).alias("distance"))
    left = rest.join(only.select("read_id"), "read_id", "left_anti")
    close = left.withColumnRenamed("sequence", "read").select("read_id", "read")
    fuzzy = joined_features(close, features, max_distance).where(F.col("place") == 1).select("read_id", "feature", "distance")
    return exact.unionByName(only).unionByName(fuzzy).withColumn("place", F.lit(at))


def match_reads(reads: DataFrame, features: DataFrame, at: int, max_distance: int, max_n: int = 3) -> DataFrame:
    """The fixed place first; a scan of the whole read replaces its result only where strictly closer."""
    if known := probing.collected(features):
        return probing.fixed_or_scanned_reads(reads, *known, at, max_distance, max_n)
    fixed = joined_at(reads, features, at, max_distance, max_n)
    scan = joined_features(reads, features, max_distance)
    rows = fixed.withColumn("rank", F.lit(0)).unionByName(scan.withColumn("rank", F.lit(1)).select(*fixed.columns, "rank"))
    by = Window.partitionBy("read_id").orderBy("distance", "rank")
    return rows.withColumn("_r", F.row_number().over(by)).where("_r = 1").drop("_r", "rank")


def read_quality(reads: DataFrame, least_length: int, umi: str = "umi", read: str = "r1_seq") -> DataFrame:
    """Reads long enough whose UMI is pure A, C, G, T."""
    return reads.where((F.length(read) >= least_length) & F.col(umi).rlike("^[ACGT]+$"))


def contained_features(reads: DataFrame, features: DataFrame) -> DataFrame:
    """(read_id, feature): features that a read holds anywhere: by a table in the tasks, or by an equi-join on substrings if they are too many."""
    if known := probing.collected(features):
        return probing.contained_in_reads(reads, *known)
    lengths = features.select(F.length("sequence").alias("len")).distinct()
    parts = reads.select("read_id", "read").join(F.broadcast(lengths)).select("read_id", F.explode(substrings(F.col("read"), F.col("len"))).alias("g")).select("read_id", F.col("g.part").alias("sequence"))
    return parts.join(features, "sequence").select("read_id", "feature").distinct()


def names_on_chromosome(alignments: DataFrame, chromosome: str) -> DataFrame:
    return alignments.where(F.col("rname") == chromosome).select("qname").distinct()


def split_reads(reads: DataFrame, names: DataFrame, key: str = "qname") -> DataFrame:
    """Add listed: whether the read's name is in the list. The two sides are its two filters."""
    hit = names.select(key).distinct().withColumn("_hit", F.lit(True))
    return reads.join(hit, key, "left").select(*reads.columns, F.coalesce("_hit", F.lit(False)).alias("listed"))
