"""Feature calling, summaries, profiles, sinks and normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.functions.stats import input_transforms
from cytoframe.operators import features, metrics, profile, umis
from cytoframe.plans import proxies as P
from cytoframe.plans.proxies import with_
from cytoframe.plans.registry import query
from cytoframe.sinks import files


@query(with_("feat", """, r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY n DESC, feature) AS k FROM feat),
w AS (SELECT cell, max(n) FILTER (k = 1) AS feature1_count, coalesce(max(n) FILTER (k = 2), 0) AS feature2_count, max(feature) FILTER (k = 1) AS f FROM r GROUP BY 1)
SELECT c_custkey AS cell, coalesce(CASE WHEN feature1_count > feature2_count THEN f ELSE '' END, '') AS best_feature, feature1_count, feature2_count FROM customer LEFT JOIN w ON c_custkey = cell"""))
def top2_feature(spark, d):
    return features.top_two(P.feat(spark, d), P.table(spark, d, "customer").select(F.col("c_custkey").alias("cell")))


@query(with_("rare", """, r AS (SELECT *, row_number() OVER w AS k, coalesce(lead(n) OVER w, 0) AS second FROM rare WINDOW w AS (PARTITION BY cell ORDER BY n DESC, feature))
SELECT cell, feature FROM r WHERE k = 1 AND n >= 2 AND 2 * second <= n"""))
def assign_feature(spark, d):
    return features.assign_feature(P.rare_feat(spark, d), 2)


@query(with_("rare", """, s AS (SELECT *, count(*) OVER (PARTITION BY cell) AS k FROM rare),
p AS (SELECT a.feature AS feature_i, b.feature AS feature_j, a.n FROM s a JOIN s b USING (cell) WHERE a.k > 1 UNION ALL SELECT feature, NULL, n FROM s WHERE k = 1 UNION ALL SELECT NULL, feature, n FROM s WHERE k = 1)
SELECT feature_i, feature_j, sum(n)::BIGINT AS total FROM p GROUP BY 1, 2"""))
def coexpression(spark, d):
    return features.coexpression(P.rare_feat(spark, d))


@query(with_("rare", ", s AS (SELECT *, count(*) OVER (PARTITION BY cell) AS n_features FROM rare) SELECT feature, n_features, count(*) AS n_cells FROM s GROUP BY 1, 2"))
def feature_histogram(spark, d):
    return features.feature_histogram(P.rare_feat(spark, d))


@query("""WITH p AS (SELECT CASE l_linenumber % 2 WHEN 0 THEN 'ACGTACGT' ELSE 'TTGGCCAA' END AS reference, l_linenumber % 2 AS feature_index, translate(substr(md5(l_partkey::VARCHAR), 1, 8), '0123456789abcdef', 'ACGTACGTACGTACGT') AS s FROM lineitem),
g AS (SELECT feature_index, reference, s, count(*) AS n FROM p GROUP BY ALL)
SELECT feature_index, 'f' || feature_index AS feature, (SELECT string_agg(CASE WHEN substr(reference, i, 1) = substr(s, i, 1) THEN substr(s, i, 1) ELSE lower(substr(s, i, 1)) END, '' ORDER BY i) FROM range(1, 9) t(i)) AS sequence, hamming(reference, s)::INT AS distance, n FROM g""")
def lowercase_mismatch(spark, d):
    li = P.table(spark, d, "lineitem")
    idx = F.col("l_linenumber") % 2
    rows = li.select(idx.alias("feature_index"), F.concat(F.lit("f"), idx.cast("string")).alias("feature"), F.when(idx == 0, "ACGTACGT").otherwise("TTGGCCAA").alias("reference"), P.dna(F.col("l_partkey"), 8).alias("sequence"))
    return features.matched_sequences(rows)


@query(with_("x", """, g AS (SELECT gene, row_number() OVER (ORDER BY gene) AS row_idx FROM (SELECT DISTINCT gene FROM x)), c AS (SELECT cell, row_number() OVER (ORDER BY cell) AS col_idx FROM (SELECT DISTINCT cell FROM x))
SELECT row_idx, col_idx, n FROM x JOIN g USING (gene) JOIN c USING (cell)"""))
def mtx_export(spark, d):
    return files.mtx_entries(P.x(spark, d))


@query(with_("x", ", t AS (SELECT cell, sum(n) AS t FROM x GROUP BY 1) SELECT cell, gene, round(ln(1 + n * 10000.0 / t), 6)::DOUBLE AS value FROM x JOIN t USING (cell)"))
def lognorm_10k(spark, d):
    return metrics.lognorm_10k(P.x(spark, d)).withColumn("value", F.round("value", 6))


@query(with_("x", """, t AS (SELECT *, sum(n) OVER w AS s, sum(ln(1 + n)) OVER w AS ls FROM x WINDOW w AS (PARTITION BY cell))
SELECT cell, gene, round(ln(1 + n), 6) AS log, round(n / (s + 1e-5), 6) AS normalize, round(ln(1 + n) / (ls + 1e-5), 6) AS normalize_log, round(ln(1 + n / (s + 1e-5)), 6) AS log_normalize FROM t"""))
def input_transform(spark, d):
    made = input_transforms(F.col("n"))
    return P.x(spark, d).select("cell", "gene", *[F.round(c, 6).alias(k) for k, c in made.items()])


@query(with_("x", ", c AS (SELECT count(*) AS k FROM orders), p AS (SELECT gene, sum(n)::DOUBLE AS s, sum(n * n)::DOUBLE AS q FROM x GROUP BY 1) SELECT gene, round(s / k, 6) AS mean, round(q / k - (s / k) * (s / k), 6) AS variance, round((q / k - (s / k) * (s / k)) / (s / k + 1e-10), 6) AS fano FROM p, c"))
def fano(spark, d):
    return metrics.fano(P.x(spark, d), P.obs(spark, d)).select("gene", *[F.round(c, 6).alias(c) for c in ("mean", "variance", "fano")])


@query(with_("layers", """, a AS (SELECT gene, sum(n) AS u FROM layers WHERE layer = 'spliced' GROUP BY 1), b AS (SELECT gene, sum(n) AS v FROM layers WHERE layer = 'unspliced' GROUP BY 1)
SELECT round(corr(ln(u::DOUBLE), ln(v::DOUBLE)), 6) AS r, count(*) AS n FROM a JOIN b USING (gene)"""))
def log_pearson(spark, d):
    total = lambda k: P.layer(spark, d, k).groupBy("gene").agg(F.sum("n").alias("t"))
    return metrics.log_pearson(total("spliced"), total("unspliced"), "gene", "t").select(F.round("r", 6).alias("r"), "n")


@query(with_("x", ", t AS (SELECT cell FROM x GROUP BY 1 HAVING sum(n) BETWEEN 20 AND 60), p AS (SELECT gene, sum(n) AS s FROM x WHERE cell IN (SELECT cell FROM t) GROUP BY 1) SELECT gene, round(s / sum(s) OVER (), 9)::DOUBLE AS share FROM p"))
def ambient_profile(spark, d):
    return metrics.ambient_profile(P.x(spark, d), 20, 60).withColumn("share", F.round("share", 9))


@query(with_("x", ", t AS (SELECT sum(n)::BIGINT AS t FROM x GROUP BY cell) SELECT 0.02::DOUBLE AS p, quantile_cont(t, 0.02)::DOUBLE AS cut FROM t UNION ALL SELECT 0.9, quantile_cont(t, 0.9)::DOUBLE FROM t"))
def percentile_cutoffs(spark, d):
    return metrics.percentile_cutoffs(P.x(spark, d), [0.02, 0.9])


@query(with_("x", """, p AS (SELECT cell, coalesce(sum(n) FILTER (gene % 2 = 0), 0) AS a, coalesce(sum(n) FILTER (gene % 2 = 1), 0) AS b FROM x GROUP BY 1)
SELECT cell, CASE WHEN a > b THEN 0 ELSE 1 END AS main, round(least(a, b) / (a + b + 1e-10), 6)::DOUBLE AS contamination FROM p WHERE a > 10 * b OR b > 10 * a"""))
def species_contamination(spark, d):
    return metrics.species_contamination(P.x(spark, d), F.col("gene") % 2).withColumn("contamination", F.round("contamination", 6))


@query("""WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), c AS (SELECT label, i, avg(v) AS v FROM e GROUP BY 1, 2),
s AS (SELECT label, sqrt(sum(v * v)) AS z FROM c GROUP BY 1), p AS (SELECT a.label AS label_a, b.label AS label_b, sum(a.v * b.v) AS dot FROM c a JOIN c b USING (i) GROUP BY 1, 2)
SELECT label_a, label_b, round(1 - dot / (x.z * y.z + 1e-10), 4) + 0.0 AS distance FROM p JOIN s x ON x.label = label_a JOIN s y ON y.label = label_b""")
def cosine_matrix(spark, d):
    means = metrics.centroids(P.table(spark, d, "embeddings"), "label", "embedding")
    return metrics.cosine_matrix(means, "label").withColumn("distance", F.round("distance", 4) + 0.0)


@query(with_("x", ", z AS (SELECT count(*) AS nnz FROM x), c AS (SELECT count(*) AS n_cells FROM orders), g AS (SELECT count(*) AS n_genes FROM part) SELECT nnz, n_cells, n_genes, round(1 - nnz / (n_cells::DOUBLE * n_genes), 9) AS sparsity FROM z, c, g"))
def sparsity(spark, d):
    return profile.sparsity(P.x(spark, d), P.obs(spark, d), P.var(spark, d)).withColumn("sparsity", F.round("sparsity", 9))


@query(with_("layers", " SELECT layer, count(*) AS n_values, min(n) AS least, max(n) AS most, count(DISTINCT n) AS n_distinct FROM layers GROUP BY 1"))
def layer_ranges(spark, d):
    return profile.layer_ranges(P.layers(spark, d))


@query("""WITH c AS (SELECT p_type AS value, count(*) AS n FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, value) AS k FROM c)
SELECT CASE WHEN k <= 10 THEN value ELSE '(other)' END AS value, sum(n)::BIGINT AS n FROM r GROUP BY CASE WHEN k <= 10 THEN value ELSE '(other)' END, k > 10""")
def value_counts(spark, d):
    return profile.value_counts(P.table(spark, d, "part"), "p_type")


@query("""SELECT 'p_size' AS col_name, count(*) AS n_rows, count(*) FILTER (p_size IS NULL) AS nulls, count(DISTINCT p_size) AS n_distinct, min(p_size)::DOUBLE AS least, max(p_size)::DOUBLE AS most, true AS whole, 'count data' AS kind FROM part
UNION ALL SELECT 'p_retailprice', count(*), count(*) FILTER (p_retailprice IS NULL), count(DISTINCT p_retailprice), min(p_retailprice), max(p_retailprice), bool_and(p_retailprice = floor(p_retailprice)), 'positive continuous values' FROM part""")
def profile_columns(spark, d):
    return profile.column_profile(P.table(spark, d, "part"), ["p_size", "p_retailprice"])


@query("SELECT 'p_type' AS col_name, count(DISTINCT p_type) AS n_distinct, CASE WHEN count(DISTINCT p_type) < 0.5 * count(*) THEN 'categorical' ELSE 'text' END AS kind FROM part")
def profile_text(spark, d):
    return profile.text_kind(P.table(spark, d, "part"), "p_type")


@query("SELECT o_orderpriority AS label, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def cells_per_label(spark, d):
    return P.table(spark, d, "orders").where("o_orderstatus <> 'P'").groupBy(F.col("o_orderpriority").alias("label")).agg(F.count("*").alias("n"))


@query(with_("x", """, g AS (SELECT gene FROM x GROUP BY 1 ORDER BY sum(n) DESC, gene LIMIT 100), c AS (SELECT cell, row_number() OVER (ORDER BY sum(n) DESC, cell) AS r FROM x GROUP BY 1 HAVING sum(n) >= 5)
SELECT * FROM x WHERE gene IN (SELECT gene FROM g) AND cell IN (SELECT cell FROM c WHERE r > 50 AND r <= 2050)"""))
def trim_top_genes_cells(spark, d):
    return metrics.trimmed(P.x(spark, d), top_genes=100, top_cells=2000, least_counts=5, rank_from=50)


@query(with_("obs", " SELECT cell FROM obs ORDER BY md5(cell || ':1'), cell LIMIT 500"))
def sample_cells(spark, d):
    return metrics.sampled_cells(P.obs(spark, d), 500, seed=1)


@query("""WITH c AS (SELECT o_orderkey AS epoch, -1e6 / (1 + o_orderkey % 97) + o_totalprice AS train FROM orders), o AS (SELECT *, row_number() OVER (ORDER BY epoch) - 1 AS i, train - lag(train) OVER (ORDER BY epoch) AS step FROM c),
n AS (SELECT count(*) AS n, quantile_cont(train, 0.95) - quantile_cont(train, 0.05) AS span, max(train) AS top, arg_max(train, epoch) AS last FROM c),
r AS (SELECT o.*, n.*, CASE WHEN count(step) OVER w = 20 THEN sum(step) OVER w END AS roll FROM o, n WINDOW w AS (ORDER BY epoch ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
m AS (SELECT median(train) AS mid FROM r WHERE i >= n // 2), t AS (SELECT stddev_pop(train) AS typical FROM r WHERE i >= n // 2 AND i < n * 3 // 4)
SELECT round(any_value(span), 4) AS range, bool_or(i >= 46 AND step < -span * 0.05) AS spikes, bool_or(i >= n // 2 AND train < mid - span * 0.25) AS deviates, round(any_value(typical), 4) AS typical_variation, bool_or(last < top - 5 * typical) AS ends_low,
  round(count(*) FILTER (i >= 46 AND step < -3 * typical) / any_value(n), 6) AS non_monotonic, round(min(roll), 4) AS least_rolling_change FROM r, m, t""")
def learning_curve(spark, d):
    curve = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("epoch"), (-1e6 / (1 + F.col("o_orderkey") % 97) + F.col("o_totalprice")).alias("train"))
    out = metrics.learning_curve(curve)
    return out.select(*[F.round(c, 6 if c == "non_monotonic" else 4).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


@query("""WITH c AS (SELECT o_orderkey AS epoch, o_totalprice AS train FROM orders), r AS (SELECT *, train - lag(train) OVER (ORDER BY epoch) AS step, row_number() OVER (ORDER BY epoch DESC) AS back FROM c)
SELECT round(avg(abs(step)) FILTER (back IN (2, 3)) / stddev_pop(train) FILTER (back <= 20), 6) AS convergence_indicator, round(arg_max(train, epoch) - arg_min(train, epoch), 4) AS overall_change FROM r""")
def convergence(spark, d):
    curve = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("epoch"), F.col("o_totalprice").alias("train"))
    return metrics.convergence_indicator(curve).select(F.round("convergence_indicator", 6).alias("convergence_indicator"), F.round("overall_change", 4).alias("overall_change"))


@query("""WITH t AS (SELECT o_orderkey AS cell, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE (o_orderkey * 7919 % 10007) / 10007.0::DOUBLE END AS p FROM orders),
r AS (SELECT *, count(p) OVER () AS k, row_number() OVER (ORDER BY p NULLS LAST) AS r FROM t), a AS (SELECT *, least(1.0, p * k / r)::DOUBLE AS raw FROM r)
SELECT cell, p, round(CASE WHEN p IS NOT NULL THEN min(raw) OVER (ORDER BY p DESC NULLS LAST RANGE UNBOUNDED PRECEDING) END, 9) AS fdr FROM a""")
def fdr_adjusted(spark, d):
    p = F.when(F.col("o_orderkey") % 6 == 0, None).otherwise((F.col("o_orderkey") * 7919 % 10007) / F.lit(10007.0).cast("double"))
    tests = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("cell"), p.alias("p"))
    return metrics.benjamini_hochberg(tests).withColumn("fdr", F.round("fdr", 9))


@query()
def embedding_pca(spark, d):
    return metrics.principal_components(P.table(spark, d, "embeddings"), "embedding").select("vec_id", F.transform("pca", lambda v: F.round(F.abs(v), 6)).alias("pca"))


@query()
def spectral_labels(spark, d):
    """Clusters of all embeddings, as many as there are labels."""
    from cytoframe.operators.clustering import spectral_clusters

    return spectral_clusters(P.table(spark, d, "embeddings"), "vec_id", "embedding", 10)


UMI_SQL = """, k AS (SELECT DISTINCT cell, umi FROM umis), e AS (SELECT a.cell, a.umi AS u, b.umi AS v FROM k a JOIN k b ON a.cell = b.cell AND hamming(a.umi, b.umi) = 1),
reach AS (SELECT cell, umi AS u, umi AS v FROM k UNION SELECT r.cell, r.u, e.v FROM reach r JOIN e ON e.cell = r.cell AND e.u = r.v),
comp AS (SELECT cell, u AS umi, min(v) AS root FROM reach GROUP BY 1, 2)"""


@query(with_("umis", UMI_SQL + " SELECT * FROM comp", recursive=True))
def umi_components(spark, d):
    return umis.umi_components(P.umis(spark, d))


def _umi_dedup(stringency):
    def run(spark, d):
        u = P.umis(spark, d)
        return umis.deduped_counts(u, umis.umi_components(u), stringency)

    return run


PER = UMI_SQL + ", p AS (SELECT cell, root, feature, sum(n) AS n FROM umis JOIN comp USING (cell, umi) GROUP BY 1, 2, 3)"
RULES = {
    0: " SELECT cell, feature, count(*) AS n FROM p WHERE n > 0 GROUP BY 1, 2",
    500: ", r AS (SELECT *, max(n) OVER w AS top, sum(n) OVER w AS total FROM p WINDOW w AS (PARTITION BY cell, root)), b AS (SELECT *, count(*) OVER (PARTITION BY cell, root) AS ties FROM r WHERE n = top) SELECT cell, feature, count(*) AS n FROM b WHERE ties = 1 AND n > total * 0.5 GROUP BY 1, 2",
    1000: ", r AS (SELECT *, count(*) OVER (PARTITION BY cell, root) AS k FROM p) SELECT cell, feature, count(*) AS n FROM r WHERE k = 1 GROUP BY 1, 2",
}
for _s, _sql in RULES.items():
    query(with_("umis", PER + _sql, recursive=True), name=f"umi_dedup_{_s}")(_umi_dedup(_s))


@query(with_("umis", PER + RULES[500].replace("SELECT cell, feature, count(*) AS n FROM b", ", dd AS (SELECT cell, feature, count(*) AS n FROM b") + "), ra AS (SELECT feature, sum(n)::BIGINT AS raw_counts FROM umis GROUP BY 1), de AS (SELECT feature, sum(n)::BIGINT AS deduped_counts FROM dd GROUP BY 1) SELECT coalesce(ra.feature, de.feature) AS feature, coalesce(raw_counts, 0) AS raw_counts, coalesce(deduped_counts, 0) AS deduped_counts FROM ra FULL JOIN de ON ra.feature = de.feature", recursive=True))
def feature_totals(spark, d):
    return features.feature_totals(_umi_dedup(500)(spark, d), P.umis(spark, d))


@query(with_("umis", PER + RULES[500].replace("SELECT cell, feature, count(*) AS n FROM b", ", dd AS (SELECT cell, feature, count(*) AS n FROM b") + "), a AS (SELECT sum(n)::BIGINT AS total_counts, count(DISTINCT cell::VARCHAR || umi) AS distinct_keys, count(DISTINCT cell) AS cells FROM umis) SELECT total_counts, distinct_keys, cells, (SELECT sum(n)::BIGINT FROM dd) AS deduped_counts, round(100.0 * total_counts / (total_counts + 1000), 6)::DOUBLE AS pct_assigned FROM a", recursive=True))
def run_stats(spark, d):
    return features.run_stats(P.umis(spark, d), _umi_dedup(500)(spark, d), unmatched=1000).withColumn("pct_assigned", F.round("pct_assigned", 6))
