"""Quality control and annotation joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.functions import names
from cytoframe.operators import labels, layers, qc
from cytoframe.plans import proxies as P
from cytoframe.plans.proxies import with_
from cytoframe.plans.registry import query

MIN_GENES, MT_PCT, N_MAD = 2, 5.0, 3


def flags(spark, d):
    listed = qc.membership_flag(P.obs(spark, d), P.non_empty(spark, d), "non_empty")
    return qc.membership_flag(listed, P.orders_mod(spark, d, 11), "doublet")


def metrics(spark, d):
    return qc.with_singlets(qc.cell_metrics(P.x(spark, d), flags(spark, d), P.mt_genes(spark, d)))


BASE = "x mt flags per metrics"
BOUND = f"bound AS (SELECT median(n_genes) AS md FROM metrics WHERE singlet), mads AS (SELECT any_value(md)::DOUBLE AS median, median(abs(n_genes - md))::DOUBLE AS mad FROM metrics, bound WHERE singlet), cut AS (SELECT median, mad, trunc(median + {N_MAD} * mad)::INT AS max_genes FROM mads)"
FILTERED = f"f AS (SELECT m.*, (n_genes >= {MIN_GENES} AND n_genes <= max_genes AND mt_pct <= {MT_PCT}) AS filter FROM metrics m, cut)"


@query(with_(BASE, " SELECT cell, n_genes, total_counts, mt_counts, round(mt_pct, 6) AS mt_pct FROM metrics"))
def qc_metrics(spark, d):
    return qc.cell_metrics(P.x(spark, d), P.obs(spark, d), P.mt_genes(spark, d)).withColumn("mt_pct", F.round("mt_pct", 6))


@query(with_("flags", " SELECT cell, non_empty, doublet, (non_empty = 1 AND doublet = 0) AS singlet FROM flags"))
def qc_membership_flags(spark, d):
    return qc.with_singlets(flags(spark, d))


@query(with_(BASE, f", {BOUND} SELECT * FROM cut"))
def qc_adaptive_threshold(spark, d):
    return qc.adaptive_max(metrics(spark, d), n_mad=N_MAD)


@query(with_(BASE, f" SELECT cell, singlet, (n_genes >= {MIN_GENES} AND n_genes <= 6 AND mt_pct <= {MT_PCT}) AS filter, (singlet AND n_genes >= {MIN_GENES} AND n_genes <= 6 AND mt_pct <= {MT_PCT}) AS singlet_filtered FROM metrics"))
def qc_filter_fixed(spark, d):
    out = qc.qc_filter(metrics(spark, d), MIN_GENES, 6, MT_PCT)
    return out.select("cell", "singlet", "filter", (F.col("singlet") & F.col("filter")).alias("singlet_filtered"))


def adaptive(spark, d):
    return qc.qc_filter_adaptive(metrics(spark, d), MIN_GENES, MT_PCT, N_MAD)


@query(with_(BASE, f", {BOUND}, {FILTERED} SELECT cell, non_empty, doublet, n_genes, total_counts, mt_counts, round(mt_pct, 6) AS mt_pct, singlet, filter, singlet AND filter AS singlet_filtered FROM f"))
def qc_filter_adaptive(spark, d):
    return adaptive(spark, d).withColumn("mt_pct", F.round("mt_pct", 6))


@query(with_(BASE, f", {BOUND}, {FILTERED} SELECT sum(non_empty)::BIGINT AS num_non_empty, count(*) FILTER (singlet) AS num_singlets, count(*) FILTER (filter) AS num_filtered, count(*) FILTER (singlet AND filter) AS num_singlet_filtered FROM f"))
def qc_filter_stats(spark, d):
    return qc.filter_stats(adaptive(spark, d))


@query(
    with_(
        BASE,
        """, s AS (SELECT *, max(n_genes) OVER () AS top FROM metrics WHERE singlet),
        b AS (SELECT least(n_genes * 20 // top, 19)::INT AS bin, count(*) AS n_cells, avg(mt_pct) FILTER (n_genes < top) AS mean_mt_pct FROM s GROUP BY 1),
        g AS (SELECT bin::INT AS bin, (SELECT any_value(top) FROM s) AS top FROM range(0, 20) t(bin))
        SELECT bin, top * bin / 20.0::DOUBLE AS lo, top * (bin + 1) / 20.0::DOUBLE AS hi, coalesce(n_cells, 0) AS n_cells, round(coalesce(mean_mt_pct, 0.0), 6)::DOUBLE AS mean_mt_pct FROM g LEFT JOIN b USING (bin)""",
    )
)
def qc_gene_histogram(spark, d):
    return qc.gene_histogram(metrics(spark, d).where("singlet")).select("bin", F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi"), "n_cells", F.round("mean_mt_pct", 6).alias("mean_mt_pct"))


@query(
    with_(
        BASE,
        """, l AS (SELECT 'n_genes' AS col_name, n_genes::DOUBLE AS v FROM metrics UNION ALL SELECT 'total_counts', total_counts::DOUBLE FROM metrics UNION ALL SELECT 'mt_pct', mt_pct FROM metrics),
        e AS (SELECT col_name, CASE WHEN min(v) >= 0 THEN 0.0 ELSE min(v) END AS lo, max(v) AS hi FROM l GROUP BY 1)
        SELECT l.col_name, greatest(least(ceil((v - lo) / ((hi - lo) / 20)) - 1, 19), 0)::INT AS bin, count(*) AS n FROM l JOIN e USING (col_name) GROUP BY 1, 2""",
    )
)
def qc_numeric_histograms(spark, d):
    return qc.numeric_histograms(metrics(spark, d), ["n_genes", "total_counts", "mt_pct"])


@query("WITH d AS (SELECT o_orderkey AS cell, o_totalprice / (SELECT max(o_totalprice) FROM orders) AS score FROM orders WHERE o_orderkey % 11 = 0) SELECT o_orderkey AS cell, round(score, 6) AS score FROM orders LEFT JOIN d ON o_orderkey = cell")
def score_lookup(spark, d):
    orders = P.table(spark, d, "orders")
    top = orders.agg(F.max("o_totalprice").alias("top"))
    scores = orders.where("o_orderkey % 11 = 0").crossJoin(F.broadcast(top)).select(F.col("o_orderkey").alias("cell"), F.round(F.col("o_totalprice") / F.col("top"), 6).alias("score"))
    return labels.lookup(P.obs(spark, d), scores, "score")


@query("""WITH t AS (SELECT o_orderkey AS cell, CASE o_orderkey % 10 WHEN 0 THEN 'nan' WHEN 5 THEN '' ELSE trim(o_orderpriority, '"') END AS celltype FROM orders WHERE o_orderkey % 3 = 0),
k AS (SELECT * FROM t WHERE celltype <> '' AND lower(celltype) <> 'nan')
SELECT o_orderkey AS cell, coalesce(celltype, '') AS celltype FROM orders LEFT JOIN k ON o_orderkey = cell""")
def label_with_default(spark, d):
    orders = P.table(spark, d, "orders").where("o_orderkey % 3 = 0")
    kind = F.when(F.col("o_orderkey") % 10 == 0, "nan").when(F.col("o_orderkey") % 10 == 5, "").otherwise(names.clean_label(F.col("o_orderpriority")))
    table = orders.select(F.col("o_orderkey").alias("cell"), kind.alias("celltype")).where(names.is_label(F.col("celltype")))
    return labels.lookup(P.obs(spark, d), table, "celltype", default="")


@query("""WITH r AS (SELECT l_orderkey AS cell, l_returnflag || l_linestatus AS label, l_linenumber * 1000000 + l_partkey AS ord FROM lineitem WHERE l_orderkey % 3 <> 1),
m AS (SELECT cell, arg_max(label, (ord, label)) AS label FROM r GROUP BY 1)
SELECT o_orderkey AS cell, CASE WHEN label IN ('NO', 'RF', 'AF') THEN label END AS cell_type FROM orders LEFT JOIN m ON o_orderkey = cell""")
def label_categorical(spark, d):
    li = P.table(spark, d, "lineitem").where("l_orderkey % 3 <> 1")
    rows = li.select(F.col("l_orderkey").alias("cell"), F.concat("l_returnflag", "l_linestatus").alias("label"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("ord"))
    mapping = labels.last_wins(rows, "cell", "label", F.struct("ord", "label"))
    cats = spark.createDataFrame([("NO",), ("RF",), ("AF",), ("unused",)], "name string")
    return labels.categorical(P.obs(spark, d), mapping, cats, "cell_type")


LISTS = {"ambiguous": 3, "doublet": 5, "missing_cells": 7, "unassignable": 11}


@query("""WITH s AS (SELECT o_orderkey AS cell, CASE WHEN o_orderkey % 11 = 0 THEN 'unassignable' WHEN o_orderkey % 7 = 0 THEN 'missing_cells' WHEN o_orderkey % 5 = 0 THEN 'doublet' WHEN o_orderkey % 3 = 0 THEN 'ambiguous' END AS value FROM orders)
SELECT cell, coalesce(value, 'BC' || (cell % 100)::VARCHAR) AS value FROM s WHERE value IS NOT NULL OR cell % 2 = 0""")
def priority_table(spark, d):
    lists = {k: P.orders_mod(spark, d, m) for k, m in LISTS.items()}
    given = P.orders_mod(spark, d, 2).withColumn("value", F.concat(F.lit("BC"), (F.col("cell") % 100).cast("string")))
    return labels.priority_table(lists, given)


@query("""WITH a AS (SELECT l_orderkey AS cell, arg_min(l_partkey % 40, (l_linenumber, l_partkey)) AS idx FROM lineitem WHERE l_orderkey % 2 = 0 GROUP BY 1),
n AS (SELECT p_partkey AS pos, p_brand AS sample FROM part WHERE p_partkey < 30)
SELECT o_orderkey AS cell, CASE WHEN o_orderkey % 5 = 0 THEN 'doublets' WHEN o_orderkey % 3 = 0 THEN 'ambiguous' WHEN o_orderkey % 11 = 0 THEN 'low_support' WHEN o_orderkey % 7 = 0 THEN 'missing'
  WHEN idx IS NOT NULL THEN coalesce(sample, idx::VARCHAR) ELSE 'filtered' END AS category
FROM orders LEFT JOIN a ON o_orderkey = cell LEFT JOIN n ON idx = pos""")
def priority_category(spark, d):
    lists = {k: P.orders_mod(spark, d, m) for k, m in {"missing": 7, "low_support": 11, "ambiguous": 3, "doublets": 5}.items()}
    li = P.table(spark, d, "lineitem").where("l_orderkey % 2 = 0")
    first = labels.first_wins(li.select(F.col("l_orderkey").alias("cell"), (F.col("l_partkey") % 40).alias("idx"), F.struct("l_linenumber", "l_partkey").alias("ord")), "cell", "idx", "ord")
    tags = P.table(spark, d, "part").where("p_partkey < 30").select(F.col("p_partkey").alias("pos"), F.col("p_brand").alias("name"))
    return labels.priority_category(P.obs(spark, d), lists, labels.by_position(first, tags))


@query(with_("layers", " SELECT layer, gene, sum(n)::BIGINT AS total FROM layers GROUP BY 1, 2"))
def layer_gene_totals(spark, d):
    return layers.layer_totals(P.layers(spark, d))


@query(with_("x", " SELECT cell, gene, n FROM x"))
def layer_total(spark, d):
    return layers.sum_layers(P.layers(spark, d))


@query(with_("layers", " SELECT CASE layer WHEN 'spliced' THEN 'features' ELSE 'gex' END AS layer, cell, gene, n FROM layers WHERE layer <> 'ambiguous'"))
def layer_merge_outer(spark, d):
    return layers.merge_outer(P.layer(spark, d, "spliced"), P.layer(spark, d, "unspliced"), ("features", "gex"))


@query(with_("layers", ", g AS (SELECT DISTINCT gene FROM layers WHERE layer = 'spliced' AND gene % 2 = 0) SELECT CASE layer WHEN 'spliced' THEN 'first' ELSE 'second' END AS layer, cell, gene, n FROM layers WHERE layer = 'spliced' OR (layer = 'unspliced' AND gene IN (SELECT gene FROM g))"))
def layer_merge_left_genes(spark, d):
    a = P.layer(spark, d, "spliced")
    return layers.merge_left_genes(a, a.where("gene % 2 = 0").select("gene").distinct(), P.layer(spark, d, "unspliced"), ("first", "second"))


@query("SELECT coalesce(a.k, b.k) AS k, coalesce(b.price, a.price) AS price, a.brand, b.size FROM (SELECT p_partkey AS k, p_retailprice AS price, p_brand AS brand FROM part WHERE p_partkey % 3 <> 0) a FULL JOIN (SELECT p_partkey AS k, p_retailprice + 1 AS price, p_size AS size FROM part WHERE p_partkey % 2 = 0) b ON a.k = b.k")
def annotation_merge(spark, d):
    part = P.table(spark, d, "part")
    a = part.where("p_partkey % 3 <> 0").selectExpr("p_partkey as k", "p_retailprice as price", "p_brand as brand")
    b = part.where("p_partkey % 2 = 0").selectExpr("p_partkey as k", "p_retailprice + 1 as price", "p_size as size")
    return layers.merge_annotations(a, b, "k")


@query(with_("layers obs", " SELECT 'denoised' AS layer, cell, gene, n FROM layers WHERE layer = 'spliced' AND gene IN (SELECT p_partkey FROM part WHERE p_partkey % 4 <> 0)"))
def layer_add_aligned(spark, d):
    genes = P.var(spark, d).where("gene % 4 <> 0")
    return layers.add_aligned_layer(P.x(spark, d), P.obs(spark, d), genes, P.layer(spark, d, "spliced"), "denoised")[0]


@query(with_("layers obs", " SELECT cell, cell IN (SELECT cell FROM layers WHERE layer = 'spliced') AS is_denoised FROM obs"))
def layer_add_flag(spark, d):
    return layers.add_aligned_layer(P.x(spark, d), P.obs(spark, d), P.var(spark, d), P.layer(spark, d, "spliced"), "denoised")[1]


@query("""WITH w AS (SELECT l_orderkey AS cell, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT o_orderkey AS cell, coalesce(a, 0) AS a, coalesce(r, 0) AS r FROM orders LEFT JOIN w ON o_orderkey = cell""")
def align_zero_fill(spark, d):
    li = P.table(spark, d, "lineitem").where("l_linestatus = 'F'")
    wide = li.groupBy(F.col("l_orderkey").alias("cell")).agg(F.count_if(F.col("l_returnflag") == "A").alias("a"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    return layers.align_with_zeros(P.obs(spark, d), wide, ["a", "r"])


@query("""WITH f AS (SELECT c_custkey AS k, c_mktsegment AS segment FROM customer), c AS (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT f.k, segment, n_orders, n_orders IS NOT NULL AS is_expressed FROM f LEFT JOIN c USING (k)""")
def annotation_transfer(spark, d):
    f = P.table(spark, d, "customer").selectExpr("c_custkey as k", "c_mktsegment as segment")
    c = P.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n_orders"))
    return layers.transfer_annotations(f, c, "k", "is_expressed", "is_featured")[0]


@query(with_("layers", """, a AS (SELECT cell, gene, n FROM layers WHERE layer = 'spliced'), b AS (SELECT cell, gene, n FROM layers WHERE layer = 'ambiguous')
SELECT * FROM a WHERE cell IN (SELECT cell FROM b) AND gene IN (SELECT gene FROM b)"""))
def common_subset(spark, d):
    return layers.common_subset([P.layer(spark, d, "spliced"), P.layer(spark, d, "ambiguous")])[0]


@query(with_(BASE, f", {BOUND}, {FILTERED} SELECT x.* FROM x WHERE cell IN (SELECT cell FROM f WHERE singlet AND filter)"))
def subset_singlet_filtered(spark, d):
    return layers.subset_cells(P.x(spark, d), adaptive(spark, d), "singlet_filtered")


@query(with_("x", " SELECT cell, gene, n FROM x WHERE cell NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 11 = 0)"))
def rows_to_zero(spark, d):
    return layers.zero_rows(P.x(spark, d), P.orders_mod(spark, d, 11))


@query(with_("x layers mt", " SELECT cell, gene, n FROM x WHERE gene NOT IN (SELECT gene FROM mt) UNION ALL SELECT cell, gene, n FROM layers WHERE layer = 'spliced' AND gene IN (SELECT gene FROM mt)"))
def columns_overwritten(spark, d):
    return layers.overwrite_columns(P.x(spark, d), P.layer(spark, d, "spliced"), P.mt_genes(spark, d))


@query(with_("var", " SELECT gene, p_type LIKE '%STEEL%' OR NOT (SELECT bool_or(p_type LIKE '%STEEL%') FROM var) AS is_gene FROM var"))
def gene_split(spark, d):
    return qc.split_by_name(P.var(spark, d), "p_type", "STEEL").select("gene", "is_gene")


@query(with_("layers", " SELECT cell::VARCHAR || '_' || layer AS cell, gene, n, layer AS sample, 'solo' AS method FROM layers WHERE layer <> 'ambiguous'"))
def concat_samples(spark, d):
    return layers.concat_samples({k: P.layer(spark, d, k).withColumn("cell", F.col("cell").cast("string")) for k in ("spliced", "unspliced")}, "solo")


@query("""WITH a AS (SELECT p_partkey AS k, p_size AS v FROM part), b AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 9 = 0 THEN p_size + 1 ELSE p_size END AS v FROM part WHERE p_partkey % 10 <> 0)
SELECT 'left' AS side, count(*) AS n_rows FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'right', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def dataset_compare(spark, d):
    part = P.table(spark, d, "part")
    a = part.selectExpr("p_partkey as k", "p_size as v")
    b = part.where("p_partkey % 10 <> 0").selectExpr("p_partkey as k", "case when p_partkey % 9 = 0 then p_size + 1 else p_size end as v")
    return layers.compare_tables(a, b)


@query("SELECT DISTINCT l_orderkey AS cell FROM lineitem WHERE l_linestatus = 'F' EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def set_difference(spark, d):
    a = P.table(spark, d, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("cell"))
    return a.distinct().join(P.table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("cell")), "cell", "left_anti")


@query("SELECT name, pos::BIGINT AS pos FROM (SELECT 'ambiguous' AS name, 0 AS pos UNION ALL SELECT 'doublet', 0 UNION ALL SELECT 'missing_cells', 0 UNION ALL SELECT 'unassignable', 0 UNION ALL SELECT 'BC' || p_partkey, p_partkey FROM (SELECT DISTINCT p_partkey FROM part))")
def generated_categories(spark, d):
    """The fixed categories and one for each barcode number of part."""
    rows = labels.categories_of(P.table(spark, d, "part"), "p_partkey")
    return rows.withColumn("pos", F.coalesce(F.try_to_number(F.substring("name", 3, 20), F.lit("999999999")).cast("bigint"), F.lit(0)))


@query("""WITH a AS (SELECT o_orderkey AS cell, 'BC' || (o_orderkey % 60) AS value FROM orders), n AS (SELECT 'BC' || p_partkey AS barcode, p_brand AS sample FROM part WHERE p_partkey < 40)
SELECT cell, coalesce(sample, value) AS value FROM a LEFT JOIN n ON value = barcode""")
def sample_names(spark, d):
    given = P.obs(spark, d).withColumn("value", F.concat(F.lit("BC"), (F.col("cell") % 60).cast("string")))
    tags = P.table(spark, d, "part").where("p_partkey < 40").select(F.concat(F.lit("BC"), F.col("p_partkey").cast("string")).alias("barcode"), F.col("p_brand").alias("sample"))
    return labels.sample_names(given, tags)


@query("""WITH c AS (SELECT DISTINCT CASE WHEN o_orderkey % 5 = 0 THEN 'doublets' WHEN o_orderkey % 3 = 0 THEN 'filtered' ELSE o_orderpriority END AS category FROM orders)
SELECT category, (row_number() OVER (ORDER BY CASE category WHEN 'doublets' THEN 3 WHEN 'filtered' THEN 4 ELSE -1 END, category) - 1)::INT AS pos FROM c""")
def category_order(spark, d):
    kind = F.when(F.col("o_orderkey") % 5 == 0, "doublets").when(F.col("o_orderkey") % 3 == 0, "filtered").otherwise(F.col("o_orderpriority"))
    return labels.category_order(P.table(spark, d, "orders").select(kind.alias("category")))


@query(with_("x", """, b AS (SELECT cell, gene, CASE WHEN gene % 50 = 1 THEN n + 1 ELSE n END AS n FROM x WHERE cell % 7 <> 0), o AS (SELECT o_orderkey AS cell, o_orderstatus AS state FROM orders), p AS (SELECT cell, state FROM o WHERE cell % 7 <> 0), v AS (SELECT p_partkey AS gene, p_brand, p_type FROM part)
SELECT 'obs' AS part, (SELECT count(*) FROM o) AS n_left, (SELECT count(*) FROM p) AS n_right, (SELECT count(*) FROM (FROM o EXCEPT ALL FROM p)) AS only_left, (SELECT count(*) FROM (FROM p EXCEPT ALL FROM o)) AS only_right, '' AS columns_left, '' AS columns_right, (SELECT count(*) FROM o) = (SELECT count(*) FROM p) AS same
UNION ALL SELECT 'var', (SELECT count(*) FROM v), (SELECT count(*) FROM v), 0, 0, 'p_type', '', false
UNION ALL SELECT 'x', (SELECT count(*) FROM x), (SELECT count(*) FROM b), (SELECT count(*) FROM (FROM x EXCEPT ALL FROM b)), (SELECT count(*) FROM (FROM b EXCEPT ALL FROM x)), '', '', false"""))
def bundle_compare(spark, d):
    """Two data sets compared whole: the second lacks every seventh cell and a column, and some of its counts differ."""
    from cytoframe.operators.compare import compare_bundles
    from cytoframe.sources.matrix import Bundle

    x, obs = P.x(spark, d), P.table(spark, d, "orders").select(F.col("o_orderkey").alias("cell"), F.col("o_orderstatus").alias("state"))
    other = x.where("cell % 7 <> 0").withColumn("n", F.when(F.col("gene") % 50 == 1, F.col("n") + 1).otherwise(F.col("n")))
    return compare_bundles(Bundle(obs, P.var(spark, d), x), Bundle(obs.where("cell % 7 <> 0"), P.var(spark, d).drop("p_type"), other))


@query("""WITH s AS (SELECT * FROM orders ORDER BY ('0x' || md5('0:' || o_orderkey)[1:13])::BIGINT LIMIT 1000), n AS (SELECT count(*) AS n_rows FROM orders), k AS (SELECT count(*)::INT AS n_sampled FROM s)
SELECT 'o_orderkey' AS col_name, n_rows, 0::BIGINT AS nulls, (SELECT min(o_orderkey)::DOUBLE FROM orders) AS least, (SELECT max(o_orderkey)::DOUBLE FROM orders) AS most, n_sampled, (SELECT count(DISTINCT o_orderkey) FROM s) AS n_distinct, 'count data' AS kind FROM n, k
UNION ALL SELECT 'o_custkey', n_rows, 0, (SELECT min(o_custkey) FROM orders), (SELECT max(o_custkey) FROM orders), n_sampled, (SELECT count(DISTINCT o_custkey) FROM s), 'count data' FROM n, k
UNION ALL SELECT 'o_totalprice', n_rows, 0, (SELECT min(o_totalprice) FROM orders), (SELECT max(o_totalprice) FROM orders), n_sampled, (SELECT count(DISTINCT o_totalprice) FROM s), CASE WHEN (SELECT bool_and(o_totalprice = floor(o_totalprice)) FROM s) THEN 'float-stored integers' ELSE 'positive continuous values' END FROM n, k
UNION ALL SELECT 'o_orderstatus', n_rows, 0, NULL, NULL, n_sampled, (SELECT count(DISTINCT o_orderstatus) FROM s), 'categorical' FROM n, k
UNION ALL SELECT 'o_orderdate', n_rows, 0, NULL, NULL, n_sampled, (SELECT count(DISTINCT o_orderdate) FROM s), CASE WHEN (SELECT count(DISTINCT o_orderdate) FROM s) < 0.5 * n_sampled THEN 'categorical' ELSE 'text' END FROM n, k
UNION ALL SELECT 'o_orderpriority', n_rows, 0, NULL, NULL, n_sampled, (SELECT count(DISTINCT o_orderpriority) FROM s), 'categorical' FROM n, k""")
def profile_sampled(spark, d):
    """All columns of orders, counted and sampled by one aggregate."""
    from cytoframe.operators.profile import sampled_profile

    return sampled_profile(P.table(spark, d, "orders"), ["o_orderkey"]).drop("stored", "examples")


@query("SELECT o_orderkey AS cell, o_orderkey % 11 > 5 AS above, o_orderkey % 11 >= 5 AS at_or_above FROM orders")
def cell_calls(spark, d):
    """Droplets above and at the cut-off of a cell."""
    from cytoframe.sinks.committed import called_cells

    p = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("cell"), (F.col("o_orderkey") % 11 / 10.0).alias("p"))
    mark = lambda df, name: df.withColumn(name, F.lit(True))
    both = p.select("cell").join(mark(called_cells(p), "above"), "cell", "left").join(mark(called_cells(p, inclusive=True), "at_or_above"), "cell", "left")
    return both.select("cell", F.coalesce("above", F.lit(False)).alias("above"), F.coalesce("at_or_above", F.lit(False)).alias("at_or_above"))


@query(with_("x", """, o AS (SELECT * FROM x WHERE gene % 3 <> 0 AND cell IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')), i AS (SELECT * FROM x WHERE gene IN (SELECT gene FROM o)),
e AS (SELECT * FROM i WHERE cell NOT IN (SELECT cell FROM o)), big AS (SELECT cell FROM e GROUP BY 1 HAVING sum(n) > 60), s AS (SELECT gene, sum(n) AS s FROM e WHERE cell IN (SELECT cell FROM big) GROUP BY 1)
SELECT g.gene, round(coalesce(s, 0) / ((SELECT sum(s) FROM s) + 1e-10), 9) AS share FROM (SELECT DISTINCT gene FROM o) g LEFT JOIN s USING (gene)"""))
def other_output_ambient(spark, d):
    """The ambient profile that another tool's output leaves: droplets it lacks, over its genes."""
    from cytoframe.operators import metrics as measures

    x = P.x(spark, d)
    out = x.where("gene % 3 <> 0").join(P.table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("cell")), "cell", "left_semi")
    return measures.against_other_output(x, out, least_empty=60)[1].withColumn("share", F.round("share", 9))


@query(with_("x", """, c AS (SELECT o_orderkey AS cell FROM orders WHERE o_orderstatus = 'F'), e AS (SELECT * FROM x WHERE cell NOT IN (SELECT cell FROM c)), k AS (SELECT count(DISTINCT cell) AS k FROM e),
p AS (SELECT gene, sum(n) * 50.0 / max(k) AS projected FROM e, k GROUP BY 1), ig AS (SELECT p_partkey AS gene FROM part LEFT JOIN p ON gene = p_partkey WHERE NOT starts_with(p_type, 'STANDARD') OR coalesce(projected, 0) < 0.7),
own AS (SELECT * FROM x WHERE gene NOT IN (SELECT gene FROM ig)), t AS (SELECT cell, sum(n) AS t FROM own GROUP BY 1 HAVING sum(n) >= 5 ORDER BY t DESC, cell LIMIT 400)
SELECT cell, gene, n, true AS trained FROM own WHERE cell IN (SELECT cell FROM t) UNION ALL SELECT cell, gene, n, false FROM x WHERE gene IN (SELECT gene FROM ig)"""))
def removal_trimming(spark, d):
    """What noise removal sees of a matrix, and what passes through it."""
    from cytoframe.operators import metrics as measures

    x = P.x(spark, d)
    cells = P.table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("cell"))
    var = P.var(spark, d).withColumn("feature_type", F.split("p_type", " ")[0])
    ignored = measures.ignored_genes(x, var, cells, 50, ["STANDARD"], least_ambient=0.7)
    seen, passed = measures.trimmed_for_removal(x, ignored, 400)
    return seen.withColumn("trained", F.lit(True)).unionByName(passed.withColumn("trained", F.lit(False)))


@query(with_("layers", """, c AS (SELECT o_orderkey AS cell, CASE WHEN o_orderkey % 10 = 0 THEN 'NaN' WHEN o_orderkey % 10 = 1 THEN '' ELSE o_orderpriority END AS celltype FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 10 > 1),
v AS (SELECT layer, cell, gene, n, sum(n) OVER (PARTITION BY layer, cell) AS total FROM layers WHERE layer <> 'ambiguous')
SELECT cell || '_' || layer AS cell, gene, celltype, layer AS sample, round(ln(1 + n * 10000.0 / total), 6) AS value FROM v JOIN c USING (cell)"""))
def reference_build(spark, d):
    """The labelled cells of two samples as one reference."""
    from cytoframe.operators.reference import build_reference
    from cytoframe.sources.matrix import Bundle

    key = F.col("o_orderkey")
    kind = F.when(key % 10 == 0, "NaN").when(key % 10 == 1, "").otherwise(F.col("o_orderpriority"))
    obs = P.table(spark, d, "orders").select(key.alias("cell"), kind.alias("celltype"), (F.col("o_orderstatus") != "P").alias("singlet_filtered"))
    ref = build_reference([(k, "solo", Bundle(obs, P.var(spark, d), P.layer(spark, d, k))) for k in ("spliced", "unspliced")])
    return ref.x.join(ref.obs.select("cell", "celltype", "sample"), "cell").select("cell", "gene", "celltype", "sample", F.round("value", 6).alias("value"))
