"""Views of the driver tables that have the shape of single-cell data, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.functions.stats import flat_index

HEX, DNA = "0123456789abcdef", "ACGTACGTACGTACGT"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dna(col, length: int):
    """A pseudo-random sequence from a key."""
    return F.translate(F.substring(F.md5(col.cast("string")), 1, length), HEX, DNA)


def x(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cell, gene, n). Rows of an entry are few, so rows are dealt by cell at once and later aggregates by cell need no second exchange."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cell"), F.col("l_partkey").alias("gene"), "l_quantity")
    return li.repartition("cell").groupBy("cell", "gene").agg(F.sum("l_quantity").cast("bigint").alias("n"))


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "N", "spliced").when(F.col("l_returnflag") == "R", "unspliced").otherwise("ambiguous")
    li = table(spark, sf_dir, "lineitem").select(kind.alias("layer"), F.col("l_orderkey").alias("cell"), F.col("l_partkey").alias("gene"), "l_quantity")
    return li.repartition("cell").groupBy("layer", "cell", "gene").agg(F.sum("l_quantity").cast("bigint").alias("n"))


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return layers(spark, sf_dir).where(F.col("layer") == name).select("cell", "gene", "n")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("cell"))


def var(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene"), "p_brand", "p_type")


def mt_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where("p_partkey % 50 = 0").select(F.col("p_partkey").alias("gene"))


def non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("cell"))


def orders_mod(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_orderkey") % k == 0).select(F.col("o_orderkey").alias("cell"))


def feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("cell"), F.col("event_type").alias("feature")).agg(F.count("*").alias("n"))


def rare_feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like feat, sparse: cells are suppliers and days, so that some hold one feature."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("cell"), F.concat("l_returnflag", "l_linestatus").alias("feature")).agg(F.count("*").alias("n"))


def umis(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("cell"), dna(F.col("l_orderkey"), 7).alias("umi"), F.col("l_returnflag").alias("feature")).agg(F.count("*").alias("n"))


def post(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(m, c, log_prob): q summed over the repeated pairs, normalised within m."""
    from pyspark.sql import Window

    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("m"), (F.col("l_linenumber") - 1).alias("c"), "l_quantity").repartition("m")
    q = li.groupBy("m", "c").agg(F.sum("l_quantity").alias("q"))
    return q.select("m", "c", F.ln(F.col("q") / F.sum("q").over(Window.partitionBy("m"))).alias("log_prob"))


def post_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("m"), (F.col("l_orderkey") % 50).alias("gene")).distinct()


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderkey % 7 = 0").select(F.col("o_orderkey").alias("m"), F.lit(1).alias("off"))


def index_of(cell, gene, genes: int):
    return flat_index(cell, gene, genes)


CTE = {
    "x": "x AS (SELECT l_orderkey AS cell, l_partkey AS gene, sum(l_quantity)::BIGINT AS n FROM lineitem GROUP BY 1, 2)",
    "layers": "layers AS (SELECT CASE l_returnflag WHEN 'N' THEN 'spliced' WHEN 'R' THEN 'unspliced' ELSE 'ambiguous' END AS layer, l_orderkey AS cell, l_partkey AS gene, sum(l_quantity)::BIGINT AS n FROM lineitem GROUP BY 1, 2, 3)",
    "obs": "obs AS (SELECT o_orderkey AS cell FROM orders)",
    "var": "var AS (SELECT p_partkey AS gene, p_brand, p_type FROM part)",
    "mt": "mt AS (SELECT p_partkey AS gene FROM part WHERE p_partkey % 50 = 0)",
    "flags": "flags AS (SELECT o_orderkey AS cell, (o_orderstatus <> 'P')::INT AS non_empty, (o_orderkey % 11 = 0)::INT AS doublet FROM orders)",
    "per": """per AS (SELECT f.cell, f.non_empty, f.doublet, (f.non_empty = 1 AND f.doublet = 0) AS singlet, coalesce(count(x.n) FILTER (x.n > 0), 0) AS n_genes,
        coalesce(sum(x.n), 0)::BIGINT AS total_counts, coalesce(sum(x.n) FILTER (x.gene IN (SELECT gene FROM mt)), 0)::BIGINT AS mt_counts
        FROM flags f LEFT JOIN x USING (cell) GROUP BY 1, 2, 3, 4)""",
    "metrics": "metrics AS (SELECT *, CASE WHEN total_counts = 0 THEN 0.0 ELSE 100.0 * mt_counts / total_counts END::DOUBLE AS mt_pct FROM per)",
    "feat": "feat AS (SELECT user_id AS cell, event_type AS feature, count(*) AS n FROM events GROUP BY 1, 2)",
    "rare": "rare AS (SELECT l_orderkey AS cell, l_returnflag || l_linestatus AS feature, count(*) AS n FROM lineitem GROUP BY 1, 2)",
    "umis": f"umis AS (SELECT l_suppkey AS cell, translate(substr(md5(l_orderkey::VARCHAR), 1, 7), '{HEX}', '{DNA}') AS umi, l_returnflag AS feature, count(*) AS n FROM lineitem GROUP BY 1, 2, 3)",
    "q": "q AS (SELECT l_orderkey AS m, l_linenumber - 1 AS c, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)",
    "post": "post AS (SELECT m, c, ln(q / sum(q) OVER (PARTITION BY m)) AS log_prob FROM q)",
    "pg": "pg AS (SELECT DISTINCT l_orderkey AS m, l_orderkey % 50 AS gene FROM lineitem)",
    "offs": "offs AS (SELECT o_orderkey AS m, 1 AS off FROM orders WHERE o_orderkey % 7 = 0)",
}


def with_(names: str, body: str, recursive: bool = False) -> str:
    """SQL with the named views in front."""
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(CTE[n] for n in names.split()) + body
