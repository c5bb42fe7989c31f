"""Order-preserving text lines and the small text formats built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line, value): every line with its number in its file, from 0, for any split of the input.

    Lines are numbered inside their split; splits are placed by a running sum of their counts, a table with one row
    for each split.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"), "value"
    )
    split = raw.groupBy("file", "start").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offset = split.select("file", "start", "least", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    return raw.join(offset, ["file", "start"]).select("file", (F.col("id") - F.col("least") + F.col("skip")).alias("line"), "value")


def _content(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Trimmed lines that are neither blank nor comments."""
    lines = numbered_lines(spark, path).withColumn("value", F.trim(F.regexp_replace("value", "\r$", "")))
    return lines.where((F.col("value") != "") & ~F.col("value").startswith("#"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def barcode_list(spark: SparkSession, path: str, first_token: bool = False, missing_ok: bool = True) -> DataFrame:
    """Distinct barcodes of a one-column file, comments and blank lines skipped; a missing file is an empty set."""
    if missing_ok and not _exists(spark, path):
        return spark.createDataFrame([], "barcode string")
    value = F.split(F.col("value"), r"\s+")[0] if first_token else F.col("value")
    return spark.read.text(path).select(F.trim("value").alias("value")).where((F.col("value") != "") & ~F.col("value").startswith("#")).select(value.alias("barcode")).distinct()


def whitelist(spark: SparkSession, path: str, length: int | None = None) -> DataFrame:
    """Barcodes of pure A, C, G, T and one length (that of the longest line unless given); others are an error."""
    rows = spark.read.text(path).select(F.trim("value").alias("barcode")).where("barcode <> ''")
    found = rows.agg(F.max(F.length("barcode")).alias("n"), F.count_if(~F.col("barcode").rlike("^[ACGTN]+$")).alias("bad"), F.min(F.length("barcode")).alias("least")).first()
    if found["bad"] or (found["n"] is not None and found["least"] != found["n"]) or (length and found["n"] not in (None, length)):
        raise ValueError("a whitelist holds lines of A, C, G, T and N of one length")
    return rows.where(F.col("barcode").rlike("^[ACGT]+$")).distinct()


_SEPARATORS = ("\t", ",", ";")


def _fields(value: Column) -> Column:
    """Fields of a line under the delimiter it holds: tab, comma, semicolon, else white space."""
    chosen = F.split(value, r"\s+")
    for sep in reversed(_SEPARATORS):
        chosen = F.when(value.contains(sep), F.split(value, sep)).otherwise(chosen)
    return F.transform(chosen, lambda s: F.trim(s))


#: First-column names that mark a header row.
HEADER_WORDS = ("barcode", "barcodes", "cell_barcode", "cell", "cells", "cell_id", "index")


def two_column_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(barcode, label): the last column with any value is the label; of repeated barcodes the last row wins."""
    rows = _content(spark, path).withColumn("f", _fields(F.col("value")))
    width = rows.select(F.max(F.expr("aggregate(transform(f, (v, i) -> if(v <> '', i, -1)), -1, (a, v) -> greatest(a, v))"))).first()[0]
    if width is None or width < 1:
        raise ValueError(f"{path} holds no barcode with a label")
    # the header test needs the first row of each file only
    firsts = rows.groupBy("file").agg(F.min("line").alias("top"))
    body = rows.join(firsts, "file").where(~((F.col("line") == F.col("top")) & F.lower(F.element_at("f", 1)).isin(*HEADER_WORDS)))
    pairs = body.select(F.element_at("f", 1).alias("barcode"), F.try_element_at("f", F.lit(width + 1)).alias("label"), F.struct("file", "line").alias("ord")).where("barcode <> ''")
    return pairs.groupBy("barcode").agg(F.max_by("label", "ord").alias("label"))


def category_list(spark: SparkSession, path: str) -> DataFrame:
    """(name, pos): comments stripped also inside lines; a single line is split; the first of repeated names counts."""
    lines = numbered_lines(spark, path).withColumn("value", F.trim(F.regexp_replace("value", "#.*$", ""))).where("value <> ''")
    many = lines.count() > 1
    names = lines.select("line", F.posexplode(F.array("value") if many else F.split("value", r"[\t, ]+")).alias("i", "name")).where("name <> ''")
    first = names.groupBy(F.trim("name").alias("name")).agg(F.min(F.struct("line", "i")).alias("at"))
    return first.select("name", (F.row_number().over(Window.orderBy("at")) - 1).alias("pos"))


def assignments(spark: SparkSession, path: str, prefix: str = "BC") -> DataFrame:
    """(barcode, value) of a tab-separated file, values prefixed, header dropped, the last of repeated barcodes wins."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "barcode string, value string")
    rows = _content(spark, path).withColumn("f", F.split("value", "\t")).where(F.size("f") >= 2)
    top = rows.groupBy("file").agg(F.min("line").alias("top"))
    body = rows.join(top, "file").where(~((F.col("line") == F.col("top")) & F.lower(F.trim(F.element_at("f", 1))).isin(*HEADER_WORDS)))
    keyed = body.select(F.trim(F.element_at("f", 1)).alias("barcode"), F.concat(F.lit(prefix), F.trim(F.element_at("f", 2))).alias("value"), F.struct("file", "line").alias("ord"))
    return keyed.groupBy("barcode").agg(F.max_by("value", "ord").alias("value"))


def tag_table(spark: SparkSession, path: str) -> DataFrame:
    """(name, sequence): columns 2 and 5 of a CSV with a header; sequences of A, C, G, T only."""
    raw = spark.read.csv(path, header=True)
    out = raw.select(F.trim(F.col(f"`{raw.columns[1]}`")).alias("name"), F.trim(F.col(f"`{raw.columns[4]}`")).alias("sequence"))
    return out.where(F.col("sequence").rlike("^[ACGT]+$"))


def sample_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(sample, barcode, celltype) of a quoted CSV; barcodes cut to the part between the last '_' and the next '-'; the last row of a pair wins."""
    from cytoframe.functions.names import core_barcode

    rows = numbered_lines(spark, path).withColumn("f", F.transform(F.split("value", ","), lambda s: F.btrim(F.trim(s), F.lit('"'))))
    body = rows.where("line > 0").where(F.size("f") >= 3)
    keyed = body.select(F.col("f")[0].alias("sample"), core_barcode(F.col("f")[1]).alias("barcode"), F.col("f")[2].alias("celltype"), F.struct("file", "line").alias("ord"))
    return keyed.groupBy("sample", "barcode").agg(F.max_by("celltype", "ord").alias("celltype"))


def doublet_scores(spark: SparkSession, path: str) -> DataFrame:
    """(barcode, score) of a tab-separated table with columns Barcode and Score."""
    raw = spark.read.csv(path, header=True, sep="\t")
    return raw.select(F.col("Barcode").alias("barcode"), F.col("Score").cast("double").alias("score"))
