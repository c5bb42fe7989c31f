"""FASTQ pairs, annotation files and alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.sources import fastq as source
from cytoframe.sources.text import numbered_lines


def fastq(spark: SparkSession, path: str | list[str], chunk: int = source.CHUNK) -> DataFrame:
    """(file, rec, name, seq, qual): records of four lines; a file with an incomplete record is an error when read."""
    return source.read_fastq(spark, [(f, [(f, n)]) for f, n in source.listed(spark, path)], chunk)


def fastq_pairs(spark: SparkSession, r1: str | list[str], r2: str | list[str], chunk: int = source.CHUNK) -> DataFrame:
    """(pair, rec, r1_name, r1_seq, r1_qual, r2_seq, r2_qual): R1 and R2 in lock step; an incomplete record or a file without
    a record of its pair is an error when read.

    Files pair by their names where those hold '_R1_' and '_R2_', else by their order.
    """
    one, two = source.listed(spark, r1), source.listed(spark, r2)
    named = all("_R1_" in f for f, _ in one) and all("_R2_" in f for f, _ in two)
    key = (lambda f, mark: "_R?_".join(f.rsplit("/", 1)[-1].rsplit(mark, 1))) if named else None
    left = {key(f, "_R1_") if key else i: (f, n) for i, (f, n) in enumerate(one)}
    right = {key(f, "_R2_") if key else i: (f, n) for i, (f, n) in enumerate(two)}
    if set(left) != set(right) or len(left) != len(one) or len(right) != len(two):
        raise ValueError("every R1 file needs one R2 file")
    return source.read_fastq(spark, [(key(f, "_R1_") if key else f, [(f, n), right[k]]) for k, (f, n) in left.items()], chunk)


def gtf(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value, seqname, feature, attributes); comment lines have a null feature."""
    parts = F.split("value", "\t")
    body = ~F.col("value").startswith("#")
    return numbered_lines(spark, path).select("file", "line", "value", F.when(body, parts[0]).alias("seqname"), F.when(body, F.try_element_at(parts, F.lit(3))).alias("feature"), F.when(body, F.try_element_at(parts, F.lit(9))).alias("attributes"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value, header)."""
    return numbered_lines(spark, path).withColumn("header", F.col("value").startswith(">"))


def alignments(spark: SparkSession, path: str) -> DataFrame:
    """(qname, rname) of SAM text."""
    parts = F.split("value", "\t")
    return spark.read.text(path).where(~F.col("value").startswith("@")).select(parts[0].alias("qname"), parts[2].alias("rname"))
