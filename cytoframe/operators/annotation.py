"""Preparation of gene annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Biotypes whose genes stay.
BIOTYPES = (
    "protein_coding", "lncRNA", "IG_C_gene", "IG_D_gene", "IG_J_gene", "IG_LV_gene", "IG_V_gene", "IG_V_pseudogene", "IG_J_pseudogene", "IG_C_pseudogene",
    "TR_C_gene", "TR_D_gene", "TR_J_gene", "TR_V_gene", "TR_V_pseudogene", "TR_J_pseudogene",
)


def attribute(attributes, key: str):
    """The first value of a key in a GTF attribute column."""
    return F.regexp_extract(attributes, key + ' "([^"]*)"', 1)


def has_tag(attributes, tag: str):
    return attributes.contains(f'tag "{tag}"')


def allowed_genes(rows: DataFrame) -> DataFrame:
    """(gene): genes with a transcript of allowed gene and transcript types that is neither PAR nor readthrough."""
    a = F.col("attributes")
    ok = (F.col("feature") == "transcript") & attribute(a, "gene_type").isin(*BIOTYPES) & attribute(a, "transcript_type").isin(*BIOTYPES) & ~has_tag(a, "PAR") & ~has_tag(a, "readthrough_transcript")
    return rows.where(ok).select(F.regexp_extract("attributes", r'gene_id "(ENSG[0-9]+)\.', 1).alias("gene")).where("gene <> ''").distinct()


def versions_apart(attributes):
    """ids of the form name.version split into an id and a version attribute."""
    out = attributes
    for kind, mark in (("gene", "ENSG"), ("transcript", "ENST"), ("exon", "ENSE")):
        out = F.regexp_replace(out, kind + '_id "(' + mark + r'[0-9]+)\.([0-9]+)"', kind + '_id "$1"; ' + kind + '_version "$2"')
    return out


def filtered_gtf(rows: DataFrame) -> DataFrame:
    """Rows of allowed genes without those of chrY's PAR, ids split from versions; comments stay."""
    gene = F.regexp_extract("attributes", r'gene_id "(ENSG[0-9]+)\.', 1)
    comments = rows.where("feature is null")
    body = rows.where("feature is not null").where(~((F.col("seqname") == "chrY") & has_tag(F.col("attributes"), "PAR"))).withColumn("gene", gene)
    kept = body.join(allowed_genes(rows), "gene", "left_semi").drop("gene")
    return comments.unionByName(kept.withColumn("attributes", versions_apart(F.col("attributes"))))
