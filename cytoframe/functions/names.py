"""Names of genes, cells, reads, files and chromosomes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_version(gene: Column) -> Column:
    """The part before the first dot."""
    return F.split_part(gene, F.lit("."), F.lit(1))


def core_barcode(name: Column) -> Column:
    """The text between the last '_' and the next '-'; the whole name without such a part."""
    part = F.regexp_extract(name, r"_([^_-]*)-[^_]*$", 1)
    return F.when(name.rlike(r"_[^_-]*-[^_]*$"), part).otherwise(name)


def sample_of_fastq(name: Column) -> Column:
    """A FASTQ file's sample: the name up to _L<digits>_R1_ or _R1_."""
    return F.regexp_extract(name, r"^(.+?)(?:_L[0-9]+)?_R1_", 1)


def read_name(name: Column) -> Column:
    """Without the leading '@'."""
    return F.regexp_replace(name, "^@", "")


def short_read_name(name: Column) -> Column:
    """Without the leading '@' and without what follows the first blank, tab or slash."""
    return F.regexp_replace(F.regexp_replace(name, "^@", ""), r"[ \t/].*$", "")


def chromosome_header(header: Column) -> Column:
    """FASTA headers under chr names: >7 ... becomes '>chr7 7', >MT ... '>chrM MT', others '>name name'."""
    first = F.split_part(header, F.lit(" "), F.lit(1))
    number = F.regexp_extract(first, "^>([0-9XY]+)", 1)
    return (
        F.when(number != "", F.concat(F.lit(">chr"), number, F.lit(" "), number))
        .when(F.substring(first, 2, 2) == "MT", F.lit(">chrM MT"))
        .otherwise(F.concat(first, F.lit(" "), F.substring(first, 2, 1 << 20)))
    )


def clean_label(label: Column) -> Column:
    """Trimmed, without surrounding quotes."""
    return F.btrim(F.trim(label), F.lit('"'))


def is_label(label: Column) -> Column:
    """Not null, not empty and not the text 'nan'."""
    return label.isNotNull() & (F.trim(label) != "") & (F.lower(F.trim(label)) != "nan")
