"""Readers and writers on temporary files."""

import gzip

import pytest
from pyspark.sql import functions as F

from cytoframe.operators import annotation
from cytoframe.sinks import files
from cytoframe.sources import matrix, reads, text


def put(path, body, zipped=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    (gzip.open if zipped else open)(path, "wt").write(body)
    return str(path)


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_lines_are_numbered_across_splits(spark, tmp_path):
    p = put(tmp_path / "many.txt", "".join(f"line {i}\n" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = {r["line"]: r["value"] for r in text.numbered_lines(spark, p).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: f"line {i}" for i in range(5000)}


@pytest.mark.parametrize("body", ["barcode,label\nA,T1\nB,T2\nA,T3\n", "A\tT1\nB\tT2\nA\tT3\n", "# note\nA T1\nB  T2\n\nA T3\n", "A,x,T1\nB,y,T2\nA,z,T3\n"])
def test_two_column_mapping(spark, tmp_path, body):
    assert pairs(text.two_column_mapping(spark, put(tmp_path / "m.txt", body))) == [("A", "T3"), ("B", "T2")]


def test_empty_mapping_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        text.two_column_mapping(spark, put(tmp_path / "m.txt", "# nothing\n"))


@pytest.mark.parametrize("body", ["T1,T2,T3\n", "T1\tT2\tT3\n", "# x\nT1\nT2 # inline\n\nT3\nT1\n"])
def test_category_list(spark, tmp_path, body):
    assert pairs(text.category_list(spark, put(tmp_path / "c.txt", body))) == [("T1", 0), ("T2", 1), ("T3", 2)]


def test_barcode_lists(spark, tmp_path):
    p = put(tmp_path / "b.txt.gz", "# c\nAAA 1\n\nCCC\nAAA 2\n", zipped=True)
    assert pairs(text.barcode_list(spark, p, first_token=True)) == [("AAA",), ("CCC",)]
    assert text.barcode_list(spark, str(tmp_path / "none.txt")).count() == 0
    assert pairs(text.whitelist(spark, put(tmp_path / "w.txt", "ACGT\nACGN\nTTTT\n"))) == [("ACGT",), ("TTTT",)]
    with pytest.raises(ValueError):
        text.whitelist(spark, put(tmp_path / "w2.txt", "ACGT\nACG\n"))


def test_tables(spark, tmp_path):
    assert pairs(text.assignments(spark, put(tmp_path / "a.tsv", "barcode\tvalue\nA\t1\nB\t2\nA\t3\n"))) == [("A", "BC3"), ("B", "BC2")]
    assert pairs(text.tag_table(spark, put(tmp_path / "t.csv", "id,name,r,p,sequence\n1,n1,x,y,ACGT\n2,n2,x,y,ACNT\n"))) == [("n1", "ACGT")]
    assert pairs(text.sample_metadata(spark, put(tmp_path / "s.csv", 's,b,c\n"S1","x_AAA-1","T"\nS1,x_AAA-1,U\nS2,plain,V\n'))) == [("S1", "AAA", "U"), ("S2", "plain", "V")]
    assert pairs(text.doublet_scores(spark, put(tmp_path / "d.tsv", "Barcode\tClassification\tScore\nA\tx\t0.5\n"))) == [("A", 0.5)]


MTX = "%%MatrixMarket matrix coordinate integer general\n% note\n2 3 3\n1 1 5\n2 1 1\n2 3 7\n"


def triple(at, names=("matrix.mtx", "barcodes.tsv", "features.tsv"), mtx=MTX, cells="c1\nc2\nc3\n", genes="g1\tG1\ng2\tG2\n"):
    for n, b in zip(names, (mtx, cells, genes)):
        put(at / n, b)


def test_layouts_and_triples(spark, tmp_path):
    outs = tmp_path / "cr"
    triple(outs / "outs/raw_feature_bc_matrix")
    put(outs / "outs/filtered_feature_bc_matrix/barcodes.tsv", "c3\n")
    assert matrix.layout_of(spark, str(outs)) == "cellranger" and matrix.layout_of(spark, str(tmp_path)) is None
    data = matrix.read_any(spark, str(outs))
    assert pairs(data.x) == [("c1", "g1", 5.0), ("c1", "g2", 1.0), ("c3", "g2", 7.0)] and pairs(data.obs) == [("c1", False), ("c2", False), ("c3", True)]
    bad = tmp_path / "bad"
    triple(bad / "outs/raw_feature_bc_matrix", cells="c1\n")
    put(bad / "outs/filtered_feature_bc_matrix/barcodes.tsv", "c1\n")
    with pytest.raises(ValueError):
        matrix.read_any(spark, str(bad))


def test_layered_layouts(spark, tmp_path):
    k = tmp_path / "ka" / "counts_unfiltered"
    flipped = "%%MatrixMarket\n3 2 2\n1 1 4\n3 2 6\n"
    for kind in ("total", "nascent", "mature", "ambiguous"):
        put(k / f"cells_x_genes.{kind}.mtx", flipped)
    put(k / "cells_x_genes.barcodes.txt", "c1\nc2\nc3\n")
    put(k / "cells_x_genes.genes.txt", "g1.4\ng2.1\n")
    data = matrix.read_any(spark, str(tmp_path / "ka"))
    assert pairs(data.x) == [("c1", "g1", 4.0), ("c3", "g2", 6.0)] and data.layers.select("layer").distinct().count() == 3
    f = tmp_path / "fr/af_quant/alevin"
    put(f / "quants_mat.mtx", "%%MatrixMarket\n1 3 3\n1 1 2\n1 2 3\n1 3 4\n")
    put(f / "quants_mat_rows.txt", "c1\n")
    put(f / "quants_mat_cols.txt", "g1\ng1-U\ng1-A\n")
    fry = matrix.read_any(spark, str(tmp_path / "fr"))
    assert pairs(fry.x) == [("c1", "g1", 9.0)] and pairs(fry.layers.select("layer", "value")) == [("ambiguous", 4.0), ("spliced", 2.0), ("unspliced", 3.0)]
    s = tmp_path / "so/Solo.out"
    triple(s / "GeneFull/raw")
    put(s / "GeneFull/filtered/barcodes.tsv", "c1\n")
    triple(s / "Velocyto/raw", ("spliced.mtx", "barcodes.tsv", "features.tsv"))
    for n in ("unspliced", "ambiguous"):
        put(s / f"Velocyto/raw/{n}.mtx", MTX)
    solo = matrix.read_any(spark, str(tmp_path / "so"))
    assert solo.layers.count() == 9 and solo.obs.where("is_cell").count() == 1
    for n in ("gex", "demux"):
        triple(tmp_path / "fl" / n)
    assert matrix.layout_of(spark, str(tmp_path / "fl")) == "flex" and matrix.read_flex(spark, str(tmp_path / "fl"))["demux"].x.count() == 3
    triple(tmp_path / "feat", ("matrix.mtx", "barcodes.txt", "features.txt"), genes="name seq\nf1 ACG\nf2 TTT\n")
    assert pairs(matrix.read_features(spark, str(tmp_path / "feat")).var) == [("f1",), ("f2",)]


def test_bundle_and_mtx_round_trip(spark, tmp_path):
    x = spark.createDataFrame([("c1", "g1", 5), ("c3", "g2", 7)], "cell string, gene string, n bigint")
    obs = spark.createDataFrame([("c1", True), ("c2", True), ("c3", False)], "cell string, keep boolean")
    data = matrix.Bundle(obs, spark.createDataFrame([("g1",), ("g2",)], "gene string"), x, x.withColumn("layer", F.lit("raw")))
    files.write_bundle(data, str(tmp_path / "b"), "keep")
    back = matrix.read_bundle(spark, str(tmp_path / "b"))
    assert pairs(back.x) == [("c1", "g1", 5)] and back.obs.count() == 2 and back.layers.count() == 1
    files.write_mtx(x, str(tmp_path / "m"))
    again = matrix.read_triple(spark, f"{tmp_path}/m/matrix.mtx", f"{tmp_path}/m/barcodes.txt", f"{tmp_path}/m/features.txt")
    assert pairs(again.x) == [("c1", "g1", 5.0), ("c3", "g2", 7.0)]
    files.write_barcodes(obs, str(tmp_path / "list"), "keep")
    assert pairs(spark.read.text(str(tmp_path / "list"))) == [("c1",), ("c2",)]
    files.write_stats(obs.agg(F.count("*").alias("cells"), F.lit(0.5).alias("share")), str(tmp_path / "stats"))
    assert pairs(spark.read.text(str(tmp_path / "stats"))) == [("cells 3",), ("share 0.5",)]
    files.write_table(obs, str(tmp_path / "table"), ["cell"])
    assert spark.read.csv(str(tmp_path / "table"), sep="\t", header=True).count() == 3
    assert files.coexpression_lines(spark.createDataFrame([("a", "b", 3), ("a", None, 1)], "feature_i string, feature_j string, total bigint"), ["a", "b"]).first()[1:] == (1, 0, 3)


def test_fastq_pairs(spark, tmp_path):
    rec = lambda i, s: f"@r{i}\n{s}\n+\nIIII\n"
    r1 = put(tmp_path / "s_L001_R1_001.fastq.gz", rec(1, "AAAA") + rec(2, "CCCC"), zipped=True)
    r2 = put(tmp_path / "s_L001_R2_001.fastq.gz", rec(1, "GGGG") + rec(2, "TTTT"), zipped=True)
    assert pairs(reads.fastq_pairs(spark, r1, r2).select("rec", "r1_seq", "r2_seq")) == [(0, "AAAA", "GGGG"), (1, "CCCC", "TTTT")]
    with pytest.raises(Exception, match="incomplete"):
        reads.fastq(spark, put(tmp_path / "bad.fastq", rec(1, "AAAA") + "@r2\nCC\n")).collect()


def test_annotation_files(spark, tmp_path):
    line = lambda chrom, kind, gene, extra: f'{chrom}\tX\t{kind}\t1\t2\t.\t+\t.\tgene_id "{gene}"; transcript_id "ENST1.3"; gene_type "lncRNA"; transcript_type "lncRNA"{extra}\n'
    p = put(tmp_path / "a.gtf", "# head\n" + line("chr1", "transcript", "ENSG1.2", "") + line("chr1", "exon", "ENSG1.2", "") + line("chrY", "transcript", "ENSG2.1", '; tag "PAR"') + line("chr1", "transcript", "ENSG3.1", '; tag "readthrough_transcript"'))
    got = annotation.filtered_gtf(reads.gtf(spark, p)).orderBy("line").collect()
    assert [r["line"] for r in got] == [0, 1, 2] and 'gene_id "ENSG1"; gene_version "2"; transcript_id "ENST1"; transcript_version "3"' in got[1]["attributes"]
    assert reads.fasta(spark, put(tmp_path / "a.fa", ">1 x\nACGT\n")).where("header").count() == 1
    sam = put(tmp_path / "a.sam", "@HD\tx\nr1\t0\tchrY\nr2\t0\tchr1\n")
    assert pairs(reads.alignments(spark, sam)) == [("r1", "chrY"), ("r2", "chr1")]
