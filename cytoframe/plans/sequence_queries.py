"""Sequences, barcodes, reads, names and annotations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.functions import names, sequences
from cytoframe.operators import annotation, matching
from cytoframe.plans import proxies as P
from cytoframe.plans.proxies import DNA, HEX
from cytoframe.plans.registry import query


def _sql_dna(key: str, length: int, start: int = 1) -> str:
    return f"translate(substr(md5(({key})::VARCHAR), {start}, {length}), '{HEX}', '{DNA}')"


READS = f"reads AS (SELECT event_id AS read_id, {_sql_dna('event_id', 24)} AS read FROM events)"


def _sql_feats(length: int = 10) -> str:
    return f"feats AS (SELECT 'F' || min(k) AS feature, sequence FROM (SELECT p_partkey AS k, {_sql_dna('p_partkey', length)} AS sequence FROM part) GROUP BY sequence)"


def _sql_near(distance: int, starts: str, name: str = "near") -> str:
    """Windows of ten letters within the distance of a feature: one of distance + 1 pieces is equal in both."""
    edges = [i * 10 // (distance + 1) for i in range(distance + 2)]
    met = " UNION ".join(
        f"SELECT read_id, p, feature, hamming(w, sequence)::INT AS distance FROM {name}_w JOIN feats ON substr(w, {a + 1}, {b - a}) = substr(sequence, {a + 1}, {b - a}) WHERE hamming(w, sequence) <= {distance}"
        for a, b in zip(edges, edges[1:])
    )
    return f"{name}_w AS (SELECT read_id, i AS p, substr(read, i, 10) AS w FROM reads, {starts} t(i)), {name} AS ({met})"


def _sql_alone(source: str) -> str:
    """The nearest feature of each read at its first place, where it is the only one."""
    return f"""SELECT read_id, feature, distance, place FROM (SELECT *, count(*) OVER (PARTITION BY read_id) AS k FROM
(SELECT *, min(distance) OVER (PARTITION BY read_id) AS m FROM (SELECT read_id, feature, min(distance) AS distance, arg_min(p, (distance, p))::INT AS place FROM {source} GROUP BY 1, 2)) WHERE distance = m) WHERE k = 1"""


def feats(spark, d, length=10):
    """Every row of part as a feature; of those with one sequence the least key names it."""
    keyed = P.table(spark, d, "part").select("p_partkey", P.dna(F.col("p_partkey"), length).alias("sequence"))
    return keyed.groupBy("sequence").agg(F.min("p_partkey").alias("k")).select(F.concat(F.lit("F"), F.col("k").cast("string")).alias("feature"), "sequence")


def reads(spark, d):
    return P.table(spark, d, "events").select(F.col("event_id").alias("read_id"), P.dna(F.col("event_id"), 24).alias("read"))


@query(f"""WITH s AS (SELECT p_partkey AS k, {_sql_dna('p_partkey', 12)} AS a, {_sql_dna('p_partkey + 1', 12)} AS b FROM part) SELECT k, hamming(a, b)::INT AS distance, hamming(a, b)::INT AS packed_distance FROM s""")
def hamming_distance(spark, d):
    rows = P.table(spark, d, "part").select(F.col("p_partkey").alias("k"), P.dna(F.col("p_partkey"), 12).alias("a"), P.dna(F.col("p_partkey") + 1, 12).alias("b"))
    return rows.select("k", sequences.hamming(F.col("a"), F.col("b")).alias("distance"), sequences.packed_hamming(sequences.packed(F.col("a")), sequences.packed(F.col("b"))).alias("packed_distance"))


PAIRS = f"WITH {READS}, {_sql_feats()}, {_sql_near(2, 'range(1, 16)')} {_sql_alone('near')}"
AT_PLACE = f"WITH {READS}, {_sql_feats()}, {_sql_near(3, 'range(3, 4)')} {_sql_alone('near')}"
ANYWHERE = f"""WITH {READS}, {_sql_feats()}, {_sql_near(3, 'range(3, 4)', 'near')}, {_sql_near(3, 'range(1, 16)', 'far')},
u AS (SELECT *, 0 AS rank FROM ({_sql_alone('near')}) UNION ALL SELECT *, 1 FROM ({_sql_alone('far')}))
SELECT read_id, feature, distance, place FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY distance, rank) AS r FROM u) WHERE r = 1"""
CONTAINED = f"WITH {READS}, {_sql_feats(4)} SELECT DISTINCT read_id, feature FROM (SELECT read_id, substr(read, i, 4) AS w FROM reads, range(1, 22) t(i)) JOIN feats ON w = sequence"


# each under the name that it had before it took all features, too
@query(PAIRS, name="hamming_pairs_all")
@query(PAIRS)
def hamming_pairs(spark, d):
    return matching.match_features(reads(spark, d), feats(spark, d), 2)


@query(AT_PLACE, name="match_at_place_all")
@query(AT_PLACE)
def match_at_place(spark, d):
    return matching.match_at(reads(spark, d), feats(spark, d), 3, 3)


@query(ANYWHERE, name="match_reads_all")
@query(ANYWHERE)
def match_reads(spark, d):
    return matching.match_reads(reads(spark, d), feats(spark, d), 3, 3)


@query(CONTAINED, name="contained_features_all")
@query(CONTAINED)
def contained_features(spark, d):
    return matching.contained_features(reads(spark, d), feats(spark, d, 4))


@query(f"SELECT '@e' || event_id AS name, {_sql_dna('event_id', 16)} AS r1_seq, {_sql_dna('event_id', 24)} AS r2_seq FROM events")
def fastq_pairs(spark, d):
    """The events' reads, written as a pair of FASTQ folders and read again in lock step."""
    import uuid

    from cytoframe.operators.components import saved
    from cytoframe.sources.reads import fastq_pairs as read_pairs

    key = F.col("event_id")
    rows = saved(P.table(spark, d, "events").select(F.concat(F.lit("@e"), key.cast("string")).alias("name"), P.dna(key, 16).alias("one"), P.dna(key, 24).alias("two")))
    home = f"{spark.sparkContext.getCheckpointDir()}/fastq-{uuid.uuid4().hex}"
    for mate in ("one", "two"):
        rows.select(F.concat_ws("\n", "name", mate, F.lit("+"), F.repeat(F.lit("I"), F.length(mate))).alias("value")).write.text(f"{home}/{mate}")
    return read_pairs(spark, f"{home}/one", f"{home}/two").select(F.col("r1_name").alias("name"), "r1_seq", "r2_seq")


BAR = f"white AS (SELECT DISTINCT {_sql_dna('p_partkey', 8)} AS barcode FROM part), rb AS (SELECT o_orderkey AS read_id, CASE WHEN o_orderkey % 13 = 0 THEN 'N' || substr({_sql_dna('o_orderkey', 8)}, 2) ELSE {_sql_dna('o_orderkey', 8)} END AS barcode FROM orders)"
CAND = BAR + """, db AS (SELECT DISTINCT barcode FROM rb), ex AS (SELECT barcode FROM db WHERE barcode IN (SELECT barcode FROM white)),
hit AS (SELECT db.barcode, w.barcode AS cand FROM db, white w WHERE db.barcode NOT IN (SELECT barcode FROM ex) AND hamming(db.barcode, w.barcode) = 1 AND (NOT contains(db.barcode, 'N') OR substr(db.barcode, 2) = substr(w.barcode, 2))),
c AS (SELECT barcode, list(cand ORDER BY cand) AS candidates, count(*) AS k FROM hit GROUP BY 1)"""


def whitelist(spark, d):
    return P.table(spark, d, "part").select(P.dna(F.col("p_partkey"), 8).alias("barcode")).distinct()


def barcode_reads(spark, d):
    seq = P.dna(F.col("o_orderkey"), 8)
    return P.table(spark, d, "orders").select(F.col("o_orderkey").alias("read_id"), F.when(F.col("o_orderkey") % 13 == 0, F.concat(F.lit("N"), F.substring(seq, 2, 7))).otherwise(seq).alias("barcode"))


@query(f"""WITH {CAND} SELECT read_id, rb.barcode, CASE WHEN rb.barcode IN (SELECT barcode FROM ex) THEN 'exact' WHEN k = 1 THEN 'corrected' WHEN k <= 3 AND NOT contains(rb.barcode, 'N') THEN 'deferred' ELSE 'rejected' END AS state,
CASE WHEN rb.barcode IN (SELECT barcode FROM ex) THEN rb.barcode WHEN k = 1 THEN candidates[1] END AS corrected, CASE WHEN k BETWEEN 2 AND 3 AND NOT contains(rb.barcode, 'N') THEN array_to_string(candidates, ',') END AS candidates FROM rb LEFT JOIN c USING (barcode)""")
def barcode_correct(spark, d):
    return matching.correct_barcodes(barcode_reads(spark, d), whitelist(spark, d)).withColumn("candidates", F.array_join("candidates", ","))


@query(f"""WITH {CAND}, seen AS (SELECT barcode, count(*) AS n FROM rb WHERE barcode IN (SELECT barcode FROM ex) GROUP BY 1), qual AS (SELECT o_orderkey AS read_id, repeat(chr((40 + o_orderkey % 30)::INT), 8) AS qual FROM orders),
e AS (SELECT read_id, barcode, unnest(candidates) AS cand FROM rb JOIN c USING (barcode) WHERE k BETWEEN 2 AND 3 AND NOT contains(barcode, 'N')),
w AS (SELECT e.*, (1 + coalesce(n, 0)) * pow(10.0, -(ascii(qual[1]) - 33) / 10.0) AS w FROM e JOIN qual USING (read_id) LEFT JOIN seen ON seen.barcode = cand),
s AS (SELECT *, w / sum(w) OVER (PARTITION BY read_id) AS share FROM w) SELECT read_id, cand AS corrected, round(share, 6) AS share FROM s WHERE share > 0.65""")
def posterior_barcode(spark, d):
    found = matching.correct_barcodes(barcode_reads(spark, d), whitelist(spark, d))
    seen = found.where("state = 'exact'").groupBy("barcode").agg(F.count("*").alias("n"))
    deferred = found.where("state = 'deferred'").withColumn("qual", F.repeat(F.char(40 + F.col("read_id") % 30), 8))
    return matching.resolve_deferred(deferred, seen, 0.65).withColumn("share", F.round("share", 6))


@query(f"""WITH s AS (SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 'N' || substr(d, 2, 4) || 'N' ELSE d END AS seq FROM (SELECT p_partkey, {_sql_dna('p_partkey', 6)} AS d FROM part)), b AS (SELECT unnest(['A', 'C', 'G', 'T']) AS b)
SELECT k, x.b || substr(seq, 2, 4) || y.b AS expanded FROM s, b x, b y WHERE k % 3 = 0 UNION ALL SELECT k, seq FROM s WHERE k % 3 <> 0""")
def n_expand(spark, d):
    seq = P.dna(F.col("p_partkey"), 6)
    mixed = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("N"), F.substring(seq, 2, 4), F.lit("N"))).otherwise(seq)
    return P.table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.explode(sequences.expand_n(mixed, 2)).alias("expanded"))


@query(f"""WITH s AS (SELECT p_partkey AS k, {_sql_dna('p_partkey', 6)} AS seq FROM part), b AS (SELECT unnest(['A', 'C', 'G', 'T']) AS b)
SELECT k, substr(seq, 1, i - 1) || b || substr(seq, i + 1) AS neighbour FROM s, range(1, 7) t(i), b WHERE substr(seq, i, 1) <> b""")
def one_base_neighbours(spark, d):
    return P.table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.explode(sequences.neighbours(P.dna(F.col("p_partkey"), 6))).alias("neighbour"))


@query(f"SELECT o_orderkey AS read_id FROM orders WHERE o_orderkey % 13 <> 0 AND length(o_orderpriority) >= 6")
def read_quality(spark, d):
    rows = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("read_id"), F.when(F.col("o_orderkey") % 13 == 0, "ACGN").otherwise("ACGT").alias("umi"), F.col("o_orderpriority").alias("r1_seq"))
    return matching.read_quality(rows, 6).select("read_id")


@query("WITH y AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'A') SELECT o_orderkey AS qname, o_orderkey IN (SELECT l_orderkey FROM y) AS listed FROM orders")
def split_reads(spark, d):
    aligned = P.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("qname"), F.concat("l_linestatus", "l_returnflag").alias("rname"))
    return matching.split_reads(P.table(spark, d, "orders").select(F.col("o_orderkey").alias("qname")), matching.names_on_chromosome(aligned, "OA"))


@query("SELECT l_orderkey AS qname, l_linenumber AS k FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'A')")
def anti_reads(spark, d):
    li = P.table(spark, d, "lineitem")
    aligned = li.select(F.col("l_orderkey").alias("qname"), F.concat("l_linestatus", "l_returnflag").alias("rname"))
    rows = li.select(F.col("l_orderkey").alias("qname"), F.col("l_linenumber").alias("k"))
    return rows.join(matching.names_on_chromosome(aligned, "OA"), "qname", "left_anti")


@query("""SELECT p_partkey AS k, 'ENSG' || p_partkey AS gene, CASE WHEN p_partkey % 4 = 0 THEN 'plain' || p_partkey ELSE 'BC' || p_partkey END AS barcode, 's' || (p_partkey % 5) AS sample, 'read:' || p_partkey AS read_name,
CASE p_partkey % 3 WHEN 0 THEN '>chr' || (p_partkey % 22) || ' ' || (p_partkey % 22) WHEN 1 THEN '>chrM MT' ELSE '>GL' || p_partkey || ' GL' || p_partkey END AS header FROM part""")
def name_parse(spark, d):
    k = F.col("p_partkey").cast("string")
    put = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in p])
    bc = F.when(F.col("p_partkey") % 4 == 0, put("plain", k)).otherwise(put("s1_x_BC", k, "-1"))
    five = (F.col("p_partkey") % 5).cast("string")
    fq = F.when(F.col("p_partkey") % 2 == 0, put("s", five, "_L001_R1_001.fastq.gz")).otherwise(put("s", five, "_R1_001.fastq"))
    chrom = F.when(F.col("p_partkey") % 3 == 0, put(">", (F.col("p_partkey") % 22).cast("string"), " dna")).when(F.col("p_partkey") % 3 == 1, F.lit(">MT dna")).otherwise(put(">GL", k, " dna"))
    return P.table(spark, d, "part").select(
        F.col("p_partkey").alias("k"), names.strip_version(put("ENSG", k, ".7.1")).alias("gene"), names.core_barcode(bc).alias("barcode"), names.sample_of_fastq(fq).alias("sample"),
        names.short_read_name(put("@read:", k, "/1 more")).alias("read_name"), names.chromosome_header(chrom).alias("header"),
    )


@query("""WITH t AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 9 = 0 THEN 'chrY' ELSE 'chr1' END AS seqname, CASE p_partkey % 2 WHEN 0 THEN 'transcript' ELSE 'exon' END AS feature, p_partkey // 2 AS g,
 CASE WHEN p_partkey // 2 % 3 = 0 THEN 'lncRNA' ELSE 'miRNA' END AS kind, p_partkey % 7 = 0 AS rt, p_partkey % 9 = 0 AS par FROM part),
ok AS (SELECT DISTINCT g FROM t WHERE feature = 'transcript' AND kind = 'lncRNA' AND NOT rt AND NOT par)
SELECT k, 'gene_id "ENSG' || g || '"; gene_version "2"; gene_type "' || kind || '"; transcript_type "' || kind || '"' || CASE WHEN rt THEN '; tag "readthrough_transcript"' ELSE '' END || CASE WHEN par THEN '; tag "PAR"' ELSE '' END AS attributes
FROM t WHERE g IN (SELECT g FROM ok) AND NOT (seqname = 'chrY' AND par)""")
def gtf_filter(spark, d):
    k = F.col("p_partkey")
    g = F.floor(k / 2)
    kind = F.when(g % 3 == 0, "lncRNA").otherwise("miRNA")
    attr = F.concat(F.lit('gene_id "ENSG'), g.cast("string"), F.lit('.2"; gene_type "'), kind, F.lit('"; transcript_type "'), kind, F.lit('"'), F.when(k % 7 == 0, '; tag "readthrough_transcript"').otherwise(""), F.when(k % 9 == 0, '; tag "PAR"').otherwise(""))
    rows = P.table(spark, d, "part").select(k.alias("k"), F.when(k % 9 == 0, "chrY").otherwise("chr1").alias("seqname"), F.when(k % 2 == 0, "transcript").otherwise("exon").alias("feature"), attr.alias("attributes"))
    return annotation.filtered_gtf(rows).select("k", "attributes")
