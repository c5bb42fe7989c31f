"""The registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.llm import bpe, fingerprints, langid, licenses, mixing, passages, phrases, pii, quality, search, sharding, simhash, telephony
from cytoframe.llm.common import checkpoint, fold_of, read


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    named = langid.languages(docs, langid.language_fit(docs))
    return named.select("doc_id", F.coalesce(fold_of("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.quality_fit(docs, read(spark, sf_dir, "labels"))
    scored = quality.quality_scores(docs, model)
    return scored.select("doc_id", F.coalesce(fold_of("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(read(spark, sf_dir, "documents"), ranks_path(), split_pattern())


def op4_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telephony.telephony_digests(read(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    # texts are read once: spans and votes are narrow, and both the fit and the result come from them
    seen = checkpoint(pii.examined(docs).select("doc_id", "base", "cands"))
    model = pii.fit_cells(pii.count_cells(seen))
    every = seen.withColumn("added", pii.accepted(model, F.col("base"), F.col("cands")))
    counts = [F.size(F.expr(f"filter(base, s -> s.kind = '{k}')")).cast("bigint").alias(f"n_{k}") for k in pii.BASE_KINDS]
    extra = F.size("added").cast("bigint").alias("n_added")
    return every.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.concat("base", "added")).alias("spans"), extra)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(read(spark, sf_dir, "documents"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(read(spark, sf_dir, "documents"))


#: Bytes of text in one shard of op8_extendible_shards, at most.
SHARD_BYTES = 1 << 20


def op8_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read(spark, sf_dir, "documents"), SHARD_BYTES)


OP8_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '')), 1, 8))::BIGINT AS h
  FROM documents),
level AS (SELECT unnest(range(0, 33))::INT AS depth),
bucket AS (
  SELECT depth, h >> (32 - depth) AS cell, sum(n_bytes)::BIGINT AS shard_bytes
  FROM (SELECT DISTINCT depth FROM level), d GROUP BY 1, 2),
leaf AS (
  SELECT d.doc_id, d.n_bytes, d.h, min(b.depth)::INT AS depth
  FROM d JOIN level l ON true JOIN bucket b ON b.depth = l.depth AND b.cell = d.h >> (32 - l.depth)
  WHERE b.shard_bytes <= {SHARD_BYTES} GROUP BY ALL)
SELECT l.doc_id, l.n_bytes, substr(lpad(bin(l.h), 32, '0'), 1, l.depth) AS shard, l.depth, b.shard_bytes, false AS over
FROM leaf l JOIN bucket b ON b.depth = l.depth AND b.cell = l.h >> (32 - l.depth)
"""


def op9_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_copies(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language": op1_language,
        "op2_quality": op2_quality,
        "op3_bpe_round_trip": op3_bpe_round_trip,
        "op4_telephony": op4_telephony,
        "op5_pii": op5_pii,
        "op6_fingerprints": op6_fingerprints,
        "op7_passages": op7_passages,
        "op8_extendible_shards": op8_extendible_shards,
        "op9_pivotal_mix": op9_pivotal_mix,
        "op10_simhash": op10_simhash,
        "op11_collocations": op11_collocations,
        "op12_licenses": op12_licenses,
        "op13_ranked_search": op13_ranked_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_extendible_shards": OP8_SQL, "op11_collocations": phrases.PHRASE_SQL, "op12_licenses": licenses.license_sql(), "op13_ranked_search": search.SEARCH_SQL}
