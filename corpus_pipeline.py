"""The corpus pipeline: five stages, each calling one operator; what one writes is the next one's input.

1. quality: documents that the compression classifier rejects go.
2. near duplicates: one document of each SimHash component stays.
3. personal data: every span of a text is replaced by its kind.
4. mixing: each document is repeated as often as its source's target weight asks; documents with no copy go.
5. tokens: texts become byte-level BPE ids.

All but the last return the columns of documents. Null or empty texts pass the stages as any text does: they are scored,
count as near duplicates of each other, hold no spans, have size 0 (hence no copy) and would have no ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cytoframe.llm import bpe, mixing, pii, quality, simhash
from cytoframe.llm.common import read, shared_dir
from cytoframe.llm.queries import ranks_path, split_pattern


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score the quality threshold or more."""
    model = quality.quality_fit(docs, read(spark, sf_dir, "labels"))
    return quality.accepted_documents(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced, n_chars renewed."""
    return pii.redacted_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their copies."""
    return mixing.mixed_documents(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row."""
    return bpe.bpe_tokens(docs, ranks_path(), split_pattern())


STAGES = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii_redaction", redact_personal_data),
    ("pivotal_mixing", mix_sources),
    ("bpe_encoding", to_tokens),
]

#: Dictionaries, fingerprints and seeded draws are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each writes Parquet to the shared folder and the next reads it again."""
    home = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = f"{home}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
