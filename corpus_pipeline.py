"""The corpus pipeline: quality rules, near-dedup, decontamination, secrets, tokens. Each stage takes what the last kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of ``documents``; rejected rows go,
and secrets are replaced in the texts. Rows with null texts or ids go through each stage by that operator's rules: the
quality rules reject texts without words, so they end there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilematch.llm import bpe, decontaminate, near_dedup, quality_rules, secrets
from profilematch.llm.common import read_table, stored

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fences of their language and source."""
    return quality_rules.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that with the least doc_id."""
    return near_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by the kind of secret."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, and the token ids of the text."""
    import public_tokenizers

    out = bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(TOKENIZER))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("bpe_encoding", tokens),
]

#: Near-duplicates and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
