"""The training-data pipeline over ``documents``, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents,
the last one the packed pieces.  Null texts become empty; the stages after the
first leave out rows without ``doc_id`` and take rows that repeat one as one
document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import bpe, ngram_join, packing, paragraphs, quality, secrets
from riskloom.llm.common import DOCUMENT_COLUMNS, table
from riskloom.llm.queries import repository_and_owner
from riskloom.sources.storage import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects; the base rules take part in the ordering."""
    ordered = quality.order_rules(docs, quality.BASE_RULES + quality.RULES)
    return quality.keep_good(docs.select(*DOCUMENT_COLUMNS), ordered)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the least id."""
    return ngram_join.keep_one(docs, "lang", "source", "n_chars").select(*DOCUMENT_COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the paragraphs and passages that an earlier one has; ``n_chars`` follows."""
    cleaned = paragraphs.cleaned(docs, "lang", "source", unwrap=True)
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint")).select(*DOCUMENT_COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, values taken for live credentials replaced by a mark."""
    return secrets.redact_live(docs.select(*DOCUMENT_COLUMNS), *repository_and_owner())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    definition = bpe.tokenizer_of_file(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(docs, definition, public_tokenizers.PATTERN)


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates),
          ("substring dedup", substrings), ("secret scan", secret_scan), ("packing", pack)]

# Shingle components, MinHash bands and byte-level BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
