"""One query for each operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import (bpe, conversations, decontamination, language, ngram_join, oracles, packing, paragraphs,
                         quality, rendering, secrets, sketches, suffixes, vectors)
from riskloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function
    return add


@query("op4_quality_cascade", oracles.QUALITY)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    judged = quality.judge(docs, quality.order_rules(docs, quality.RULES))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def repository_and_owner() -> tuple:
    """A source counts as an owner, its documents in one language as a repository."""
    return F.concat_ws("/", "source", "lang"), F.col("source")


@query("op7_secret_ownership", oracles.SECRETS)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return secrets.span_digests(docs, secrets.find_secrets(docs, *repository_and_owner()))


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    definition = bpe.tokenizer_of_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                        public_tokenizers.PATTERN)
    return bpe.round_trip(table(spark, sf, "documents"), definition, public_tokenizers.PATTERN)


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    definition = bpe.tokenizer_of_file(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(table(spark, sf, "documents"), definition, public_tokenizers.PATTERN)


@query("op10_ngram_partenum")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf, "documents"))


@query("op5_paragraph_minhash")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return paragraphs.digests(table(spark, sf, "documents"), unwrap=True)


@query("op2_bucket_pointer_dedup")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    kept = suffixes.remove_repeats(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op1_paragraph_iblt")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return sketches.compare_versions(table(spark, sf, "documents"))


@query("op6_language_fusion")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and pages together; the labelled rows are the documents."""
    docs, pages = table(spark, sf, "documents"), table(spark, sf, "pages")
    rows = language.document_rows(docs).unionByName(language.page_rows(pages))
    return language.identify(rows, docs.select("text", "lang"))


@query("op8_page_layout")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return rendering.extract(table(spark, sf, "pages"))


@query("op11_checkpointed_repair", oracles.CONVERSATIONS)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    damaged = conversations.damage(table(spark, sf, "conversations"))
    return conversations.report(conversations.repair(damaged))


@query("op12_limb_split_codes", oracles.CODES)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.report(*vectors.compress(table(spark, sf, "embeddings")))


@query("op13_fm_index_decontamination", oracles.LEAKS)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    leaks = decontamination.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return decontamination.report(leaks)
