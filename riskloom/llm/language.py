"""Language of texts by fusing evidence after Bayes.

The text gives a likelihood per language from byte trigrams, the markup may
declare a language, the address has a suffix, and the host has a prior that is
smoothed towards its domain, the domain towards all rows.  What suffixes, hosts
and declarations tell is counted over the whole input by grouped aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import map_batches, small_side
from riskloom.sources.storage import materialize

BINS = 1 << 14
TEMPER = 1 / 3  # a byte is part of three trigrams
SMOOTHING = 5.0
HIDDEN_MARKUP = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
DECLARED = r"""(?i)<html[^>]*?\blang\s*=\s*["']?([a-z]{2,3})"""


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bin of the trigram at every byte of all texts in a row, and where each text starts.

    The two trigrams that would reach into the next text are in bin ``BINS``, which counts for nothing.
    """
    parts = [t.encode().lower() + b"   " for t in texts]
    starts = np.cumsum([0] + [len(p) for p in parts])[:-1]
    data = np.frombuffer(b"".join(parts) + b"  ", np.uint8).astype(np.uint32)
    code = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    bins = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)
    for back in (1, 2):
        bins[np.r_[starts[1:], len(bins)] - back] = BINS
    return bins, starts


def fit(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and log probabilities (language, bin) from all rows (text, lang).

    Every task sums its own rows first.  The model that comes to the driver has
    ``BINS`` numbers for each language, whatever the input.
    """
    def count(batches: Iterator[dict]) -> Iterator[dict]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            bins, starts = trigrams(batch["text"])
            ends = np.r_[starts[1:], len(bins)]
            for lang in set(batch["lang"]):
                own = [bins[a:b] for a, b, x in zip(starts, ends, batch["lang"]) if x == lang]
                totals[lang] = totals.get(lang, 0) + np.bincount(np.concatenate(own), minlength=BINS + 1)[:BINS]
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            yield {"lang": [lang] * len(at), "bin": at, "n": counts[at]}

    rows = labelled.where("lang is not null and text is not null").select("lang", "text")
    counted = map_batches(rows, count, "lang string, bin bigint, n bigint", streaming=True)
    table = counted.groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["lang"].unique())
    counts = np.ones((len(languages), BINS))
    counts[[languages.index(x) for x in table["lang"]], table["bin"].to_numpy(int)] += table["n"].to_numpy(float)
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def text_scores(rows: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """``rows`` without ``text``, with ``scores`` per language, the best having zero, and ``text_lang``.

    An empty text scores all languages alike and has no ``text_lang``.
    """
    shared = rows.sparkSession.sparkContext.broadcast(np.pad(model, ((0, 0), (0, 1))))
    others = [(n, t) for n, t in rows.dtypes if n != "text"]

    def run(batch):
        bins, starts = trigrams(batch["text"])
        sums = np.stack([np.add.reduceat(m[bins], starts, dtype=np.float64) for m in shared.value], axis=1)
        empty = np.array([not t.strip() for t in batch["text"]])
        scores = np.where(empty[:, None], 0.0, TEMPER * (sums - sums.max(axis=1, keepdims=True)))
        made = {n: batch[n] for n, _ in others}
        yield made | {"scores": list(scores), "text_lang": [None if e else languages[i]
                                                            for e, i in zip(empty, scores.argmax(axis=1))]}

    schema = ", ".join(f"{n} {t}" for n, t in others) + ", scores array<double>, text_lang string"
    return map_batches(rows, run, schema)


def _counts(rows: DataFrame, key: str, languages: list[str]) -> DataFrame:
    """(key, counts by language), with partial aggregation; rows without key are left out."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.array(*[F.count_if(F.col("text_lang") == x).cast("double") for x in languages]).alias(f"{key}_counts"))


def fuse(scored: DataFrame, languages: list[str]) -> DataFrame:
    """``scored`` with ``lang`` and ``probability``.

    ``scored`` has scores, text_lang, declared, suffix, host and domain.  A row
    never counts in its own host, domain and suffix statistics.  Missing
    evidence says nothing; ties go to the first language by name.
    """
    n = len(languages)
    totals = scored.agg(*[F.count_if(F.col("text_lang") == x) for x in languages]).first()
    share = [(t + 1) / (sum(totals) + n) for t in totals]
    joined = scored
    for key in ("host", "domain", "suffix", "declared"):
        joined = joined.join(small_side(_counts(scored, key, languages)), key, "left")

    def others(key: str, i: int) -> Column:
        """Count of other rows with this key and language."""
        own = F.when(F.col("text_lang") == languages[i], 1.0).otherwise(0.0)
        return F.greatest(F.coalesce(F.get(f"{key}_counts", F.lit(i)) - own, F.lit(0.0)), F.lit(0.0))

    def smoothed(key: str, towards: list[Column]) -> list[Column]:
        total = sum((others(key, i) for i in range(1, n)), others(key, 0))
        return [(others(key, i) + SMOOTHING * towards[i]) / (total + SMOOTHING) for i in range(n)]

    general = [F.lit(s) for s in share]
    host = smoothed("host", smoothed("domain", general))
    suffix, declared = smoothed("suffix", general), smoothed("declared", general)
    # each likelihood is the posterior given that evidence alone, over the share of the language
    score = F.array(*[F.get("scores", F.lit(i)) + F.log(host[i]) + F.log(suffix[i] / share[i])
                      + F.log(declared[i] / share[i]) for i in range(n)])
    best = F.array_max("_score")
    kept = [c for c in scored.columns if c != "scores"]
    return (joined.withColumn("_score", score)
            .withColumn("lang", F.element_at(F.array(*[F.lit(x) for x in languages]),
                                             F.array_position("_score", best).cast("int")))
            .withColumn("probability", F.round(1 / F.aggregate(
                F.transform("_score", lambda s: F.exp(s - best)), F.lit(0.0), lambda a, s: a + s), 9))
            .select(*kept, "lang", "probability"))


def page_rows(pages: DataFrame) -> DataFrame:
    """(doc_id, page_id, text, declared, suffix, host, domain) of pages; null markup is empty."""
    source = F.coalesce("html", F.lit(""))
    host = F.lower(F.try_parse_url("url", F.lit("HOST")))
    found = F.lower(F.regexp_extract(source, DECLARED, 1))
    labels = F.split("host", r"\.")
    return (pages.select(F.lit(None).cast("bigint").alias("doc_id"), F.col("page_id").cast("bigint").alias("page_id"),
                         F.regexp_replace(source, HIDDEN_MARKUP, " ").alias("text"),
                         F.when(found != "", found).alias("declared"), host.alias("host"))
            .withColumn("suffix", F.element_at(labels, -1))
            .withColumn("domain", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."))
            .withColumn("domain", F.when(F.col("host").isNotNull(), F.col("domain"))))


def document_rows(docs: DataFrame) -> DataFrame:
    """The same of documents: their source is the host, nothing else is known of them."""
    none = F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("page_id"),
                       F.coalesce("text", F.lit("")).alias("text"), none.alias("declared"),
                       F.col("source").alias("host"), none.alias("suffix"), none.alias("domain"))


def identify(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Language of every row, also repeated ones, by a model fitted on ``labelled`` (text, lang).

    Without labelled rows there are no languages, and ``lang`` and
    ``probability`` are null.
    """
    languages, model = fit(labelled)
    if not languages:
        return rows.drop("text").withColumns({"text_lang": F.lit(None).cast("string"),
                                              "lang": F.lit(None).cast("string"),
                                              "probability": F.lit(None).cast("double")})
    return fuse(materialize(text_scores(rows, languages, model)), languages)
