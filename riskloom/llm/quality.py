"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a self-contained expression over ``text``.  Cost and rejection of
each are measured on a sample, and the rules become one CASE expression in the
order of rejection per cost: a document that one rule rejects is never shown to
the later ones.  The order changes what is computed, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import texts
from riskloom.sources.storage import materialize

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 1000


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, though used several times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """Words; the split leaves an empty string where white space opens or ends a text."""
    return _bind(F.split(text, SPACES), _without_empty)


def _without_empty(parts: Column) -> Column:
    return F.when((F.get(parts, F.lit(0)) == "") | (F.element_at(parts, -1) == ""),
                  F.array_remove(parts, "")).otherwise(parts)


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def word_chars(text: Column) -> Column:
    return F.length(F.array_join(words(text), "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("bigint")


def n_capitals(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("bigint")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")


def n_dup_lines(text: Column) -> Column:
    return _bind(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def _windows(w: Column) -> Column:
    """Hashes of all three-word windows, 64 bits each."""
    n = F.greatest(F.size(w) - 2, F.lit(0))
    pairs = F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.xxhash64(a, b))
    return F.zip_with(pairs, F.slice(w, 3, n), lambda a, b: F.xxhash64(a, b))


def _placed(hashes: Column) -> Column:
    """(hash, place) in order, or null if all hashes differ."""
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))


def _covered(placed: Column) -> Column:
    """Words in the windows whose hash a neighbour in ``placed`` shares."""
    twice = F.filter(placed, lambda x, k: (F.get(placed, k - 1)["h"] == x["h"])
                     | (F.get(placed, k + 1)["h"] == x["h"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total"))
    return F.coalesce(F.aggregate(
        F.sort_array(F.transform(twice, lambda x: x["i"])), start,
        lambda a, i: F.struct(i.alias("last"),
                              (a["total"] + F.least(F.lit(3), i - a["last"])).alias("total")),
        lambda a: a["total"]), F.lit(0)).cast("bigint")


def n_repeat_words(text: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text.

    Texts whose windows all differ are done after one hash set; the others sort
    (hash, place), keep the places with an equal neighbour, and add up what
    each window covers anew.
    """
    return _bind(words(text), lambda w: _bind(_windows(w), lambda h: _bind(_placed(h), _covered)))


MEASURES = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
            "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words,
            "n_capitals": n_capitals}


@dataclass(frozen=True)
class Rule:
    """Rejects where ``test`` of the measures named in ``needs`` holds."""

    name: str
    needs: tuple[str, ...]
    test: Callable[..., Column]

    def rejects(self, docs: DataFrame) -> Column:
        """The test over ``docs``: measures it has as columns, others from the text."""
        found = [F.col(m) if m in docs.columns else MEASURES[m](F.col("text")) for m in self.needs]
        if all(m in docs.columns for m in self.needs):
            return self.test(*found)
        row = F.struct(*[c.alias(m) for c, m in zip(found, self.needs)])
        return _bind(row, lambda r: self.test(*[r[m] for m in self.needs]))


BASE_RULES = [
    Rule("too_few_words", ("n_words",), lambda n: n < 50),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 50 * n),
]
RULES = [
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 15 * n)),
    Rule("capitals", ("n_capitals", "word_chars"), lambda u, c: 100 * u > 40 * c),
    Rule("repeated_lines", ("n_dup_lines", "n_words"), lambda d, n: 10 * d > n),
]


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base measures of every whole text.

    The measures that need the words share them: word list, window hashes and
    sorted places are columns of their own, each computed once by compiled code.
    """
    text, w = F.col("text"), F.col("_words")
    return (docs.withColumn("_split", F.split(text, SPACES))
            .withColumn("_words", _without_empty(F.col("_split")))
            .withColumn("_hashes", _windows(w))
            .withColumn("_placed", _placed(F.col("_hashes")))
            .withColumns({"n_words": F.size(w).cast("bigint"),
                          "word_chars": F.length(F.array_join(w, "")).cast("bigint"),
                          "n_symbols": n_symbols(text), "n_dup_lines": n_dup_lines(text),
                          "n_repeat_words": _covered(F.col("_placed"))})
            .drop("_split", "_words", "_hashes", "_placed"))


def order_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by falling rejection per cost, both estimated on a sample.

    The sample is stored once and has about ``sample_rows`` rows, drawn by hash
    of the text from all of ``docs``.  Each rule is timed on it on its own; the
    best of two runs counts.  On an empty sample the given order stays.
    """
    total = docs.count()
    if not total:
        return list(rules)
    share = min(1.0, sample_rows / total)
    sample = materialize(docs.select("text").sample(share, seed=17).repartition(1))
    gain = {}
    for rule in rules:
        best, rejected = float("inf"), 0
        for _ in range(2):
            begun = time.perf_counter()
            rejected = sample.agg(F.count_if(rule.rejects(sample))).first()[0]
            best = min(best, time.perf_counter() - begun)
        gain[rule.name] = rejected / best
    return sorted(rules, key=lambda rule: -gain[rule.name])


def cascade(docs: DataFrame, ordered: list[Rule]) -> Column:
    """The name of the first rule in ``ordered`` that rejects, null if none does."""
    result = F.lit(None).cast("string")
    for rule in reversed(ordered):
        result = F.when(rule.rejects(docs), F.lit(rule.name)).otherwise(result)
    return result


def judge(docs: DataFrame, ordered: list[Rule]) -> DataFrame:
    """Base measures, ``base_failed``, ``rejected_by`` and ``kept`` per row.

    A null text counts as empty and fails the base rule on words.  Every row is
    judged on its own, so repeated rows get equal results and an empty table
    gives none.  Columns other than ``doc_id`` and ``text`` are ignored.  The
    rules of ``ordered`` only see documents that the base rules let pass.
    """
    found = measured(texts(docs))
    few, repeated = (rule.rejects(found) for rule in BASE_RULES)
    found = found.withColumn("base_failed", few | repeated)
    found = found.withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base"))
                             .otherwise(cascade(found, ordered)))
    return found.withColumn("kept", F.col("rejected_by").isNull())


def keep_good(docs: DataFrame, ordered: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns as they were."""
    text = texts(docs.select("doc_id", "text"))
    first = cascade(text, ordered)
    whole = docs.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    return whole.where(first.isNull())
