"""Measures that need loans in order of predicted risk.

A global sort window would put the whole population into one task.  Here loans
are first counted per distinct probability (a tick), which also folds any hot
probability into one row.  Running totals over ticks are then built level by
level: totals per cell of width 10^-3, and inside such a cell, if
probabilities are not rounded, totals per cell of width 10^-6.  No window
holds more than the ticks of one finest cell or a thousand cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom.functions.numeric import dround
from riskloom.sources.storage import materialize

CELL_COUNTS = (1_000, 1_000_000)
ROUNDED_DIGITS = 6


def long_scores(scored: DataFrame, models: dict[str, str], keep: list[str] = ()) -> DataFrame:
    """One row per loan and model: (model, prob, is_bad, kept columns)."""
    named = scored.select("is_bad", *keep, *[F.col(c).alias(m) for m, c in models.items()])
    return named.unpivot(["is_bad", *keep], list(models), "model", "prob")


def ticks(scored: DataFrame, by: list[str] = (), probability: str = "prob",
          digits: int | None = None) -> DataFrame:
    """Bad and good counts per distinct probability; loans without one have no rank and are left out."""
    prob = F.col(probability)
    prob = prob if digits is None else F.round(prob, digits)
    return (scored.where(F.col(probability).isNotNull()).groupBy(*by, prob.alias("prob"))
            .agg(F.sum("is_bad").cast("bigint").alias("pos"),
                 F.sum(1 - F.col("is_bad")).cast("bigint").alias("neg")))


def _cell(prob: Column, cells: int) -> Column:
    return F.floor(prob * cells)


def _before(name: str, window: W) -> Column:
    return F.coalesce(F.sum(name).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def _totals_before(tick_counts: DataFrame, by: list[str], levels: tuple[int, ...]) -> DataFrame:
    """Per finest cell: counts in all riskier cells and in the whole group."""
    cells = levels[-1]
    sums = (tick_counts.groupBy(*by, _cell(F.col("prob"), cells).alias("cell"))
            .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    if len(levels) == 1:
        group = W.partitionBy(*by) if by else W.partitionBy(F.lit(1))
        order = group.orderBy(F.desc("cell"))
        return sums.select(
            *by, "cell",
            _before("pos", order).alias("pos_before"), _before("neg", order).alias("neg_before"),
            F.sum("pos").over(group).alias("n_pos"), F.sum("neg").over(group).alias("n_neg"))
    middle = sums.select(*by, "pos", "neg", ((F.col("cell") + 0.5) / cells).alias("prob"),
                         F.col("cell").alias("fine"))
    parent = middle.withColumn("cell", _cell(F.col("prob"), levels[-2]))
    above = _totals_before(middle.drop("fine"), by, levels[:-1])
    order = W.partitionBy(*by, "cell").orderBy(F.desc("fine"))
    return parent.join(above, [*by, "cell"]).select(
        *by, F.col("fine").alias("cell"),
        (F.col("pos_before") + _before("pos", order)).alias("pos_before"),
        (F.col("neg_before") + _before("neg", order)).alias("neg_before"),
        "n_pos", "n_neg")


def threshold_table(scored: DataFrame, by: list[str] = (), probability: str = "prob",
                    digits: int | None = None) -> DataFrame:
    """Per distinct probability: counts at it, above it, and in all.

    Columns: ``by``, prob, pos, neg, pos_before, neg_before, n_pos, n_neg, where
    "before" means strictly riskier.  With ``digits`` probabilities are rounded
    first, which bounds the ticks and needs one level of cells only.

    The ticks are computed here and now, as several steps read them: the loans
    are scanned once, whatever is measured on the table afterwards.
    """
    by = list(by)
    levels = CELL_COUNTS[:1] if digits is not None and digits <= ROUNDED_DIGITS else CELL_COUNTS
    return accumulate(materialize(ticks(scored, by, probability, digits)), by, levels)


def accumulate(tick_counts: DataFrame, by: list[str] = (),
               levels: tuple[int, ...] = CELL_COUNTS) -> DataFrame:
    """``threshold_table`` from materialized tick counts."""
    by = list(by)
    above = _totals_before(tick_counts, by, levels)
    if not by and len(levels) == 1:
        above = F.broadcast(above)   # a row per cell: 1001 at most
    placed = tick_counts.withColumn("cell", _cell(F.col("prob"), levels[-1]))
    order = W.partitionBy(*by, "cell").orderBy(F.desc("prob"))
    return placed.join(above, [*by, "cell"]).select(
        *by, "prob", "pos", "neg",
        (F.col("pos_before") + _before("pos", order)).alias("pos_before"),
        (F.col("neg_before") + _before("neg", order)).alias("neg_before"),
        "n_pos", "n_neg")


def _rates() -> tuple[Column, Column]:
    return ((F.col("pos_before") + F.col("pos")) / F.col("n_pos"),
            (F.col("neg_before") + F.col("neg")) / F.col("n_neg"))


def roc_curve(table: DataFrame, by: list[str] = ()) -> DataFrame:
    """Points (threshold, tpr, fpr) at every distinct probability, and the origin.

    The origin has no finite threshold: its threshold is NULL.
    """
    tpr, fpr = _rates()
    points = table.select(*by, F.col("prob").alias("threshold"),
                          tpr.alias("tpr"), fpr.alias("fpr"))
    first = (F.col("pos_before") == 0) & (F.col("neg_before") == 0)
    origin = table.where(first).select(
        *by, F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("tpr"), F.lit(0.0).alias("fpr"))
    return origin.unionByName(points)


def ks_curve(table: DataFrame, by: list[str] = ()) -> DataFrame:
    """Cumulative bad and good shares from the riskiest loan down, and their gap."""
    tpr, fpr = _rates()
    seen = F.col("pos_before") + F.col("pos") + F.col("neg_before") + F.col("neg")
    return table.select(
        *by, "prob", (seen * 100.0 / (F.col("n_pos") + F.col("n_neg"))).alias("pct_pop"),
        tpr.alias("cum_bad"), fpr.alias("cum_good"), (tpr - fpr).alias("ks"))


def argmax_row(curve: DataFrame, by: list[str] = (), value: str = "ks") -> DataFrame:
    """The row of ``curve`` with the largest ``value``; the riskiest one of equals."""
    best = F.max_by(F.struct(*[c for c in curve.columns if c not in by]),
                    F.struct(dround(F.col(value), 12), F.col("prob")))
    return curve.groupBy(*by).agg(best.alias("best")).select(*by, "best.*")


def _auc() -> Column:
    good_below = F.col("n_neg") - F.col("neg_before") - F.col("neg") / 2
    return F.try_divide(F.sum(F.col("pos") * good_below.cast("double")),
                        (F.max("n_pos") * F.max("n_neg").cast("double")))


def auc_gini(table: DataFrame, by: list[str] = ()) -> DataFrame:
    """Area under the ROC curve with ties counted half, and Gini."""
    return (table.groupBy(*by).agg(_auc().alias("auc"))
            .withColumn("gini", 2 * F.col("auc") - 1))


def ks_statistic(table: DataFrame, by: list[str] = ()) -> DataFrame:
    tpr, fpr = _rates()
    return table.groupBy(*by).agg(F.max(tpr - fpr).alias("ks"))


def model_metrics(table: DataFrame, by: list[str]) -> DataFrame:
    """AUC, KS and Gini per group from one pass over the table."""
    tpr, fpr = _rates()
    return (table.groupBy(*by).agg(_auc().alias("auc"), F.max(tpr - fpr).alias("ks"))
            .withColumn("gini", 2 * F.col("auc") - 1))


def model_comparison(scored_long: DataFrame, splits: list[str] = ("validation", "oot"),
                     digits: int | None = None) -> DataFrame:
    """One row per model with AUC, KS and Gini of each split side by side."""
    part = scored_long.where(F.col("split").isin(*splits))
    metrics = model_metrics(threshold_table(part, ["model", "split"], digits=digits),
                            ["model", "split"])
    return metrics.groupBy("model").agg(*[
        F.max(F.when(F.col("split") == split, F.col(metric))).alias(f"{split}_{metric}")
        for split in splits for metric in ("auc", "ks", "gini")])


def compare_ks(scored: DataFrame, champion: str = "champ_pd", challenger: str = "chall_pd",
               digits: int | None = None) -> DataFrame:
    """KS of both models, their difference and whether the challenger wins."""
    long = long_scores(scored, {"champion": champion, "challenger": challenger})
    ks = ks_statistic(threshold_table(long, ["model"], digits=digits), ["model"])
    a, b = (F.max(F.when(F.col("model") == m, F.col("ks"))) for m in ("champion", "challenger"))
    return ks.agg(a.alias("a"), b.alias("b")).select(
        dround(F.col("a"), 4).alias("champion_ks"),
        dround(F.col("b"), 4).alias("challenger_ks"),
        dround(F.col("b") - F.col("a"), 4).alias("ks_diff"),
        (F.col("b") > F.col("a")).alias("challenger_wins"))


# ------------------------------------------------------------------ gains
# Equal probabilities have no order of their own.  They are ordered by the md5
# of the id, which splits a hot probability evenly, and then by the id.

def _mixed(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))


def _bads_in_top(scored: DataFrame, table: DataFrame, cuts: Column, key: str,
                 probability: str) -> DataFrame:
    """Bads among the top ``m`` loans for each struct (cut, m) of ``cuts``.

    ``cuts`` is an array column over n = n_pos + n_neg.  Only ticks that a cut
    falls into are looked at row by row, first by md5 prefix, then by row.
    """
    before = F.col("pos_before") + F.col("neg_before")
    here = F.col("pos") + F.col("neg")
    hit = (table.withColumn("c", F.explode(cuts))
           .where((before < F.col("c.m")) & (F.col("c.m") <= before + here))
           .select("prob", F.col("c.cut").alias("cut"), F.col("c.m").alias("m"),
                   "pos", "n_pos", "n_neg", F.col("pos_before").alias("bads"),
                   (F.col("c.m") - before).alias("rest"), here.alias("n_here")))
    whole = hit.where(F.col("rest") == F.col("n_here")).select(
        "cut", "m", "n_pos", "n_neg", (F.col("bads") + F.col("pos")).alias("bads"))

    # A row per cut, so always small enough to broadcast.
    split_ticks = F.broadcast(hit.where(F.col("rest") < F.col("n_here"))
                              .select("prob", "cut", "m", "n_pos", "n_neg", "bads", "rest"))
    rows = scored.select(F.col(probability).alias("prob"), "is_bad",
                         F.col(key).alias("row_key"), _mixed(key).alias("mixed"))
    rows = rows.withColumn("bucket", F.substring("mixed", 1, 4))
    carried = ["cut", "m", "n_pos", "n_neg"]
    # counted before the join: a hot tick is repeated per cut as 65,536 buckets, not as loans
    counted = (rows.join(F.broadcast(split_ticks.select("prob").distinct()), "prob", "left_semi")
               .groupBy("prob", "bucket")
               .agg(F.count("*").alias("n"), F.sum("is_bad").alias("pos")))
    buckets = counted.join(split_ticks, "prob")
    order = W.partitionBy("cut").orderBy("bucket")
    seen = _before("n", order)
    chosen = (buckets.withColumns({"seen": seen, "pos_seen": _before("pos", order)})
              .where((F.col("seen") < F.col("rest"))
                     & (F.col("rest") <= F.col("seen") + F.col("n")))
              .select(*carried, "prob", "bucket",
                      (F.col("bads") + F.col("pos_seen")).alias("bads"),
                      (F.col("rest") - F.col("seen")).alias("rest")))
    place = F.row_number().over(W.partitionBy("cut").orderBy("mixed", "row_key"))
    partial = (rows.join(F.broadcast(chosen), ["prob", "bucket"])
               .withColumn("place", place).where(F.col("place") <= F.col("rest"))
               .groupBy(*carried, "bads").agg(F.sum("is_bad").alias("more"))
               .select(*carried, (F.col("bads") + F.col("more")).alias("bads")))
    return whole.unionByName(partial.select(*whole.columns))


def gains_lift(scored: DataFrame, probability: str = "prob", key: str = "id",
               percentiles: int = 100, digits: int | None = None) -> DataFrame:
    """Gains and lift at each percentile of the population, riskiest first.

    Percentile k holds the first loans that make up at least k percent.
    """
    scored = _rounded(scored, probability, digits)
    table = threshold_table(scored, probability=probability, digits=digits)
    cuts = F.expr(f"transform(sequence(1, {percentiles}), k -> named_struct("
                  f"'cut', k, 'm', ceil((n_pos + n_neg) * k / {float(percentiles)}D)))")
    top = _bads_in_top(scored, table, cuts, key, probability)
    pct_pop = F.col("m") * 100.0 / (F.col("n_pos") + F.col("n_neg"))
    gains = F.col("bads") * 100.0 / F.col("n_pos")
    return top.select(F.col("cut").alias("percentile"), F.col("m").alias("n_top"),
                      pct_pop.alias("pct_pop"), gains.alias("gains"),
                      (gains / pct_pop).alias("lift"))


def ranked_loans(scored: DataFrame, probability: str = "prob", key: str = "id",
                 digits: int | None = None) -> DataFrame:
    """Every loan with its ``place`` from the riskiest on and the ``bads`` up to it.

    Columns: key, prob, is_bad, place, bads, n, n_pos.  A loan's place is what
    lies above its tick, plus the tick's loans in earlier md5 buckets, plus its
    row in its own bucket.  A window sees one bucket, 1 in 65,536 of a tick, or
    the bucket totals of one tick, so no sort ever holds all loans.
    """
    scored = _rounded(scored, probability, digits)
    table = threshold_table(scored, probability=probability, digits=digits)
    rows = (scored.where(F.col(probability).isNotNull())
            .select(F.col(key).alias("row_key"), F.col(probability).alias("prob"), "is_bad", _mixed(key).alias("mixed"))
            .withColumn("bucket", F.substring("mixed", 1, 4)))
    counted = rows.groupBy("prob", "bucket").agg(F.count("*").alias("n"), F.sum("is_bad").alias("pos"))
    order = W.partitionBy("prob").orderBy("bucket")
    above = F.col("pos_before") + F.col("neg_before")
    starts = counted.withColumns({"n_seen": _before("n", order), "pos_seen": _before("pos", order)}).join(
        table.drop("pos", "neg"), "prob").select(
        "prob", "bucket", (above + F.col("n_seen")).alias("first"),
        (F.col("pos_before") + F.col("pos_seen")).alias("bads_first"), "n_pos", (F.col("n_pos") + F.col("n_neg")).alias("n"))
    inside = W.partitionBy("prob", "bucket").orderBy("mixed", "row_key")
    numbered = rows.withColumns({
        "row": F.row_number().over(inside),
        "more": F.sum("is_bad").over(inside.rowsBetween(W.unboundedPreceding, 0))})
    return numbered.join(starts, ["prob", "bucket"]).select(
        F.col("row_key").alias(key), "prob", "is_bad", (F.col("first") + F.col("row")).alias("place"),
        (F.col("bads_first") + F.col("more")).alias("bads"), "n", "n_pos")


def gains_by_loan(scored: DataFrame, probability: str = "prob", key: str = "id",
                  digits: int | None = None) -> DataFrame:
    """A point of the gains and lift curves for every loan, riskiest first by ``place``."""
    pct_pop = F.col("place") * 100.0 / F.col("n")
    gains = F.col("bads") * 100.0 / F.col("n_pos")
    return ranked_loans(scored, probability, key, digits).select(
        key, "place", pct_pop.alias("pct_pop"), gains.alias("gains"), (gains / pct_pop).alias("lift"))


def capture_at(scored: DataFrame, shares: list[float] = (0.10, 0.30), probability: str = "prob",
               key: str = "id", digits: int | None = None) -> DataFrame:
    """Share of bads in the top ``int(n * share) + 1`` loans."""
    scored = _rounded(scored, probability, digits)
    table = threshold_table(scored, probability=probability, digits=digits)
    n = F.col("n_pos") + F.col("n_neg")
    cuts = F.array(*[F.struct(F.lit(float(s)).alias("cut"),
                              F.least(F.floor(n * float(s)) + 1, n).alias("m")) for s in shares])
    top = _bads_in_top(scored, table, cuts, key, probability)
    return top.select(F.col("cut").alias("share"), F.col("m").alias("n_top"),
                      (F.col("bads") * 100.0 / F.col("n_pos")).alias("captured_pct"))


def _rounded(scored: DataFrame, probability: str, digits: int | None) -> DataFrame:
    if digits is None:
        return scored
    return scored.withColumn(probability, F.round(probability, digits))
