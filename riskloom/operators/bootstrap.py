"""Bootstrap distributions of the AUC.

A resample with replacement gives each loan a count that is close to Poisson
with mean one, so replicates can be drawn loan by loan or tick by tick and need
no exchange of rows.  ``bootstrap_replicates`` works on ticks: a tick of ``c``
equal loans draws Poisson(c), and its cost does not grow with the loans beyond
the one count per probability.  ``hashed_replicates`` draws per loan from a
hash of its id; it is exactly repeatable in any engine, and linear in loans
times replicates, but no row is made per loan and replicate.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from riskloom import fixed_values as V
from riskloom.functions.hashing import md5_words
from riskloom.operators.ranking import CELL_COUNTS, ROUNDED_DIGITS, long_scores, ticks

DRAWS_PER_DIGEST = 4
LARGEST_DRAW = 12   # Poisson(1) above this is rarer than one in 2^32
LOANS_AT_ONCE = 64
NO_RANK = -1   # bits of no usual double, for loans without probability
INNER, TICK = 0, 1   # the ticks inside a part of the loans in order; its first or its last tick


def poisson_cuts() -> np.ndarray:
    """Least 32-bit word, as a part of 2^32, whose draw from Poisson with mean one is above 0, 1, 2, ..."""
    cuts, cumulative, term = [], 0.0, math.exp(-1)
    for k in range(LARGEST_DRAW):
        cumulative += term
        cuts.append(math.ceil(cumulative * 2 ** 32))
        term /= k + 1
    return np.array([cut for cut in cuts if cut < 2 ** 32], np.uint32)


def hashed_weights(keys: list[str | None], n: int) -> np.ndarray:
    """How often each of ``n`` replicates draws each loan, from md5 digests of ``key-0``, ``key-1``, ...

    A digest gives four draws.  A loan without key gets the largest draw.
    """
    suffixes = [b"-%d" % k for k in range(math.ceil(n / DRAWS_PER_DIGEST))]
    words = md5_words([b"" if key is None else key.encode() for key in keys], suffixes)[:, :n]
    weights = np.zeros(words.shape, np.uint8)
    for cut in poisson_cuts():
        weights += words >= cut
    weights[[key is None for key in keys]] = LARGEST_DRAW
    return weights


class _Part:
    """Running sums per replicate over a part of one model's loans, in ascending order of probability."""

    def __init__(self, model: str, n: int):
        self.model, self.n = model, n
        self.first: tuple | None = None   # (prob as bits, pos, neg)
        self.last: tuple | None = None    # the tick that may go on
        self.pos, self.neg, self.inside = (np.zeros(n) for _ in range(3))

    def add(self, prob: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> None:
        if self.last is not None:
            prob, pos, neg = (np.concatenate([np.array([a]), b]) for a, b in zip(self.last, (prob, pos, neg)))
        starts = np.flatnonzero(np.r_[True, prob[1:] != prob[:-1]])
        if len(starts) < len(prob):
            prob, pos, neg = prob[starts], np.add.reduceat(pos, starts), np.add.reduceat(neg, starts)
        self.last = prob[-1], pos[-1], neg[-1]
        pos, neg = pos[:-1], neg[:-1]
        if self.first is None and len(pos):
            self.first = prob[0], pos[0], neg[0]
            pos, neg = pos[1:], neg[1:]
        below = self.neg + neg.cumsum(axis=0) - neg / 2
        self.inside += (pos * below).sum(axis=0)
        self.pos += pos.sum(axis=0)
        self.neg += neg.sum(axis=0)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The first tick, those inside under the probability of the last, and the last tick."""
        none = np.zeros(self.n)
        found = [(TICK, *self.last, none)]
        if self.first is not None:
            found += [(TICK, *self.first, none), (INNER, self.last[0], self.pos, self.neg, self.inside)]
        for kind, prob, *sums in found:
            made = {"model": [self.model] * self.n, "replicate": pa.array(range(self.n), pa.int32()),
                    "prob": pa.array([None if prob == NO_RANK else np.int64(prob).view(np.float64)] * self.n, pa.float64()),
                    "kind": pa.array([kind] * self.n, pa.int32())}
            yield pa.RecordBatch.from_pydict(made | dict(zip(("pos", "neg", "inside"), sums)))


def _bits(prob: pa.Array) -> np.ndarray:
    """Probabilities as integers that are equal where the probabilities are, not a number included."""
    values = prob.to_numpy(zero_copy_only=False).astype(float)
    bits = np.where(np.isnan(values), np.nan, values).view(np.int64)
    return np.where(prob.is_null().to_numpy(zero_copy_only=False), NO_RANK, bits)


def _parts(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            models, keys = batch.column("model").to_pylist(), batch.column("key").to_pylist()
            bits = _bits(batch.column("prob"))
            bad = batch.column("is_bad").to_numpy(zero_copy_only=False).astype(float)
            known, bad = ~np.isnan(bad)[:, None], np.nan_to_num(bad)[:, None]
            at = 0
            while at < len(models):
                if part is None or models[at] != part.model:
                    if part is not None:
                        yield from part.rows()
                    part = _Part(models[at], n)
                end = at + 1
                while end < min(at + LOANS_AT_ONCE, len(models)) and models[end] == part.model:
                    end += 1
                some = slice(at, end)
                weights = hashed_weights(keys[some], n) * known[some].astype(float)
                part.add(bits[some], weights * bad[some], weights * (1 - bad[some]))
                at = end
        if part is not None:
            yield from part.rows()
    return run


def hashed_replicates(scored: DataFrame, models: dict[str, str], n: int,
                      key: str = "id") -> DataFrame:
    """(model, replicate, auc) from per-loan hashed draws; one-class replicates are skipped.

    All models see the same draws, as resampling loans does.  The loans of each
    model are dealt by probability, so that every task holds a part of them in
    order; ties may be cut apart.  A task draws its loans for all replicates, a
    few loans at a time, and passes on sums per replicate only: those of its
    first tick, of its last tick and of what lies between.  These are joined by
    running sums.  Loans without probability count as safest of all, but win
    against none.
    """
    by = ["model", "replicate"]
    prob = F.round("prob", ROUNDED_DIGITS).cast("double") + F.lit(0.0)   # no negative zero
    long = long_scores(scored.select(key, "is_bad", *models.values()), models, [key]).select(
        "model", prob.alias("prob"), F.col(key).cast("string").alias("key"), F.col("is_bad").cast("double").alias("is_bad"))
    tasks = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = long.repartitionByRange(tasks, "model", "prob", "key").sortWithinPartitions("model", "prob")
    parts = dealt.mapInArrow(
        _parts(n), "model string, replicate int, prob double, kind int, pos double, neg double, inside double")
    sums = parts.groupBy(*by, "prob", "kind").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "inside")])
    lower = (W.partitionBy(*by).orderBy("prob", "kind").rowsBetween(W.unboundedPreceding, -1))
    inside = F.when(F.col("kind") == TICK, F.col("pos") * F.col("neg") / 2).otherwise(F.col("inside"))
    won = inside + F.col("pos") * F.coalesce(F.sum("neg").over(lower), F.lit(0.0))
    ranked = F.col("prob").isNotNull()
    auc = F.when(F.sum(F.when(ranked, F.col("pos") + F.col("neg"))) > 0,
                 F.try_divide(F.sum(F.when(ranked, F.col("won"))), F.sum("pos") * F.sum("neg")))
    return (sums.withColumn("won", won).groupBy(*by).agg(auc.alias("auc"))
            .where(F.col("auc").isNotNull()).select(*by, F.round("auc", 12).alias("auc")))


def _draw_cell(n: int, seed: int):
    def draw(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
        model, number = key
        cell = cell.sort_values("prob", ascending=False)
        rng = np.random.default_rng([seed, zlib.crc32(model.encode()), int(number)])
        shape = (len(cell), n)
        pos = rng.poisson(cell["pos"].to_numpy()[:, None], shape).astype(float)
        neg = rng.poisson(cell["neg"].to_numpy()[:, None], shape).astype(float)
        total = neg.sum(axis=0)
        below = total - neg.cumsum(axis=0) + neg / 2
        return pd.DataFrame({
            "model": model, "cell": int(number), "replicate": np.arange(n, dtype="int32"),
            "pos": pos.sum(axis=0), "neg": total, "inside": (pos * below).sum(axis=0)})
    return draw


def bootstrap_replicates(scored: DataFrame, models: dict[str, str],
                         n: int = V.BOOTSTRAP_ITERATIONS, seed: int = 42) -> DataFrame:
    """(model, replicate, auc) from Poisson draws per tick.

    Probabilities are rounded to six digits, so a cell of width 10^-3 has at
    most 1001 ticks however many loans there are: that is the most one Python
    call ever gets.  Spark has no Poisson function, hence the numpy draw; each
    cell is seeded by its number, so neither partitioning nor a rerun of a task
    changes a draw.  Cells are then joined by running sums per replicate.

    Each model has ticks and draws of its own, so replicates of two models are
    not pairs; ``replicate`` says so in its metadata, and a paired test refuses
    them.  ``hashed_replicates`` draws the same loans for all models.
    """
    counts = ticks(long_scores(scored, models), ["model"], digits=ROUNDED_DIGITS)
    cells = counts.withColumn("cell", F.floor(F.col("prob") * CELL_COUNTS[0]))
    parts = cells.groupBy("model", "cell").applyInPandas(
        _draw_cell(n, seed),
        "model string, cell bigint, replicate int, pos double, neg double, inside double")
    lower = (W.partitionBy("model", "replicate").orderBy("cell")
             .rowsBetween(W.unboundedPreceding, -1))
    won = F.col("inside") + F.col("pos") * F.coalesce(F.sum("neg").over(lower), F.lit(0.0))
    auc = F.try_divide(F.sum("won"), F.sum("pos") * F.sum("neg"))
    return (parts.withColumn("won", won).groupBy("model", "replicate").agg(auc.alias("auc"))
            .where(F.col("auc").isNotNull())
            .select("model", F.col("replicate").alias("replicate", metadata={"paired": False}), "auc"))


def summarize_replicates(replicates: DataFrame, ci: float = 0.95) -> DataFrame:
    """Mean, population deviation and percentile bounds per model.

    The percentiles see one number per replicate.
    """
    alpha = (1 - ci) / 2
    return replicates.groupBy("model").agg(
        F.count("*").alias("n_replicates"),
        F.avg("auc").alias("mean"), F.stddev_pop("auc").alias("std"),
        F.percentile("auc", alpha).alias("lower"), F.percentile("auc", 1 - alpha).alias("upper"))


def bootstrap_auc(scored: DataFrame, models: dict[str, str], n: int = V.BOOTSTRAP_ITERATIONS,
                  ci: float = 0.95, seed: int = 42) -> DataFrame:
    """Bootstrap mean, deviation and confidence bounds of each model's AUC."""
    return summarize_replicates(bootstrap_replicates(scored, models, n, seed), ci)
