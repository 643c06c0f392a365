"""The champion against challenger comparison as one piece of work."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskloom import fixed_values as V
from riskloom.operators.bootstrap import (bootstrap_replicates, hashed_replicates,
                                          summarize_replicates)
from riskloom.operators.champion import (CHALLENGER, CHAMPION, bayesian_ab, business_impact,
                                         decision_record, ztest_auc)
from riskloom.operators.models import PD_DIGITS
from riskloom.operators.ranking import compare_ks
from riskloom.sources.storage import materialize

MODELS = {CHAMPION: "champ_pd", CHALLENGER: "chall_pd"}


def compare_models(scored: DataFrame, n: int = V.BOOTSTRAP_ITERATIONS,
                   threshold: float = V.APPROVAL_THRESHOLD, lgd: float = V.LOSS_GIVEN_DEFAULT, hashed: bool = False) -> DataFrame:
    """The decision record of two scored models on one population.

    The replicates, a row per model and replicate, are computed once and kept in
    the shared folder, as the test, the posterior and the record all use them.
    """
    draw = hashed_replicates if hashed else bootstrap_replicates
    replicates = materialize(draw(scored, MODELS, n))
    summary = summarize_replicates(replicates)
    return decision_record(summary, ztest_auc(summary), bayesian_ab(replicates),
                           compare_ks(scored, digits=PD_DIGITS), business_impact(scored, threshold, lgd))
