"""From raw loans to the model-ready table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskloom import fixed_values as V
from riskloom.operators.cleaning import clean_loans
from riskloom.operators.features import derive_features
from riskloom.operators.profile import profile_columns
from riskloom.operators.staging import stage_loans
from riskloom.operators.woe import fit_woe, iv_summary, model_input, woe_table
from riskloom.sources.csv import read_accepted, write_csv_report
from riskloom.sources.layers import write_layer


def loan_features(raw: DataFrame, train_last: int = V.TRAIN_LAST_YEAR,
                  validation: int = V.VALIDATION_YEAR) -> DataFrame:
    """Staged, cleaned and derived loans in one narrow stage."""
    return derive_features(clean_loans(stage_loans(raw)), train_last, validation)


def model_table(raw: DataFrame, train_last: int = V.TRAIN_LAST_YEAR,
                validation: int = V.VALIDATION_YEAR) -> tuple[DataFrame, DataFrame]:
    """The model-ready table and the WoE table fitted on its training split."""
    features = loan_features(raw, train_last, validation)
    woe = fit_woe(features)
    return model_input(features, woe), woe


@dataclass
class Warehouse:
    """The layers as read back from storage."""
    staged: DataFrame
    profile: DataFrame
    features: DataFrame
    woe: DataFrame
    iv: DataFrame
    model_input: DataFrame


def build_warehouse(spark: SparkSession, accepted_csv: str, root: str,
                    train_last: int = V.TRAIN_LAST_YEAR,
                    validation: int = V.VALIDATION_YEAR) -> Warehouse:
    """All layers from the accepted-loans file, each written once under ``root``.

    The CSV is parsed once: later layers read the parquet of earlier ones.
    """
    staged = write_layer(stage_loans(read_accepted(spark, accepted_csv)), f"{root}/staging/loans")
    profile = write_layer(profile_columns(staged), f"{root}/profile/column_stats")
    write_csv_report(profile, f"{root}/profile/column_stats_csv")
    features = write_layer(derive_features(clean_loans(staged), train_last, validation),
                           f"{root}/features/loan_features", "split")
    woe = write_layer(woe_table(features), f"{root}/features/woe_table")
    iv = write_layer(iv_summary(woe), f"{root}/features/iv_summary")
    ready = write_layer(model_input(features, woe), f"{root}/features/model_input", "split")
    return Warehouse(staged, profile, features, woe, iv, ready)
