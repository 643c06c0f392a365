"""Portfolio views: volumes and bad rates by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom import fixed_values as V
from riskloom.functions.bands import cut_ordinal, cut_right
from riskloom.functions.numeric import dround
from riskloom.functions.parsing import vintage_label


def bad_rate_pct() -> Column:
    return dround(F.avg("is_bad") * 100, 2)


def order_groups(df: DataFrame, *keys: str) -> DataFrame:
    """Ascending with NULL keys last."""
    return df.orderBy(*[F.asc_nulls_last(key) for key in keys])


def bad_rate_by_grade(staged: DataFrame) -> DataFrame:
    stats = staged.groupBy("grade").agg(
        F.count("*").alias("total_loans"),
        F.sum("is_bad").alias("bad_loans"),
        bad_rate_pct().alias("bad_rate_pct"),
        dround(F.avg("int_rate"), 2).alias("avg_int_rate"),
        dround(F.avg("loan_amnt"), 0).alias("avg_loan_amnt"))
    return order_groups(stats, "grade")


def bad_rate_by_vintage_year(staged: DataFrame) -> DataFrame:
    stats = staged.groupBy("vintage_year").agg(
        F.count("*").alias("total_loans"),
        bad_rate_pct().alias("bad_rate_pct"),
        dround(F.avg("loan_amnt"), 0).alias("avg_loan_amnt"))
    return order_groups(stats, "vintage_year")


def bad_rate_by_vintage_quarter(staged: DataFrame) -> DataFrame:
    keys = ["vintage_year", "vintage_quarter"]
    stats = staged.groupBy(*keys).agg(
        F.count("*").alias("total_loans"), bad_rate_pct().alias("bad_rate_pct"))
    labelled = stats.withColumn("vintage", vintage_label(*[F.col(key) for key in keys]))
    return order_groups(labelled.select(*keys, "vintage", "total_loans", "bad_rate_pct"), *keys)


def share_of_total(groups: DataFrame, count: str = "n", share: str = "pct") -> DataFrame:
    """Percentage of each group, over rows that are already few aggregates."""
    whole = W.partitionBy(F.lit(1))
    return groups.withColumn(
        share, dround(F.col(count) * 100.0 / F.sum(count).over(whole), 2))


def target_distribution(staged: DataFrame) -> DataFrame:
    counts = staged.groupBy("is_bad").agg(F.count("*").alias("n"))
    return order_groups(share_of_total(counts), "is_bad")


def portfolio_summary(staged: DataFrame) -> DataFrame:
    return staged.agg(
        F.count("*").alias("total_loans"),
        bad_rate_pct().alias("overall_bad_rate_pct"),
        dround(F.avg("loan_amnt"), 0).alias("avg_loan_amount"),
        dround(F.avg("int_rate"), 2).alias("avg_interest_rate"),
        dround(F.avg("fico_avg"), 0).alias("avg_fico_score"),
        dround(F.avg("annual_inc"), 0).alias("avg_annual_income"),
        dround(F.avg("dti"), 2).alias("avg_dti"),
        F.min("vintage_year").alias("first_vintage"),
        F.max("vintage_year").alias("last_vintage"))


def split_summary(features: DataFrame) -> DataFrame:
    stats = features.groupBy("split").agg(
        F.count("*").alias("n"), bad_rate_pct().alias("bad_rate_pct"))
    return order_groups(stats, "split")


def filter_small_groups(groups: DataFrame, minimum: int = V.SMALL_GROUP_LIMIT) -> DataFrame:
    return groups.where(F.col("total") > minimum)


def categorical_bad_rates(staged: DataFrame, columns: list[str] = V.CATEGORICAL_COLUMNS,
                          minimum: int = V.SMALL_GROUP_LIMIT) -> DataFrame:
    """Bad rate per category of several columns in one scan, worst first."""
    long = staged.select("is_bad", *columns).unpivot("is_bad", columns, "feature", "category")
    stats = long.where(F.col("category").isNotNull()).groupBy("feature", "category").agg(
        F.avg("is_bad").alias("bad_rate"), F.count("is_bad").alias("total"))
    return filter_small_groups(stats, minimum).orderBy(
        "feature", F.desc("bad_rate"), "category")


def fico_bin_stats(staged: DataFrame) -> DataFrame:
    """Bad rate by right-closed FICO range; empty ranges and outsiders are absent."""
    edges, labels = V.FICO_CUT
    fico = F.col("fico_avg")
    return (staged.select(cut_ordinal(fico, edges).alias("bin_ord"),
                          cut_right(fico, edges, labels).alias("fico_bin"), "is_bad")
            .where(F.col("bin_ord").isNotNull())
            .groupBy("bin_ord", "fico_bin")
            .agg(F.avg("is_bad").alias("bad_rate"), F.count("is_bad").alias("total"))
            .orderBy("bin_ord"))
