"""Column rules for missing and extreme values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskloom import fixed_values as V


def impute(name: str) -> Column:
    """The column with its business default in place of NULL."""
    return F.coalesce(F.col(name), F.lit(V.IMPUTED_VALUES[name]))


def cap(x: Column, name: str) -> Column:
    return F.least(x, F.lit(V.UPPER_CAPS[name]))


def round_rate(x: Column) -> Column:
    """An interest rate with two digits."""
    return F.round(x, 2)


def null_out_of_range(x: Column, low: float, high: float) -> Column:
    """NULL outside the range, else rounded to two digits."""
    return F.when((x >= low) & (x <= high), F.round(x, 2))


def derogatory_flag(*counts: Column) -> Column:
    """1 if any of the counts is positive; NULL counts do not matter."""
    positive = F.lit(False)
    for count in counts:
        positive = positive | (count > 0)
    return F.when(positive, 1).otherwise(0)
