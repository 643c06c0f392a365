"""Typing of raw text columns and labelling of outcomes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskloom import fixed_values as V
from riskloom.functions.numeric import dround


def parse_term(term: Column) -> Column:
    """``' 36 months'`` to 36."""
    return F.replace(term, F.lit(" months"), F.lit("")).cast("int")


def parse_percent(text: Column) -> Column:
    """``'13.56%'`` to a 32-bit float."""
    return F.replace(text.cast("string"), F.lit("%"), F.lit("")).cast("float")


def emp_length_years(text: Column) -> Column:
    years = F
    for word, value in V.EMP_LENGTH_YEARS.items():
        years = years.when(text == word, value)
    return years


def fico_midpoint(low: Column, high: Column) -> Column:
    return dround((low + high) / 2, 0)


def parse_issue_month(text: Column, lenient: bool = False) -> Column:
    """``'Dec-2015'`` to the first of the month, free of any time zone.

    Malformed text raises, or becomes NULL when ``lenient``.
    """
    if lenient:
        return F.try_to_timestamp(text, F.lit("MMM-yyyy")).cast("timestamp_ntz")
    return F.to_timestamp_ntz(text, F.lit("MMM-yyyy"))


def vintage_year(when: Column) -> Column:
    return F.year(when).cast("bigint")


def vintage_quarter(when: Column) -> Column:
    return F.quarter(when).cast("bigint")


def vintage_label(year: Column, quarter: Column) -> Column:
    """``2015-Q4``; a missing part is left out, it does not blank the label."""
    return F.concat(F.coalesce(year.cast("string"), F.lit("")), F.lit("-Q"),
                    F.coalesce(quarter.cast("string"), F.lit("")))


def label_default(status: Column) -> Column:
    """1 for a bad end, 0 for a good one, NULL while undecided."""
    return (F.when(status.isin(V.BAD_STATUSES), 1)
            .when(status.isin(V.GOOD_STATUSES), 0))


def is_decided(status: Column) -> Column:
    return status.isin(V.BAD_STATUSES + V.GOOD_STATUSES)
