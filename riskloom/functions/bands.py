"""Banding of numeric columns.

Two closures exist and must not be mixed: ``band`` is left-closed and sends
NULL to the last label, ``cut_right`` is right-closed and keeps NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskloom import fixed_values as V


def band(x: Column, edges: list, labels: list[str]) -> Column:
    """Left-closed bands; NULL and values from the last edge on get the last label."""
    result = F
    for edge, label in zip(edges, labels):
        result = result.when(x < edge, label)
    return result.otherwise(labels[-1])


def band_fico(x: Column) -> Column:
    return band(x, *V.FICO_BANDS)


def band_dti(x: Column) -> Column:
    return band(x, *V.DTI_BANDS)


def band_loan_amnt(x: Column) -> Column:
    return band(x, *V.LOAN_AMNT_BANDS)


def band_emp(x: Column) -> Column:
    return band(x, *V.EMP_BANDS)


def band_int_rate(x: Column) -> Column:
    return band(x, *V.INT_RATE_BANDS)


def cut_ordinal(x: Column, edges: list) -> Column:
    """1-based number of the right-closed interval; NULL outside the edges."""
    result = F.when(x <= edges[0], None)
    for ordinal, edge in enumerate(edges[1:], start=1):
        result = result.when(x <= edge, ordinal)
    return result


def cut_right(x: Column, edges: list, labels: list[str]) -> Column:
    """Right-closed intervals ``(a, b]``; NULL outside the edges."""
    result = F.when(x <= edges[0], None)
    for edge, label in zip(edges[1:], labels):
        result = result.when(x <= edge, label)
    return result


def split_flag(year: Column, train_last: int = V.TRAIN_LAST_YEAR,
               validation: int = V.VALIDATION_YEAR) -> Column:
    return (F.when(year <= train_last, "train")
            .when(year == validation, "validation")
            .otherwise("oot"))


def psi_status(psi: Column) -> Column:
    """Reading of a stability index; upper limits are exclusive."""
    return band(psi, *V.PSI_STATUS)


def iv_strength(iv: Column) -> Column:
    """Reading of an information value; the first limit is exclusive, the rest inclusive."""
    (useless, weak, medium), words = V.IV_STRENGTH
    return (F.when(iv < useless, words[0]).when(iv <= weak, words[1])
            .when(iv <= medium, words[2]).otherwise(words[3]))
