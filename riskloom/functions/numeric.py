"""Rounding, division and the normal distribution as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dround(x: Column, digits: int) -> Column:
    """Round half away from zero in binary scale, as columnar SQL engines do.

    Spark's own ``round`` goes through the decimal text of the double, so
    1.005 becomes 1.01 there and 1.0 here.
    """
    scale = F.lit(float(10 ** digits))
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale


def half_even(x: Column, digits: int = 0) -> Column:
    """Banker's rounding, the rule of numpy and of Python's ``round``."""
    return F.bround(x, digits)


def safe_ratio(a: Column, b: Column, digits: int = 4) -> Column:
    """``a / b`` rounded; NULL where ``b`` is zero."""
    return dround(F.try_divide(a.cast("double"), b.cast("double")), digits)


def clip(x: Column, low: float, high: float) -> Column:
    """``x`` held between two numbers; NULL stays NULL, which ``greatest`` would skip."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high))))


# Numerator and denominator of Hart's rational form of the normal
# tail (double precision, Computer Approximations 1968), highest power first.
_TAIL_NUMERATOR = [
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165,
    33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376,
]
_TAIL_DENOMINATOR = [
    8.83883476483184e-02, 1.75566716318264, 16.064177579207,
    86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948,
    440.413735824752,
]
_TAIL_SWITCH = 7.07106781186547
_SQRT_TWO_PI = 2.506628274631


def _polynomial(x: Column, coefficients: list[float]) -> Column:
    total = F.lit(coefficients[0])
    for coefficient in coefficients[1:]:
        total = total * x + F.lit(coefficient)
    return total


def norm_sf(z: Column) -> Column:
    """Upper tail probability of the standard normal distribution."""
    x = F.abs(z)
    bell = F.exp(-x * x / 2)
    near = bell * _polynomial(x, _TAIL_NUMERATOR) / _polynomial(x, _TAIL_DENOMINATOR)
    fraction = x + F.lit(0.65)
    for k in (4.0, 3.0, 2.0, 1.0):
        fraction = x + F.lit(k) / fraction
    far = bell / fraction / F.lit(_SQRT_TWO_PI)
    tail = F.when(x < _TAIL_SWITCH, near).otherwise(far)
    return F.when(z > 0, tail).otherwise(1 - tail)


def norm_cdf(z: Column) -> Column:
    return 1 - norm_sf(z)
