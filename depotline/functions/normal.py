"""Normal distribution as plain column arithmetic (no Python workers)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, functions as F

# --- Fixed values -----------------------------------------------------------
# P. J. Acklam's rational approximation of the inverse normal CDF
# (relative error below 1.15e-9).
_CENTRE_NUM = [-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
               1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00]
_CENTRE_DEN = [-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
               6.680131188771972e01, -1.328068155288572e01, 1.0]
_TAIL_NUM = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
             -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00]
_TAIL_DEN = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
             3.754408661907416e00, 1.0]
_TAIL_START = 0.02425
# G. West, "Better approximations to cumulative normal functions" (2005), after
# J. F. Hart's rational approximation of the upper tail up to _FAR, highest power first.
_UPPER_NUM = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
              112.079291497871, 221.213596169931, 220.206867912376]
_UPPER_DEN = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
              296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752]
_FAR = 7.07106781186547
# --- End of fixed values ----------------------------------------------------


def _polynomial(coefficients: list[float], x: Column) -> Column:
    """Horner form, highest power first."""
    return reduce(lambda acc, c: acc * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def normal_quantile(p: Column) -> Column:
    """z with Phi(z) = p; null outside (0, 1)."""
    centred = p - 0.5
    square = centred * centred
    centre = centred * _polynomial(_CENTRE_NUM, square) / _polynomial(_CENTRE_DEN, square)

    def tail(q: Column) -> Column:
        t = F.sqrt(F.lit(-2.0) * F.ln(q))
        return _polynomial(_TAIL_NUM, t) / _polynomial(_TAIL_DEN, t)

    return (
        F.when((p <= 0) | (p >= 1), F.lit(None).cast("double"))
        .when(p < _TAIL_START, tail(p))
        .when(p > 1 - _TAIL_START, -tail(1 - p))
        .otherwise(centre)
    )


def normal_upper_tail(z: Column) -> Column:
    """1 - Phi(z), to twelve digits up to ``_FAR`` and to six beyond, where a continued fraction takes over."""
    x = F.abs(z)
    density = F.exp(-x * x / 2)
    fraction = x + 0.65
    for numerator in (4.0, 3.0, 2.0, 1.0):
        fraction = x + F.lit(numerator) / fraction
    near = density * _polynomial(_UPPER_NUM, x) / _polynomial(_UPPER_DEN, x)
    upper = F.when(x < _FAR, near).otherwise(density / fraction / math.sqrt(2 * math.pi))
    return F.when(z >= 0, upper).otherwise(F.lit(1.0) - upper)
