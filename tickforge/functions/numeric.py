"""Arithmetic with the reference's floating point semantics.

Spark in ANSI mode raises on ``x / 0`` and returns NULL for ``ln(0)``;
the reference engine follows IEEE-754 (``±inf`` / ``NaN``).  These
helpers reproduce IEEE results with plain Column expressions, so they
stay inside whole-stage codegen (no Python UDF anywhere).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _inf() -> Column:
    return F.lit(float("inf"))


def _neg_inf() -> Column:
    return F.lit(float("-inf"))


def _nan() -> Column:
    return F.lit(float("nan"))


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def ieee_div(a, b) -> Column:
    """``a / b`` as double with IEEE results for a zero divisor.

    NULL in either operand gives NULL; ``x/0`` is ``+inf``/``-inf`` by the
    signs of x and of the zero, and ``NaN`` for ``0/0`` and ``NaN/0``.
    """
    a, b = _c(a).cast("double"), _c(b).cast("double")
    # The sign of a zero divisor (-0.0 == 0.0 in comparisons; its text keeps
    # the sign).  Only evaluated in the zero-divisor branch.
    negative_zero = b.cast("string").startswith("-")
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(b != 0, a / b)
            .when(F.isnan(a) | (a == 0), _nan())
            .when((a > 0) != negative_zero, _inf())
            .otherwise(_neg_inf()))


def null_div(a, b) -> Column:
    """``a / NULLIF(b, 0)``: NULL instead of an error or infinity."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def ieee_ln(x) -> Column:
    """Natural log with ``ln(0) = -inf`` and ``ln(x<0) = NaN``."""
    x = _c(x).cast("double")
    return (F.when(x.isNull(), F.lit(None).cast("double"))
            .when(F.isnan(x) | (x < 0), _nan())
            .when(x == 0, _neg_inf())
            .otherwise(F.ln(x)))


def weighted_mean(value, weight) -> Column:
    """Aggregate ``sum(value*weight) / sum(weight)`` with IEEE division.

    As in SQL, the numerator skips rows with a NULL value while the
    denominator still counts their weight.
    """
    return ieee_div(F.sum(_c(value) * _c(weight)), F.sum(_c(weight)))


# Coefficients of the double-precision cumulative normal
# approximation published by Hart (1968), "Computer Approximations",
# as restated in G. West (2005), "Better approximations to cumulative
# normal functions", Wilmott Magazine.  Highest-degree term first.
_HART_NUM = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165,
             33.912866078383, 112.079291497871, 221.213596169931,
             220.206867912376]
_HART_DEN = [8.83883476483184e-02, 1.75566716318264, 16.064177579207,
             86.7807322029461, 296.564248779674, 637.333633378831,
             793.826512519948, 440.413735824752]
_HART_SPLIT = 7.07106781186547
_HART_CUTOFF = 37.0
_SQRT_2PI = 2.506628274631


def _horner(coeffs, x: Column) -> Column:
    acc = F.lit(coeffs[0])
    for c in coeffs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def norm_cdf(x) -> Column:
    """Standard normal CDF N(x) as a native expression (max abs error ~1e-15).

    NULL stays NULL, NaN stays NaN, ``±inf`` maps to 1 / 0.
    """
    x = _c(x).cast("double")
    ax = F.abs(x)
    e = F.exp(-(ax * ax) / 2.0)
    near = e * _horner(_HART_NUM, ax) / _horner(_HART_DEN, ax)
    cf = ax + F.lit(0.65)
    for k in (4.0, 3.0, 2.0, 1.0):
        cf = ax + F.lit(k) / cf
    far = e / cf / F.lit(_SQRT_2PI)
    tail = (F.when(ax > _HART_CUTOFF, F.lit(0.0))
            .when(ax < _HART_SPLIT, near)
            .otherwise(far))
    return (F.when(x.isNull(), F.lit(None).cast("double"))
            .when(F.isnan(x), _nan())
            .when(x > 0, F.lit(1.0) - tail)
            .otherwise(tail))


def norm_cdf_sql(x: str) -> str:
    """The same approximation as a SQL expression (DuckDB or Spark SQL)."""
    ax = f"abs({x})"

    def horner(cs):
        acc = repr(cs[0])
        for c in cs[1:]:
            acc = f"({acc} * {ax} + {c!r})"
        return acc
    e = f"exp(-({ax} * {ax}) / 2.0)"
    near = f"({e} * {horner(_HART_NUM)} / {horner(_HART_DEN)})"
    cf = f"({ax} + 0.65)"
    for k in ("4.0", "3.0", "2.0", "1.0"):
        cf = f"({ax} + {k} / {cf})"
    far = f"({e} / {cf} / {_SQRT_2PI!r})"
    tail = (f"(CASE WHEN {ax} > {_HART_CUTOFF!r} THEN 0.0 "
            f"WHEN {ax} < {_HART_SPLIT!r} THEN {near} ELSE {far} END)")
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN 'NaN'::DOUBLE "
            f"WHEN {x} > 0 THEN 1.0 - {tail} ELSE {tail} END)")


# Fixed values of the realized-funding rule: dead band and the number of
# minutes in an 8-hour funding period.
FUNDING_DEAD_BAND = 0.00025
FUNDING_MINUTES = 480.0


def dead_band_funding(diff, band: float = FUNDING_DEAD_BAND,
                      minutes: float = FUNDING_MINUTES) -> Column:
    """``(greatest(band, d) + least(-band, d)) / minutes``.

    ``greatest``/``least`` skip NULL, so a NULL premium gives 0 funding.
    """
    d = _c(diff)
    return (F.greatest(F.lit(band), d) + F.least(F.lit(-band), d)) / F.lit(minutes)
