"""Distribution functions for the handful of rows that remain after aggregation."""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_N01 = NormalDist()
DOUBLE = DoubleType()


def beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, modified Lentz form."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if not 0.0 < x < 1.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * beta_fraction(a, b, x) / a
    return 1.0 - front * beta_fraction(b, a, 1.0 - x) / b


def t_two_sided_value(t: float, df: float) -> float:
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def f_upper_value(f: float, d1: float, d2: float) -> float:
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def chi2_cdf_value(x: float, df: float) -> float:
    """Series of the regularised lower incomplete gamma function."""
    a, half = df / 2.0, x / 2.0
    if half <= 0:
        return 0.0
    term = total = 1.0 / a
    k = a
    while term > total * 1e-16:
        k += 1.0
        term *= half / k
        total += term
    return total * math.exp(-half + a * math.log(half) - math.lgamma(a))


def chi2_quantile_value(p: float, df: float) -> float:
    lo, hi = 0.0, 10.0 * df + 100.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if chi2_cdf_value(mid, df) < p:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


def normal_cdf_value(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def normal_quantile_value(p: float) -> float:
    return _N01.inv_cdf(p)


def t_quantile_value(p: float, df: float) -> float:
    """Upper quantile for p > 0.5 by bisection on the two-sided tail."""
    tail, lo, hi = 2.0 * (1.0 - p), 0.0, 1e8
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if t_two_sided_value(mid, df) > tail:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


def _per_row(fn, *cols: pd.Series) -> pd.Series:
    values = [c.to_numpy(dtype=float) for c in cols]
    ok = np.all([np.isfinite(v) for v in values], axis=0)
    out = [fn(*[v[i] for v in values]) if ok[i] else None for i in range(len(ok))]
    return pd.Series(out, dtype="float64")


@F.pandas_udf(DOUBLE)
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    return _per_row(t_two_sided_value, t, df)


@F.pandas_udf(DOUBLE)
def t_quantile(p: pd.Series, df: pd.Series) -> pd.Series:
    return _per_row(t_quantile_value, p, df)


@F.pandas_udf(DOUBLE)
def f_upper(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _per_row(f_upper_value, f, d1, d2)


@F.pandas_udf(DOUBLE)
def normal_two_sided(z: pd.Series) -> pd.Series:
    return _per_row(lambda v: math.erfc(abs(v) / math.sqrt(2.0)), z)


@F.pandas_udf(DOUBLE)
def normal_upper(z: pd.Series) -> pd.Series:
    return _per_row(lambda v: normal_cdf_value(-v), z)


# Wichura (1988), algorithm AS 241, ratios of polynomials for the normal quantile, lowest power first
NEAR = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
FAR = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
FARTHEST = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def ratio_sql(x: str, polynomials) -> str:
    """SQL of one polynomial over another, by Horner's rule; engines differ in nothing that it uses."""
    texts = []
    for coefficients in polynomials:
        text = repr(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            text = f"({text} * {x} + {c!r})"
        texts.append(text)
    return f"({texts[0]} / {texts[1]})"


def normal_score(p: Column) -> Column:
    """Quantile of the standard normal distribution as a column expression."""
    q = p - 0.5
    tail = F.sqrt(-F.log(F.least(p, 1 - p)))

    def ratio(x: Column, polynomials) -> Column:
        top, bottom = (
            reduce(lambda out, c: out * x + F.lit(c), reversed(poly[:-1]), F.lit(poly[-1])) for poly in polynomials
        )
        return top / bottom

    outer = F.when(tail <= 5, ratio(tail - 1.6, FAR)).otherwise(ratio(tail - 5, FARTHEST))
    return F.when(F.abs(q) <= 0.425, q * ratio(0.180625 - q * q, NEAR)).otherwise(F.signum(q) * outer)
