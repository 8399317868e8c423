"""Distribution tail functions as JVM-side Column expressions (no SciPy).

* ``erfc`` - complementary error function: the series of positive terms of erf
  below 3, the continued fraction above; error about 1e-15.
* ``chi2_sf`` - chi-square survival function, the regularised upper incomplete
  gamma function Q(dof / 2, x / 2): its series or its continued fraction up to
  ``LARGE_DOF`` degrees of freedom, the uniform asymptotic expansion beyond
  (error below 1e-8). The number of terms is fixed, whatever the degrees of freedom.
* ``kolmogorov_sf`` - limiting Kolmogorov distribution Q(lambda), with the
  small-lambda series below 1.18 and the alternating series above.
* ``norm_sf_two_sided`` - 2 * (1 - Phi(|z|)).

All loops are ``aggregate(sequence(...))`` higher-order functions of fixed
length, so the computation stays inside Spark's expression evaluation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

KOLMOGOROV_TERMS = 20
KOLMOGOROV_SWITCH = 1.18
ERFC_SWITCH = 3.0
ERFC_TERMS = 60
LARGE_DOF = 200
GAMMA_TERMS = 200


def _seq(first: int, last: int) -> Column:
    return F.sequence(F.lit(first), F.lit(last), F.lit(1 if last >= first else -1))


def _let(value: Column, f) -> Column:
    """f(value), value computed once: expressions that use it many times would repeat its tree."""
    return F.element_at(F.transform(F.array(value), f), 1)


def erfc(z: Column) -> Column:
    return _let(z.cast("double"), _erfc)


def _erfc(z: Column) -> Column:
    az = F.abs(z)
    # erf(z) = 2 / sqrt(pi) * exp(-z^2) * sum of 2^n z^(2n+1) / (1 * 3 * ... * (2n+1))
    low = F.least(az, F.lit(ERFC_SWITCH))
    start = F.struct(low.alias("s"), low.alias("t"))

    def term(acc, n):
        t = acc["t"] * F.lit(2.0) * low * low / (F.lit(2.0) * n + F.lit(1.0))
        return F.struct((acc["s"] + t).alias("s"), t.alias("t"))

    erf = F.lit(2 / math.sqrt(math.pi)) * F.exp(-low * low) * F.aggregate(_seq(1, ERFC_TERMS), start, term)["s"]
    # erfc(z) = exp(-z^2) / sqrt(pi) / (z + 1/2 / (z + 2/2 / (z + 3/2 / ...)))
    high = F.greatest(az, F.lit(ERFC_SWITCH))
    tail = F.aggregate(_seq(ERFC_TERMS, 1), high, lambda acc, n: high + n.cast("double") / 2.0 / acc)
    pos = F.when(az < ERFC_SWITCH, F.lit(1.0) - erf).otherwise(F.exp(-high * high) / F.lit(math.sqrt(math.pi)) / tail)
    return F.when(z >= 0, pos).otherwise(F.lit(2.0) - pos)


def norm_sf_two_sided(z: Column) -> Column:
    return erfc(F.abs(z) / F.lit(math.sqrt(2.0)))


def _ln_gamma(a: Column) -> Column:
    """Stirling's series, shifted to an argument above 8."""
    up = F.aggregate(_seq(0, 7), F.lit(0.0), lambda acc, k: acc + F.log(a + k.cast("double")))
    b = a + 8.0
    series = 1.0 / (12.0 * b) - 1.0 / (360.0 * b * b * b) + 1.0 / (1260.0 * b * b * b * b * b) - 1.0 / (1680.0 * F.pow(b, F.lit(7.0)))
    return (b - 0.5) * F.log(b) - b + F.lit(0.5 * math.log(2 * math.pi)) + series - up


def _gamma_q_small(a: Column, y: Column) -> Column:
    """Q(a, y) with a fixed number of terms, for a up to LARGE_DOF / 2."""
    front = F.exp(a * F.log(y) - y - _ln_gamma(a))

    def term(acc, n):
        t = acc["t"] * y / (a + n.cast("double"))
        return F.struct((acc["s"] + t).alias("s"), t.alias("t"))

    first = F.lit(1.0) / a
    low = F.lit(1.0) - front * F.aggregate(_seq(1, GAMMA_TERMS), F.struct(first.alias("s"), first.alias("t")), term)["s"]
    # y + 1 - a - 1 (1 - a) / (y + 3 - a - 2 (2 - a) / (y + 5 - a - ...))
    last = y + (2.0 * GAMMA_TERMS + 1.0) - a
    fraction = F.aggregate(
        _seq(GAMMA_TERMS, 1), last, lambda acc, n: y + (n.cast("double") * 2.0 - 1.0) - a - n.cast("double") * (n.cast("double") - a) / acc
    )
    return F.when(y < a + 1.0, low).otherwise(front / fraction)


def _gamma_q_large(a: Column, y: Column) -> Column:
    """Q(a, y) by the uniform asymptotic expansion in 1 / a."""

    def from_d(d):  # d = y / a - 1, near zero by its series
        terms = F.lit(0.0)
        for k in range(8, 1, -1):
            terms = (F.lit((-1.0) ** k / k) + terms) * d
        half = F.when(F.abs(d) < 0.05, terms * d).otherwise(d - F.log1p(d))  # eta^2 / 2
        return _let(F.struct(d.alias("d"), F.greatest(F.lit(0.0), half).alias("half")), from_half)

    def from_half(s):
        eta = F.signum(s["d"]) * F.sqrt(s["half"] * 2.0)
        return _let(F.struct(s["d"].alias("d"), s["half"].alias("half"), eta.alias("eta")), from_eta)

    def from_eta(s):
        d, half, eta = s["d"], s["half"], s["eta"]
        near = F.abs(d) < 0.05
        fd, fe = F.when(near, F.lit(1.0)).otherwise(d), F.when(near, F.lit(1.0)).otherwise(eta)
        c0 = F.when(near, F.lit(-1 / 3) + eta * (F.lit(1 / 12) + eta * (F.lit(-2 / 135) + eta * (F.lit(1 / 864) + eta / 2835.0)))).otherwise(1.0 / fd - 1.0 / fe)
        c1 = F.when(near, F.lit(-1 / 540) + eta * (F.lit(-1 / 288) + eta / 378.0)).otherwise(
            1.0 / (fe * fe * fe) - 1.0 / (fd * fd * fd) - 1.0 / (fd * fd) - 1.0 / (12.0 * fd)
        )
        rest = F.exp(-a * half) / F.sqrt(a * (2 * math.pi)) * (c0 + c1 / a)
        return erfc(eta * F.sqrt(a / 2.0)) / 2.0 + rest

    return _let(y / a - 1.0, from_d)


def chi2_sf(x: Column, dof: Column) -> Column:
    """P(X >= x) for X ~ chi-square(dof), dof a positive integer of any size."""
    small = dof <= LARGE_DOF
    fine = (dof > 0) & (x > 0) & (x < float("inf"))
    # each branch sees arguments that it can work with
    halves = lambda ok, other: F.struct(
        F.when(ok & fine, dof.cast("double") / 2.0).otherwise(F.lit(other)).alias("a"), F.when(ok & fine, x / 2.0).otherwise(F.lit(other)).alias("y")
    )
    low = _let(halves(small, 1.0), lambda s: _gamma_q_small(s["a"], s["y"]))
    high = _let(halves(~small, 1000.0), lambda s: _gamma_q_large(s["a"], s["y"]))
    q = F.when(small, low).otherwise(high)
    return (
        F.when(dof.isNull() | (dof <= 0) | x.isNull(), F.lit(None).cast("double"))
        .when(x <= 0, F.lit(1.0))
        .when(x == F.lit(float("inf")), F.lit(0.0))
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), q)))
    )


def kolmogorov_sf(lam: Column) -> Column:
    """Q_KS(lambda) = P(K > lambda) of the Kolmogorov distribution."""
    js = F.sequence(F.lit(1), F.lit(KOLMOGOROV_TERMS))
    small = F.lit(1.0) - F.lit(math.sqrt(2.0 * math.pi)) / lam * F.aggregate(
        js,
        F.lit(0.0),
        lambda acc, j: acc
        + F.exp(-F.pow(F.lit(2.0) * j - 1, 2) * F.lit(math.pi**2) / (F.lit(8.0) * lam * lam)),
    )
    large = F.lit(2.0) * F.aggregate(
        js,
        F.lit(0.0),
        lambda acc, j: acc
        + F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(F.lit(-2.0) * j * j * lam * lam),
    )
    q = F.when(lam < KOLMOGOROV_SWITCH, small).otherwise(large)
    return F.when(lam.isNull(), F.lit(None).cast("double")).when(lam <= 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), q))
    )


# DuckDB text for the SQL oracles: finite sums and other series than above.
def erfc_sql(z: str) -> str:
    """1 - erf, erf as a series with the gamma function."""
    az = f"abs({z})"
    erf = f"list_sum(list_transform(range(0, 400), lambda n: exp((2 * n + 1) * ln({az}) - lgamma(n + 1.5) - {az} * {az})))"
    pos = f"(CASE WHEN {az} = 0 THEN 1.0 WHEN {az} > 12 THEN 0.0 ELSE greatest(0.0, 1.0 - {erf}) END)"
    return f"(CASE WHEN {z} >= 0 THEN {pos} ELSE 2.0 - {pos} END)"


def chi2_sf_sql(x: str, dof: str) -> str:
    y = f"(({x}) / 2.0)"
    m = f"CAST(floor(({dof}) / 2) AS INTEGER)"
    even = f"list_sum(list_transform(range(0, {m}), lambda i: exp(-{y} + i * ln({y}) - lgamma(i + 1))))"
    odd = (
        f"({erfc_sql(f'sqrt({y})')} + coalesce(list_sum(list_transform(range(0, {m}), "
        f"lambda i: exp(-{y} + (i + 0.5) * ln({y}) - lgamma(i + 1.5)))), 0))"
    )
    q = f"(CASE WHEN ({dof}) % 2 = 0 THEN {even} ELSE {odd} END)"
    return (
        f"(CASE WHEN ({dof}) IS NULL OR ({dof}) <= 0 OR ({x}) IS NULL THEN NULL "
        f"WHEN ({x}) <= 0 THEN 1.0 WHEN isinf({x}) THEN 0.0 "
        f"ELSE least(1.0, greatest(0.0, {q})) END)"
    )


def kolmogorov_sf_sql(lam: str) -> str:
    small = (
        f"(1.0 - {math.sqrt(2.0 * math.pi)} / ({lam}) * list_sum(list_transform(range(1, {KOLMOGOROV_TERMS + 1}), "
        f"lambda j: exp(-pow(2.0 * j - 1, 2) * {math.pi ** 2} / (8.0 * ({lam}) * ({lam}))))))"
    )
    large = (
        f"(2.0 * list_sum(list_transform(range(1, {KOLMOGOROV_TERMS + 1}), "
        f"lambda j: (CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * j * j * ({lam}) * ({lam})))))"
    )
    return (
        f"(CASE WHEN ({lam}) IS NULL THEN NULL WHEN ({lam}) <= 0 THEN 1.0 "
        f"ELSE least(1.0, greatest(0.0, CASE WHEN ({lam}) < {KOLMOGOROV_SWITCH} THEN {small} ELSE {large} END)) END)"
    )
