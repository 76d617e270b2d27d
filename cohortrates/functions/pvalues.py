"""Tail probabilities of test statistics as column expressions.

Spark has no chi-square or Student distribution. These are sums and continued fractions inside one
expression each, for frames of a row per variable; no Python worker is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Half steps of the continued fractions; one that has not settled by then is an error.
STEPS = 400
SETTLED = 1e-11

#: Up to here the tail of a normal variable is one minus a series, from here on a fraction.
SERIES_END = 2.0

#: Degrees of freedom from which, and squared statistics up to which, a t tail is one minus the beta share of its complement.
MANY, NEAR = 10_000, 36

ROOT_PI = 1.7724538509055159


def _normal_tail(z: str) -> str:
    """erfc of a number that is not negative."""
    series = (
        f"aggregate(sequence(0, 60), named_struct('t', {z}, 's', 0D), "
        f"(a, n) -> named_struct('t', a.t * 2 * {z} * {z} / (2 * n + 3), 's', a.s + a.t), a -> a.s)"
    )
    fraction = f"aggregate(sequence(200, 1, -1), 1D, (f, k) -> 1 + k / (2 * {z} * {z} * f))"
    return (
        f"CASE WHEN {z} < {SERIES_END} THEN 1 - 2 / {ROOT_PI}D * exp(-{z} * {z}) * {series} "
        f"ELSE exp(-{z} * {z}) / ({z} * {ROOT_PI}D * {fraction}) END"
    )


def _row(fields: str, body: str) -> Column:
    """``body`` over a row ``r`` whose fields are computed once."""
    return F.expr(f"transform(array(named_struct({fields})), r -> {body})[0]")


def chi_square_p(statistic: str, freedom: str) -> Column:
    """P(X >= statistic) of a chi-square variable with whole degrees of freedom: a finite sum."""
    odd, terms = "r.k % 2 = 1", "int(r.k div 2)"
    first = f"CASE WHEN {odd} THEN 0.5D * ln(r.h) - ln({ROOT_PI}D / 2) - r.h ELSE -r.h END"
    step = f"a.t + ln(r.h) - ln(i + CASE WHEN {odd} THEN 0.5D ELSE 0D END)"
    total = (
        f"aggregate(CASE WHEN {terms} > 1 THEN sequence(1, {terms} - 1) ELSE cast(array() AS array<int>) END, "
        f"named_struct('t', {first}, 's', exp({first})), (a, i) -> named_struct('t', {step}, 's', a.s + exp({step})), a -> a.s)"
    )
    tail = f"(CASE WHEN {odd} THEN {_normal_tail('sqrt(r.h)')} ELSE 0D END) + (CASE WHEN {terms} > 0 THEN {total} ELSE 0D END)"
    known = f"CASE WHEN r.h IS NULL OR r.k IS NULL THEN double(NULL) WHEN r.k <= 0 OR r.h <= 0 THEN 1D ELSE {tail} END"
    return _row(f"'h', double({statistic}) / 2, 'k', bigint({freedom})", known)


def _beta_fraction(x: str, a: str, b: str) -> str:
    """The continued fraction of the incomplete beta function, by half steps."""
    even = f"(j / 2) * ({b} - j / 2) * {x} / (({a} - 1 + j) * ({a} + j))"
    odd = f"-({a} + (j - 1) / 2) * ({a} + {b} + (j - 1) / 2) * {x} / (({a} + j - 1) * ({a} + j))"
    part = f"(CASE WHEN j % 2 = 0 THEN {even} ELSE {odd} END)"
    begin = f"1 / (1 - ({a} + {b}) * {x} / ({a} + 1))"
    ratio = f"(1 + {part} / s.c) / (1 + {part} * s.d)"
    step = f"named_struct('c', 1 + {part} / s.c, 'd', 1 / (1 + {part} * s.d), 'h', s.h * {ratio}, 'e', abs({ratio} - 1))"
    return (
        f"aggregate(sequence(2, {STEPS}), named_struct('c', 1D, 'd', {begin}, 'h', {begin}, 'e', 1D), (s, j) -> {step}, "
        f"s -> CASE WHEN s.e < {SETTLED!r}D THEN s.h ELSE double(raise_error('a tail probability has not settled')) END)"
    )


def student_p(statistic: str, freedom: str) -> Column:
    """P(|T| >= |statistic|) of a Student variable: the regularised incomplete beta function."""
    a, x, y = "(r.v / 2)", "(r.v / (r.v + r.q))", "(r.q / (r.v + r.q))"
    far = f"({a} + 10)"

    def correction(z: str) -> str:
        return f"(1 / (12 * {z}) - 1 / (360 * power({z}, 3)) + 1 / (1260 * power({z}, 5)))"

    # the difference of two log-gammas half a unit apart, without taking one large number from another
    gammas = (
        f"({far} * log1p(0.5D / {far}) + 0.5D * ln({far}) - 0.5D + {correction(f'({far} + 0.5D)')} - {correction(far)} "
        f"+ aggregate(sequence(0, 9), 0D, (s, i) -> s - log1p(0.5D / ({a} + i))) - ln({ROOT_PI}D))"
    )
    front = f"exp({gammas} - {a} * log1p(r.q / r.v) + 0.5D * ln({y}))"
    direct = f"{front} * {_beta_fraction(x, a, '0.5D')} / {a}"
    complement = f"1 - {front} * {_beta_fraction(y, '0.5D', a)} / 0.5D"
    near = f"{y} < 1.5D / ({a} + 2.5D) OR (r.v > {MANY} AND r.q < {NEAR})"
    known = (
        f"CASE WHEN r.v IS NULL OR r.q IS NULL OR r.v <= 0 THEN double(NULL) WHEN r.q = 0 THEN 1D "
        f"WHEN {near} THEN {complement} ELSE {direct} END"
    )
    return _row(f"'q', double({statistic}) * double({statistic}), 'v', double({freedom})", known)
