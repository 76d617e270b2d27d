"""Byar confidence limits of a count.

Counts below ten use exact Poisson limits. There are only ten of them, so they are worked out once
on the driver and enter the plan as literals; larger counts use Byar's cube approximation.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT_BELOW = 10


def _poisson_cdf(count: int, mean: float) -> float:
    return math.exp(-mean) * math.fsum(mean**i / math.factorial(i) for i in range(count + 1))


def _poisson_mean(count: int, probability: float) -> float:
    """The mean at which at most ``count`` events have the given probability."""
    low, high = 0.0, 100.0 + 10.0 * count
    while True:
        middle = (low + high) / 2
        if middle in (low, high):
            return middle
        if _poisson_cdf(count, middle) > probability:
            low = middle
        else:
            high = middle


@lru_cache(maxsize=32)
def exact_limits(alpha: float) -> tuple[tuple[float | None, float], ...]:
    """Exact (lower, upper) limits of the counts 0 to 9; zero events have no lower limit."""
    return tuple(
        (
            None if count == 0 else _poisson_mean(count - 1, 1 - alpha / 2),
            _poisson_mean(count, alpha / 2),
        )
        for count in range(EXACT_BELOW)
    )


def normal_quantile(alpha: float) -> float:
    return NormalDist().inv_cdf(1 - alpha / 2)


def _literal(value: float | None) -> str:
    return "double(null)" if value is None else f"{value!r}D"


def _chosen(count: str, exact: list[float | None], approximate: str) -> Column:
    values = ", ".join(map(_literal, exact))
    return F.expr(
        f"CASE WHEN {count} < {EXACT_BELOW} THEN get(array({values}), int({count})) ELSE {approximate} END"
    )


def byar_lower(count: str, alpha: float = 0.05) -> Column:
    """Lower limit of a count, given as a column name or SQL expression."""
    z = _literal(normal_quantile(alpha))
    core = f"(1D - 1D / (9D * {count}) - {z} / (3D * sqrt({count})))"
    return _chosen(count, [low for low, _ in exact_limits(alpha)], f"{count} * {core} * {core} * {core}")


def byar_upper(count: str, alpha: float = 0.05) -> Column:
    """Upper limit of a count, given as a column name or SQL expression."""
    z = _literal(normal_quantile(alpha))
    size = f"({count} + 1)"
    core = f"(1D - 1D / (9D * {size}) + {z} / (3D * sqrt({size})))"
    return _chosen(count, [high for _, high in exact_limits(alpha)], f"{size} * {core} * {core} * {core}")
