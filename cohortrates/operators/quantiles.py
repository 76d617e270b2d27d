"""Exact quantiles without holding a distribution in one task.

A sketch brackets each wanted rank between two values a known number of ranks apart. A second pass
counts, per value, only the rows inside the brackets and finds the next values outside them; rows
beyond become one number. What is sorted is then a few rank shares of the data, not all of it, and the
answer is exact, for groups of any size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import named, quoted

#: The sketch is off by at most one rank in this many.
ACCURACY = 50_000

#: Half-width of a bracket, in units of that error: far more than merging sketches can add to it.
MARGIN = 32


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    also: Mapping[str, Column] | None = None,
    accuracy: int = ACCURACY,
    margin: float = MARGIN,
) -> DataFrame:
    """``keys``, the aggregates in ``also``, and one interpolated quantile per name.

    Null and NaN values are left out of the quantiles; groups without any value get null. The second pass
    counts how many values lie below each bracket, so it knows whether a rank is inside: one that is not, which the
    bound on the sketch rules out, fails the query. The aggregates travel with the rows of the second pass,
    so ``df`` is read twice and nothing is stored.
    """
    missed = "double(raise_error('a quantile lies outside of its bracket: use verified_quantiles'))"
    return _bracketed(df, keys, value, quantiles, dict(also or {}), accuracy, margin, missed)


def verified_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    also: Mapping[str, Column] | None = None,
    accuracy: int = ACCURACY,
    margin: float = MARGIN,
) -> DataFrame:
    """``exact_quantiles`` whatever the sketch: brackets are checked by count, and widened until all ranks are inside.

    Reads ``df`` at once, twice per try. A bracket that holds all values cannot miss, so it ends.
    """
    also = dict(also or {})
    while True:
        tried = _bracketed(df, keys, value, quantiles, also, accuracy, margin, "double('NaN')")
        if not tried.where(" OR ".join(f"isnan({quoted(n)})" for n in quantiles)).limit(1).count():
            return exact_quantiles(df, keys, value, quantiles, also, accuracy, margin)
        margin = max(margin * 16, 1.0)


def _bracketed(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    also: dict[str, Column],
    accuracy: int,
    margin: float,
    missed: str,
) -> DataFrame:
    """The quantiles, with the expression ``missed`` for ranks outside of their brackets and the values next to them."""
    if not keys:
        raise ValueError("quantiles need a grouping column")
    names = list(quantiles)
    edges = [min(max(p + sign * margin / accuracy, 0.0), 1.0) for p in quantiles.values() for sign in (-1, 1)]
    number = F.expr(f"nullif(double({quoted(value)}), double('NaN'))")
    marks = df.groupBy(*[named(k) for k in keys]).agg(
        F.count(number).alias("values_seen"),
        F.percentile_approx(number, edges, accuracy).alias("edges"),
        *[column.alias(f"also_{i}") for i, column in enumerate(also.values())],
    )
    brackets = ", ".join(
        f"named_struct('which', {i}, 'seen', values_seen, 'rank', {p!r}D * (values_seen - 1), 'low', edges[{2 * i}], 'high', edges[{2 * i + 1}])"
        for i, p in enumerate(quantiles.values())
    )
    carried = [f"also_{i}" for i in range(len(also))]
    lookup = marks.selectExpr(
        *[f"{quoted(k)} AS key_{i}" for i, k in enumerate(keys)], *carried, f"array({brackets}) AS brackets"
    )
    same = F.expr(" AND ".join(f"key_{i} <=> {quoted(k)}" for i, k in enumerate(keys)))
    rows = df.select(*[named(k) for k in keys], number.alias("number"))
    found = [f"key_{i}" for i in range(len(keys))]
    group = [*found, "which"]
    counted = (
        rows.join(lookup, same)
        .selectExpr(*found, *carried, "number", "inline(brackets)")
        .groupBy(*group, F.expr("CASE WHEN number BETWEEN low AND high THEN number END").alias("inside"))
        .agg(
            F.expr("count_if(number BETWEEN low AND high) AS n"),
            F.expr("count_if(number < low) AS below"),
            F.expr("max(CASE WHEN number < low THEN number END) AS under"),
            F.expr("min(CASE WHEN number > high THEN number END) AS over"),
            *[F.expr(f"any_value({c}) AS {c}") for c in ["seen", "rank", *carried]],
        )
    )
    part = f"PARTITION BY {', '.join(group)}"
    placed = counted.selectExpr(
        "*",
        f"sum(below) OVER ({part}) AS first",
        f"sum(below) OVER ({part}) + sum(n) OVER ({part} ORDER BY inside NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto",
        f"sum(below) OVER ({part}) + sum(n) OVER ({part}) AS beyond",
    )

    def at(rank: str) -> Column:
        return F.expr(
            f"coalesce(max(CASE WHEN {rank} >= upto - n AND {rank} < upto THEN inside END), "
            f"max(CASE WHEN {rank} = first - 1 THEN under END), min(CASE WHEN {rank} = beyond THEN over END))"
        )

    by_which = (
        placed.groupBy(*group)
        .agg(at("floor(rank)").alias("lower"), at("ceil(rank)").alias("upper"), *[F.expr(f"any_value({c}) AS {c}") for c in ["seen", "rank", *carried]])
        .selectExpr(
            *group,
            *carried,
            f"CASE WHEN seen > 0 AND (lower IS NULL OR upper IS NULL) THEN {missed} ELSE lower + (upper - lower) * (rank - floor(rank)) END AS quantile",
        )
    )
    return (
        by_which.groupBy(*found)
        .agg(
            *[F.expr(f"any_value({c}) AS {c}") for c in carried],
            *[F.expr(f"max(CASE WHEN which = {i} THEN quantile END) AS quantile_{i}") for i in range(len(names))],
        )
        .select(
            *[F.col(f"key_{i}").alias(k) for i, k in enumerate(keys)],
            *[F.col(c).alias(n) for c, n in zip(carried, also, strict=True)],
            *[F.col(f"quantile_{i}").alias(n) for i, n in enumerate(names)],
        )
    )
