"""Suppression of small counts before publication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import named
from .rates import OVERALL
from .standardise import INTERSEX, breakdown_groups, breakdown_names, drop_intersex, std_parts

LIMITS = ("Lower_CI", "Upper_CI")
RESULT_KEYS = ["Condition", "Group", "Subgroup", "Date"]


def drop_intersex_label(labelled: DataFrame) -> DataFrame:
    """Rows whose label does not name the intersex stratum after another one."""
    label = F.col("Subgroup")
    return labelled.where(~(label.contains(f", {INTERSEX},") | label.endswith(f", {INTERSEX}")))


def suppress(results: DataFrame, n: float, counts: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Null each count that is missing or at most ``n``, and with any of them the measures and limits."""
    small = {c: F.coalesce(named(c).cast("double"), F.lit(0.0)) <= n for c in counts}
    unsafe = reduce(or_, small.values())
    changes = {c: F.when(~too_small, named(c)) for c, too_small in small.items()}
    changes |= {c: F.when(~unsafe, named(c)) for c in [*measures, *LIMITS]}
    return results.withColumns(changes)


def suppress_crude(crude: DataFrame, n: float, measure: str) -> DataFrame:
    return suppress(crude, n, ["Numerator", "Denominator"], [measure])


def crude_numerators(crude: DataFrame, breakdowns: Mapping[str, str]) -> DataFrame:
    """Cases behind each standardised rate: crude cases summed over the age and sex cells.

    The overall count is that of the overall crude rate, intersex persons included.
    """
    groups = [g for g in breakdown_groups(breakdowns) if len(g.split(", ")) > 2]
    whole = crude.where(F.col("Group") == OVERALL).select(
        "Condition", "Group", F.lit(OVERALL).alias("Subgroup"), "Date", "Numerator"
    )
    if not groups:
        return whole
    parts = drop_intersex(std_parts(crude, groups))
    return (
        parts.groupBy(*RESULT_KEYS)
        .agg(F.sum("Numerator").alias("Numerator"))
        .select(*RESULT_KEYS, "Numerator")
        .unionByName(whole)
    )


def attach_numerators(standardised: DataFrame, numerators: DataFrame, breakdowns: Mapping[str, str]) -> DataFrame:
    """Standardised rates with their crude cases; null where there are none."""
    to_name = {name: group for name, group in breakdowns.items() if name != OVERALL} | {OVERALL: OVERALL}
    named_numerators = numerators.select(
        "Condition", F.explode(breakdown_names(to_name)).alias("Group"), "Subgroup", "Date", "Numerator"
    )
    return standardised.join(named_numerators, RESULT_KEYS, "left").select(
        *[named(c) for c in standardised.columns], "Numerator"
    )


def suppress_standardised(counted: DataFrame, n: float, measure: str) -> DataFrame:
    """Standardised rates that carry their crude cases, with small counts suppressed and the cases left out."""
    return suppress(counted, n, ["Numerator"], [measure]).drop("Numerator")
