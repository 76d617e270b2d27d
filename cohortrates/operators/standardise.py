"""Direct standardisation by age and sex, with Dobson limits.

All conditions, breakdowns, dates and strata are keys of one aggregation. Crude cases are carried
through it, so suppression needs no second pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import named, text
from ..functions.limits import byar_lower, byar_upper
from .grid import INCIDENCE, PREVALENCE
from .rates import OVERALL, PER_PERSONS

INTERSEX = "I"
NOT_SPECIFIED = "NotSpecified"

#: The column of a rate where both measures stand in one table.
RATE = "Rate"

#: Strata that are not part of a breakdown and are left out of it.
LEFT_OUT = ("Ireland",)

PART_COLUMNS = ["Condition", "Group", "Subgroup", "std_group", "Date", "Numerator", "Denominator"]


def breakdown_groups(breakdowns: Mapping[str, str]) -> list[str]:
    return list(dict.fromkeys(breakdowns.values()))


def scrub_rates(crude: DataFrame, measure: str) -> DataFrame:
    """A missing rate as 0, and an infinite upper limit as 0."""
    return crude.withColumns(
        {
            measure: F.coalesce(named(measure), F.lit(0.0)),
            "Upper_CI": F.when(F.col("Upper_CI") == float("inf"), 0.0).otherwise(F.col("Upper_CI")),
        }
    )


def _unspaced(col: Column) -> Column:
    return F.replace(col, F.lit(" "), F.lit(""))


def split_std_group(labelled: DataFrame) -> DataFrame:
    """Age and sex, the first two parts of the label, as ``std_group``; the rest as ``Subgroup``.

    For results that hold labels only, such as CSV files. Values must not contain commas.
    """
    label = F.when(F.col("Group") == OVERALL, "").otherwise(F.coalesce("Subgroup", F.lit(NOT_SPECIFIED)))
    parts = F.split(_unspaced(label), ",")
    return labelled.withColumn("parts", parts).select(
        *[named(c) for c in labelled.columns if c != "Subgroup"],
        F.array_join(F.slice("parts", 1, 2), ", ").alias("std_group"),
        F.array_join(F.slice("parts", F.lit(3), F.greatest(F.size("parts") - 2, F.lit(0))), ", ").alias("Subgroup"),
    )


def std_parts(crude: DataFrame, groups: Sequence[str], whole: bool = False) -> DataFrame:
    """The same split taken from the stratum columns that ``keep_strata`` left in crude rates.

    With ``whole`` the overall crude rows stay too, without a cell: ``standardise`` counts their cases.
    """

    def joined(columns: Sequence[str]) -> Column:
        return F.concat_ws(", ", *[_unspaced(named(c)) for c in columns])

    cell, rest = F.lit(None).cast("string"), F.lit(None).cast("string")
    for group in groups:
        columns = group.split(", ")
        mine = F.col("Group") == group
        cell = F.when(mine, joined(columns[:2])).otherwise(cell)
        rest = F.when(mine, joined(columns[2:])).otherwise(rest)
    kept = [c for c in crude.columns if c not in ("Subgroup",)]
    chosen = [*groups, OVERALL] if whole else groups
    return crude.where(F.col("Group").isin(*chosen)).select(
        *[named(c) for c in kept], cell.alias("std_group"), rest.alias("Subgroup")
    )


def _is_whole() -> Column:
    return F.col("Group") == OVERALL


def drop_intersex(parts: DataFrame) -> DataFrame:
    """Without the cells the reference population has no weight for."""
    return parts.where(~F.array_contains(F.split(_unspaced(F.col("std_group")), ","), INTERSEX))


def exclude_subgroups(parts: DataFrame, labels: Sequence[str] = LEFT_OUT) -> DataFrame:
    """Without strata that are left out of breakdowns; cells of the overall rate stay."""
    return parts.where((F.col("Subgroup") == "") | ~F.col("Subgroup").isin(*labels))


def breakdown_names(breakdowns: Mapping[str, str], group: str = "`Group`") -> Column:
    """Array of the breakdowns that a crude group feeds."""
    branches = []
    for target in breakdown_groups(breakdowns):
        names = ", ".join(text(name) for name, g in breakdowns.items() if g == target)
        branches.append(f"WHEN {text(target)} THEN array({names})")
    return F.expr(f"CASE {group} {' '.join(branches)} END")


def standardise(
    parts: DataFrame,
    weights: DataFrame,
    breakdowns: Mapping[str, str],
    measure: str,
    per: float = PER_PERSONS,
    alpha: float = 0.05,
    counted: bool = False,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Directly standardised rates of every condition, breakdown, date and stratum.

    ``parts`` comes from ``std_parts`` or ``split_std_group``; the breakdown named ``Overall`` gives one
    overall rate per date, from all cells of its group. Weights are normalised over the cells present.
    A stratum with an unknown cell or an empty one has no rate and no row; one without cases has rate 0
    and no limits. ``keys`` are further columns that tell rates apart.

    With ``counted`` the crude cases stay as ``Numerator``, null where there are none; those of the
    overall rate are the overall crude rate's, whose rows ``std_parts`` keeps with ``whole``.
    """
    if measure not in (INCIDENCE, PREVALENCE, RATE):
        raise ValueError(f"unknown measure {measure}")
    names = F.when(_is_whole(), F.array(F.lit(OVERALL))).otherwise(breakdown_names(breakdowns))
    cells = (
        parts.where(_is_whole() | ~F.array_contains(F.split(_unspaced(F.col("std_group")), ","), INTERSEX))
        .where(F.col("Group").isin(*breakdown_groups(breakdowns), *([OVERALL] if counted else [])))
        .select(
            *keys,
            "Condition",
            "Date",
            "std_group",
            "Subgroup",
            _is_whole().alias("whole"),
            F.col("Numerator").cast("bigint").alias("o"),
            F.col("Denominator").cast("double").alias("n"),
            F.explode(names).alias("breakdown"),
        )
        .withColumn("Subgroup", F.when(F.col("breakdown") == OVERALL, OVERALL).otherwise(F.col("Subgroup")))
        .where((F.col("breakdown") == OVERALL) | ~F.col("Subgroup").isin(*LEFT_OUT))
        .join(weights.select("std_group", F.col("weight").cast("double").alias("w")), "std_group", "left")
    )
    share = "o / nullif(n, 0D)"
    sums = cells.groupBy(*keys, "Condition", "breakdown", "Subgroup", "Date").agg(
        F.expr("sum(w)").alias("total"),
        F.expr(f"sum(w * {share})").alias("weighted"),
        F.expr(f"sum(w * w * {share} / nullif(n, 0D))").alias("spread"),
        F.expr("sum(o) FILTER (WHERE NOT whole)").alias("cases"),
        F.expr("sum(o) FILTER (WHERE whole)").alias("whole_cases"),
        F.expr("bool_or((w IS NULL OR n = 0D) AND NOT whole)").alias("void"),
    )
    rate = F.expr("weighted / nullif(total, 0D)")
    scale = F.expr("sqrt(spread / (nullif(total, 0D) * total) / nullif(cases, 0))")
    cases = F.when(F.col("breakdown") == OVERALL, F.col("whole_cases")).otherwise(F.col("cases"))
    return sums.where("NOT void").select(
        *keys,
        "Condition",
        "Subgroup",
        F.col("breakdown").alias("Group"),
        "Date",
        (rate * per).alias(measure),
        ((rate + scale * (byar_lower("cases", alpha) - F.col("cases"))) * per).alias("Lower_CI"),
        ((rate + scale * (byar_upper("cases", alpha) - F.col("cases"))) * per).alias("Upper_CI"),
        *([cases.alias("Numerator")] if counted else []),
    ).where(named(measure).isNotNull())
