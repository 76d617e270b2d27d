"""Table 1: the characteristics of a cohort, as a whole or for two groups side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import MISSING_WORDS, named, rounded_text, text
from ..functions.pvalues import chi_square_p, student_p
from .cleaning import sentinels_to_null
from .quantiles import exact_quantiles

ONE_GROUP = "group"


def two_groups(df: DataFrame, column: str) -> list[str]:
    """The two values of a group column, in order; reads that column once. Anything but two values is an error."""
    found = [r[0] for r in df.select(named(column).cast("string")).distinct().limit(3).collect()]
    if len(found) != 2 or None in found:
        raise ValueError(f"{column} must hold exactly two groups and no nulls")
    return sorted(found)


#: Fails the query if a variable's rows do not belong to exactly two groups.
_TWO = (
    "CASE WHEN count_if(group IS NULL) OVER (PARTITION BY variable) > 0 OR min(group) OVER (PARTITION BY variable) = max(group) OVER (PARTITION BY variable) "
    "OR count_if(group NOT IN (first_group, second_group)) OVER (PARTITION BY variable) > 0 "
    "THEN boolean(raise_error('the group column must hold exactly two groups and no nulls')) ELSE true END"
)


def _with_groups(df: DataFrame) -> DataFrame:
    """``df`` with the names of the two groups that each variable has rows of, found in the plan itself."""
    return df.selectExpr(
        "*",
        "min(group) OVER (PARTITION BY variable) AS first_group",
        "max(group) OVER (PARTITION BY variable) AS second_group",
    ).selectExpr("*", f"{_TWO} AS checked").where("checked")


def _prepared(df: DataFrame, columns: Sequence[str], group: str | None, words: Sequence[str]) -> DataFrame:
    label = F.lit(ONE_GROUP) if group is None else named(group).cast("string")
    return sentinels_to_null(df.select(*[named(c) for c in columns], label.alias("group_label")), columns, words)


def _stacked(
    df: DataFrame, columns: Sequence[str], group: str | None, words: Sequence[str], kind: str, value: str
) -> DataFrame:
    """One row per row of ``df`` and variable: an expansion that stays inside generated code."""
    typed = _prepared(df, columns, group, words).select("group_label", *[named(c).cast(kind).alias(c) for c in columns])
    # a name of its own: a column that merely passed would keep Spark from seeing that two such expansions are one
    return typed.unpivot(F.col("group_label").alias("group"), [named(c) for c in columns], "variable", value)


def level_counts(
    df: DataFrame, columns: Sequence[str], group: str | None = None, words: Sequence[str] = MISSING_WORDS
) -> DataFrame:
    """Rows per variable, group and level in one pass; missing values are the null level."""
    return (
        _stacked(df, columns, group, words, "string", "level")
        .groupBy("variable", "group", "level")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _expected(observed: str, total: str, corrected: bool) -> str:
    """A cell's part of the chi-square statistic, if wanted with Yates' correction, which two levels get."""
    expected = f"((left + right) * double({total}) / nullif(all_left + all_right, 0))"
    gap = f"abs({observed} - {expected})"
    gap = f"({gap} - least(0.5D, {gap}))" if corrected else gap
    return f"{gap} * {gap} / nullif({expected}, 0D)"


def _known(count: str) -> str:
    """Whether a level is not missing, told by its count, so that the test stays above the counts and both the
    levels and their totals use one set of them."""
    return f"CASE WHEN level IS NULL THEN 0 ELSE {count} END > 0"


def _totals(counts: DataFrame) -> DataFrame:
    """Rows, missing rows and the first level per variable and group: sums of partial sums, however many levels."""
    return counts.groupBy("variable", "group").agg(
        F.sum("n").alias("group_total"),
        F.expr("coalesce(sum(CASE WHEN level IS NULL THEN n END), 0) AS n_missing"),
        F.min("level").alias("first_level"),
    )


def _beside(rows: DataFrame, few: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with the columns of the one row of ``few`` that has their keys.

    ``few`` has a row or two per variable that the caller named, so it goes to the rows: dealing rows by variable
    would bring all levels of a variable to one task.
    """
    same = F.expr(" AND ".join(f"rows.{k} <=> few.{k}" for k in keys))
    joined = rows.alias("rows").join(F.broadcast(few.alias("few")), same)
    return joined.select("rows.*", *[F.col(f"few.{c}") for c in few.columns if c not in keys])


def contingency(counts: DataFrame) -> DataFrame:
    """Rows of each level in the first and in the second group, missing values as the null level.

    Beside them stand each variable's sums over its levels, its missing rows, its first level, and its test. Sums are
    made per variable and brought back to the levels, so no task holds a variable's levels.
    """
    groups = _with_groups(_totals(counts))

    def of(side: str, value: str) -> str:
        return f"max(CASE WHEN group = {side}_group THEN {value} END)"

    whole = groups.groupBy("variable", "first_group", "second_group").agg(
        *[F.expr(f"{of(g, 'group_total - n_missing')} AS all_{s}") for g, s in (("first", "left"), ("second", "right"))],
        *[F.expr(f"{of(g, 'n_missing')} AS missing_{s}") for g, s in (("first", "left"), ("second", "right"))],
        F.min("first_level").alias("first_level"),
    )
    carried = [c for c in whole.columns if c != "variable"]
    sides = (
        _beside(counts, whole, "variable")
        .groupBy("variable", "level", *carried)
        .agg(
            F.expr("coalesce(sum(n) FILTER (WHERE group = first_group), 0) AS left"),
            F.expr("coalesce(sum(n) FILTER (WHERE group = second_group), 0) AS right"),
        )
    )

    def statistic(corrected: bool) -> Column:
        parts = " + ".join(_expected(side, f"all_{side}", corrected) for side in ("left", "right"))
        return F.expr(f"sum(CASE WHEN level IS NOT NULL THEN {parts} END)")

    tests = (
        sides.groupBy("variable")
        .agg(F.count("level").alias("levels"), statistic(False).alias("plain"), statistic(True).alias("corrected"))
        .selectExpr("variable", "levels", "CASE WHEN levels = 2 THEN corrected ELSE plain END AS statistic", "int(levels - 1) AS freedom")
        .withColumn("pvalue", chi_square_p("statistic", "freedom"))
    )
    return _beside(sides, tests, "variable")


def chi_square(counts: DataFrame) -> DataFrame:
    """Chi-square test of independence per variable, with Yates' correction for two levels."""
    tests = ("statistic", "freedom", "pvalue")
    found = contingency(counts).where(_known("left + right"))
    return found.groupBy("variable").agg(*[F.expr(f"any_value({c}) AS {c}") for c in tests])


def categorical_summary(
    df: DataFrame,
    columns: Sequence[str],
    group: str | None = None,
    words: Sequence[str] = MISSING_WORDS,
) -> DataFrame:
    """Count and percent of each level, of the rows that have one; missing and all rows beside it.

    With a group column, whose two values are compared, each variable gets its chi-square p-value. The
    persons are read once.
    """
    counts = level_counts(df, columns, group, words)
    percent = "n * 100D / (group_total - n_missing) AS percent"
    if group is None:
        totals = _totals(counts).drop("group", "first_level")  # one group, so one row per variable
        return _beside(counts, totals, "variable").where(_known("n")).selectExpr("variable", "group", "level", "n", percent, "n_missing", "group_total")
    both = ", ".join(
        f"named_struct('group', {which}_group, 'n', {side}, 'n_missing', missing_{side}, 'group_total', all_{side} + missing_{side})"
        for which, side in (("first", "left"), ("second", "right"))
    )
    rows = contingency(counts).where(_known("left + right")).selectExpr("variable", "level", f"inline(array({both}))", "pvalue")
    return rows.where("n > 0").selectExpr("variable", "group", "level", "n", percent, "n_missing", "group_total", "pvalue")


def _numbers(df: DataFrame, columns: Sequence[str], group: str | None, words: Sequence[str]) -> DataFrame:
    return _stacked(df, columns, group, words, "double", "value")


def _tested(moments: DataFrame) -> DataFrame:
    """Rows per variable and group with ``n_values``, ``mean`` and ``std``, and the pooled t-test beside them."""

    def of(side: str, column: str) -> str:
        return f"max(CASE WHEN group = {side}_group THEN {column} END) OVER (PARTITION BY variable)"

    sides = _with_groups(moments).selectExpr(
        "*",
        *[f"{of(side, c)} AS {name}_{tag}" for side, tag in (("first", "a"), ("second", "b")) for name, c in (("n", "n_values"), ("mean", "mean"), ("var", "std * std"))],
    )
    pooled = "((n_a - 1) * var_a + (n_b - 1) * var_b) / nullif(n_a + n_b - 2, 0)"
    return sides.selectExpr(
        "*",
        f"(mean_a - mean_b) / nullif(sqrt({pooled} * (1D / nullif(n_a, 0) + 1D / nullif(n_b, 0))), 0D) AS statistic",
        "n_a + n_b - 2 AS freedom",
    ).withColumn("pvalue", student_p("statistic", "freedom"))


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str],
    group: str | None = None,
    words: Sequence[str] = MISSING_WORDS,
) -> DataFrame:
    """Mean, sample deviation, exact median, range and missing rows per variable and group.

    With a group column each variable gets the p-value of its t-test, from the same sums. The persons
    are read twice, for the exact median.
    """
    numbers = _numbers(df, columns, group, words)
    value = F.col("value")
    summary = exact_quantiles(
        numbers,
        ["variable", "group"],
        "value",
        {"median": 0.5},
        {
            "mean": F.avg(value),
            "std": F.stddev_samp(value),
            "min": F.min(value),
            "max": F.max(value),
            "n_values": F.count(value),
            "n_missing": F.count_if(value.isNull()),
            "group_total": F.count(F.lit(1)),
        },
    )
    shown = ["variable", "group", "mean", "std", "median", "min", "max", "n_missing", "group_total"]
    return summary.select(*shown) if group is None else _tested(summary).select(*shown, "pvalue")


def t_test(
    df: DataFrame, columns: Sequence[str], group: str, words: Sequence[str] = MISSING_WORDS
) -> DataFrame:
    """Two-sample t-test with pooled variance per variable; missing values are left out."""
    moments = _numbers(df, columns, group, words).groupBy("variable", "group").agg(
        F.count("value").alias("n_values"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )
    tests = ("statistic", "freedom", "pvalue")
    return _tested(moments).groupBy("variable").agg(*[F.expr(f"any_value({c}) AS {c}") for c in tests])


def _share(n: Column, of: Column, digits: int) -> Column:
    """``n (p%)``."""
    percent = F.coalesce(F.try_divide(n * 100.0, of.cast("double")), F.lit(0.0))
    return F.concat(n.cast("string"), F.lit(" ("), rounded_text(percent, digits), F.lit("%)"))


def formatted_table(
    df: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str] = (),
    group: str | None = None,
    words: Sequence[str] = MISSING_WORDS,
    digits: int = 2,
    groups: Sequence[str] | None = None,
) -> DataFrame:
    """Lines of a printed table 1, in order of ``line`` and ``Subgroup``.

    The name, missing rows and p-value of a variable stand on its first line only. A level that a
    group lacks reads ``0 (0.0%)``. Columns are named after the two groups: give ``groups``, in order, or
    they are looked up by reading the group column once more.
    """
    if group is None:
        groups = [ONE_GROUP]
    elif groups is None:
        groups = two_groups(df, group)
    parts = []
    if categorical:
        parts.append(_categorical_lines(df, categorical, group, groups, words, digits))
    if numeric:
        parts.append(_numeric_lines(df, numeric, group, groups, words, digits, len(categorical)))
    if not parts:
        raise ValueError("no variables given")
    lines = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return lines.orderBy("line", "Subgroup")


def _line_columns(groups: Sequence[str], first: Column, missing, counts, pvalue: Column | None) -> list[Column]:
    columns = [F.when(first, F.col("variable")).otherwise("").alias("Group"), F.col("level").alias("Subgroup")]
    for i, g in enumerate(groups):
        suffix = "" if len(groups) == 1 else f"_{g}"
        columns.append(F.when(first, missing[i]).otherwise("").alias(f"Missing{suffix}"))
        columns.append(counts[i].alias(f"Count{suffix}"))
    if pvalue is not None:
        columns.append(F.when(first, pvalue).otherwise("").alias("pvalue"))
    return columns


def _place(columns: Sequence[str], start: int = 0) -> Column:
    names = ", ".join(map(text, columns))
    return F.expr(f"int(array_position(array({names}), variable)) + {start} - 1")


def _categorical_lines(df, columns, group, groups, words, digits) -> DataFrame:
    counts = level_counts(df, columns, group, words)
    if group is None:
        totals = _totals(counts).selectExpr("variable", "group_total - n_missing AS all_left", "n_missing AS missing_left", "first_level")
        lines = _beside(counts.selectExpr("variable", "level", "n AS left"), totals, "variable")
    else:
        lines = contingency(counts)
    sides = ("left", "right")[: len(groups)]
    lines = lines.where(_known("left" if group is None else "left + right"))
    return lines.select(
        _place(columns).alias("line"),
        *_line_columns(
            groups,
            F.col("level") == F.col("first_level"),
            [_share(F.col(f"missing_{s}"), F.col(f"all_{s}") + F.col(f"missing_{s}"), digits) for s in sides],
            [_share(F.col(s), F.col(f"all_{s}"), digits) for s in sides],
            None if group is None else rounded_text(F.col("pvalue"), digits),
        ),
    )


def _numeric_lines(df, columns, group, groups, words, digits, start) -> DataFrame:
    summary = numeric_summary(df, columns, group, words)
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]

    def number(name: str) -> Column:
        shown = rounded_text(F.col(name), digits)
        if name in ("min", "max") and whole:
            shown = F.when(F.col("variable").isin(*whole), F.col(name).cast("bigint").cast("string")).otherwise(shown)
        return shown

    def joined(*names: str) -> Column:
        return F.concat_ws(" ", *[number(n) for n in names])

    shown = summary.select(
        "variable",
        "group",
        *(["pvalue"] if group is not None else []),
        _share(F.col("n_missing"), F.col("group_total"), digits).alias("missing"),
        F.inline(
            F.array(
                F.struct(F.lit("mean std").alias("level"), joined("mean", "std").alias("shown")),
                F.struct(F.lit("median min max").alias("level"), joined("median", "min", "max").alias("shown")),
            )
        ),
    )

    def of(g: str, name: str) -> Column:
        return F.max(F.when(F.col("group") == g, F.col(name)))

    wide = shown.groupBy("variable", "level").agg(
        *[of(g, "missing").alias(f"missing_{i}") for i, g in enumerate(groups)],
        *[of(g, "shown").alias(f"shown_{i}") for i, g in enumerate(groups)],
        *([F.max("pvalue").alias("pvalue")] if group is not None else []),
    )
    return wide.select(
        _place(columns, start).alias("line"),
        *_line_columns(
            groups,
            F.col("level") == "mean std",
            [F.col(f"missing_{i}") for i in range(len(groups))],
            [F.col(f"shown_{i}") for i in range(len(groups))],
            rounded_text(F.col("pvalue"), digits) if group is not None else None,
        ),
    )
