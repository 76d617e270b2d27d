"""Chart-ready tables: the data behind each figure of a report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import named, quoted
from .quantiles import exact_quantiles

PANEL = ["Condition", "Group"]
LIMITS = ["Lower_CI", "Upper_CI"]

#: Room above the highest value: one part in this many.
HEADROOM = 6.5

#: Ticks of a value axis, and the parts each is divided in.
TICKS = 5
TICK_PARTS = 10


#: The largest number that is not infinite.
MOST = 1.7976931348623157e308

#: Subgroup of rows without one, and of everybody where no subgroup is asked for.
NO_SUBGROUP = "Null"
EVERYBODY = "Overall"


def without(results: DataFrame, ignore: Sequence[str], column: str = "Subgroup") -> DataFrame:
    """Rows whose label is none of ``ignore`` and does not quote one of them."""
    label = named(column)
    for word in ignore:
        results = results.where(label.isNull() | ~((label == word) | label.contains(f"'{word}'")))
    return results


def _subgroup(column: str | None) -> Column:
    if column is None:
        return F.lit(EVERYBODY).alias("Subgroup")
    return F.coalesce(named(column).cast("string"), F.lit(NO_SUBGROUP)).alias("Subgroup")


def drop_missing(results: DataFrame, measure: str) -> DataFrame:
    """Rows with a value that can be drawn: neither missing nor NaN nor infinite."""
    value = named(measure).cast("double")
    return results.where(value.between(-MOST, MOST))


def _in_order(column: str, panel: Sequence[str]) -> tuple[str, str]:
    """SQL to sort the labels of each panel by: as numbers if all are numbers, else as text."""
    keys = ", ".join(quoted(k) for k in panel)
    number = f"try_cast(nullif({quoted(column)}, '{NO_SUBGROUP}') AS double)"
    every = f"bool_and({number} IS NOT NULL OR {quoted(column)} = '{NO_SUBGROUP}') OVER (PARTITION BY {keys})"
    return f"CASE WHEN {every} THEN {number} END", quoted(column)


def report_series(
    results: DataFrame, measure: str, groups: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """Points of each panel in order of subgroup and date. Points without a value are not drawn.

    Missing subgroups read ``Null``; where all others of a panel are numbers, they are ordered as such.
    """
    points = drop_missing(without(results, ignore).where(F.col("Group").isin(*groups)), measure).select(
        *PANEL, _subgroup("Subgroup"), F.col("Date").cast("date").alias("Date"),
        *[named(c).cast("double").alias(c) for c in [measure, *LIMITS]],
    )
    size, label = _in_order("Subgroup", PANEL)
    return points.withColumn("size", F.expr(size)).orderBy(*PANEL, F.col("size").asc_nulls_last(), F.expr(label), "Date").drop("size")


def _rounded_span(span: Column) -> Column:
    """A span rounded up to half of its power of ten."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(span)))
    return F.when(span == 0, 0.0).otherwise(F.ceil(span / power / 0.5) * 0.5 * power)


def _axis(low: Column, high: Column) -> tuple[Column, Column]:
    """Lower end and span of an axis that shows values from ``low`` to ``high``."""
    bottom = F.when(low >= 0, 0.0).otherwise(low + low / HEADROOM)
    return bottom, _rounded_span(high + high / HEADROOM - bottom)


def panel_limits(results: DataFrame, measure: str, panel: Sequence[str] = PANEL) -> DataFrame:
    """Lower and upper end of each panel's value axis, and the distance of its marks.

    With panels made of a larger whole, give the columns of that whole for one axis that all share.
    """
    value = named(measure).cast("double")
    ends = drop_missing(results, measure).groupBy(*panel).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    bottom, span = _axis(F.col("low"), F.col("high"))
    return ends.select(*panel, bottom.alias("y_min"), (bottom + span).alias("y_max"), (span / TICKS / TICK_PARTS).alias("tick"))


def error_bars(results: DataFrame, measure: str, panel: Sequence[str] = PANEL) -> DataFrame:
    """Length of the error bars up and down, ending at the axis where a limit is beyond it or absent.

    Points without a value have none. The axis of a panel is found by a window over its points.
    """
    value, whole = named(measure).cast("double"), Window.partitionBy(*panel)
    points = drop_missing(results, measure).withColumns(
        {"axis low": F.min(value).over(whole), "axis high": F.max(value).over(whole)}
    )
    bottom, span = _axis(named("axis low"), named("axis high"))
    return points.select(
        *[named(c) for c in [*panel, "Subgroup", "Date", measure]],
        (F.least(F.col("Upper_CI").cast("double"), bottom + span) - value).alias("error_up"),
        (value - F.greatest(F.col("Lower_CI").cast("double"), bottom)).alias("error_down"),
    )


def histogram_bins(df: DataFrame, x: str, subgroup: str | None, bins: int) -> DataFrame:
    """Rows per subgroup and equal-width bin of ``x``; the last bin includes the largest value.

    Values that are missing, NaN or infinite lie in no bin. The range of ``x`` is a subquery of the same query, one row
    that every task gets, so nothing is read before the query runs.
    """
    rows = drop_missing(df.select(_subgroup(subgroup), named(x).cast("double").alias("x")), "x")
    ends = rows.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high")).alias("ends")).scalar()
    placed = rows.select("Subgroup", "x", ends.alias("ends")).selectExpr("Subgroup", "x", "ends.low AS low", "ends.high AS high")
    place = f"CASE WHEN high > low THEN least(int((x - low) * {bins} / (high - low)) + 1, {bins}) ELSE 1 END"
    return (
        placed.groupBy("Subgroup", F.expr(place).alias("bin"), "low", "high")
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr(
            "Subgroup", "bin", f"low + (bin - 1) * ((high - low) / {bins}) AS lower", f"low + bin * ((high - low) / {bins}) AS upper", "n"
        )
    )


def box_summary(df: DataFrame, y: str, x: str, subgroup: str | None) -> DataFrame:
    """Quartiles and range of ``y`` per subgroup and ``x``."""
    rows = df.select(_subgroup(subgroup), named(x), named(y).cast("double").alias("y")).where("y IS NOT NULL")
    value = F.col("y")
    return exact_quantiles(
        rows,
        ["Subgroup", x],
        "y",
        {"q1": 0.25, "median": 0.5, "q3": 0.75},
        {"low": F.min(value), "high": F.max(value), "n": F.count(value)},
    )


#: Fences lie so many quartile distances outside of the quartiles.
FENCE = 1.5


def _with_fences(df: DataFrame, y: str, x: str, subgroup: str | None, fence: float) -> DataFrame:
    """Each value of ``y`` with its subgroup, ``x``, and its box's summary and fences."""
    boxes = box_summary(df, y, x, subgroup).selectExpr(
        "Subgroup AS box_subgroup",
        f"{quoted(x)} AS box_x",
        "q1", "median", "q3", "low", "high", "n",
        f"q1 - {fence!r}D * (q3 - q1) AS lower_fence",
        f"q3 + {fence!r}D * (q3 - q1) AS upper_fence",
    )
    rows = df.select(_subgroup(subgroup), named(x), named(y).cast("double").alias("y")).where("y IS NOT NULL AND NOT isnan(y)")
    return rows.join(boxes, F.expr(f"Subgroup <=> box_subgroup AND {quoted(x)} <=> box_x"))


def box_whiskers(df: DataFrame, y: str, x: str, subgroup: str | None, fence: float = FENCE) -> DataFrame:
    """The boxes with their whiskers, which end at the last values inside the fences, and the number of outliers."""
    inside = "y BETWEEN lower_fence AND upper_fence"
    carried = ["q1", "median", "q3", "low", "high", "n"]
    return (
        _with_fences(df, y, x, subgroup, fence)
        .groupBy("Subgroup", named(x), *carried)
        .agg(
            F.expr(f"min(CASE WHEN {inside} THEN y END) AS lower_whisker"),
            F.expr(f"max(CASE WHEN {inside} THEN y END) AS upper_whisker"),
            F.expr(f"count_if(NOT ({inside})) AS n_outliers"),
        )
    )


def box_outliers(df: DataFrame, y: str, x: str, subgroup: str | None, fence: float = FENCE) -> DataFrame:
    """The values outside of the fences, with how often each occurs: the points that a box plot draws one by one."""
    found = _with_fences(df, y, x, subgroup, fence).where("y NOT BETWEEN lower_fence AND upper_fence")
    return found.groupBy("Subgroup", named(x), "y").agg(F.count(F.lit(1)).alias("n"))


def level_panels(
    results: DataFrame,
    max_levels: int,
    level: str = "Subgroup",
    panel: Sequence[str] = ("Group",),
    ignore: Sequence[str] = (),
) -> DataFrame:
    """Levels of each group in order, split into panels of at most ``max_levels``.

    Levels that all read as whole numbers, or else all as numbers, are ordered and shown as such.
    """
    keys = ", ".join(quoted(k) for k in panel)
    levels = without(results, ignore, level).select(*[named(k) for k in panel], named(level).cast("string").alias("level")).distinct()
    kinds = levels.groupBy(*[named(k) for k in panel]).agg(
        F.expr("bool_and(try_cast(level AS bigint) IS NOT NULL)").alias("whole"),
        F.expr("bool_and(try_cast(level AS double) IS NOT NULL)").alias("number"),
    )
    shown = levels.join(kinds, list(panel)).selectExpr(
        *[quoted(k) for k in panel],
        "CASE WHEN whole THEN string(try_cast(level AS bigint)) "
        "WHEN number THEN string(try_cast(level AS double)) ELSE level END AS level",
        "CASE WHEN number THEN try_cast(level AS double) END AS size",
    ).distinct()
    place = f"dense_rank() OVER (PARTITION BY {keys} ORDER BY size, level)"
    return shown.selectExpr(
        *[quoted(k) for k in panel], "level", f"{place} AS place", f"int(({place} - 1) div {max_levels}) AS panel"
    )


def split_panels(results: DataFrame, measure: str, max_levels: int, panel: Sequence[str] = PANEL) -> DataFrame:
    """The panels that charts with many levels are split into: their points, and the one axis that all parts of a chart share."""
    points = drop_missing(results, measure)
    levels = level_panels(points, max_levels)
    # a level may be shown as a number: either way it is told by group and shown text
    whole, number = "string(try_cast(Subgroup AS bigint))", "string(try_cast(Subgroup AS double))"
    listed = points.select(*panel, F.explode(F.expr(f"array_distinct(array_compact(array(Subgroup, {whole}, {number})))")).alias("level"))
    parts = listed.join(levels.select("Group", "level", "panel"), ["Group", "level"])
    counted = parts.groupBy(*panel, "panel").agg(F.countDistinct("level").alias("levels"), F.count(F.lit(1)).alias("points"))
    return counted.join(panel_limits(results, measure, panel), list(panel))
