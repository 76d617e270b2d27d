"""Registered queries: table 1, tests and chart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import describe, disclosure, rates, series
from . import oracle, views
from .rate_queries import rounded
from .settings import CONDITIONS, INC, PREV, STRATA

CATEGORICAL = ["SEX", "AGE_CATEGORY", "pat_catg_a", "pat_catg_b", "early"]
NUMERIC = ["balance", "follow_up"]
GROUP_BY = "has_b"
GROUPS = ["no", "yes"]

CHART_GROUPS = ["Overall", "SEX", "FOLLOW_UP, BALANCE_BAND", "AGE_CATEGORY, BALANCE_BAND, SEX"]
CHART_CUT = 40
BINS = 12
PANEL_SIZE = 7


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort columns to describe, some values missing, and a group of two."""
    return views.cohort(spark, sf_dir).select(
        "SEX",
        "AGE_CATEGORY",
        "pat_catg_a",
        F.when(F.col("PATIENT_ID") % 17 == 0, "none").otherwise(F.col("pat_catg_b")).alias("pat_catg_b"),
        F.when(F.col("INDEX_DATE") < F.lit("1995-06-01").cast("date"), "early").otherwise("late").alias("early"),
        F.when(F.col("PATIENT_ID") % 13 != 0, F.col("balance")).alias("balance"),
        F.datediff("END_DATE", "INDEX_DATE").alias("follow_up"),
        F.when(F.col("condition_b").isNull(), "no").otherwise("yes").alias("has_b"),
    )


def table1_categorical(spark: SparkSession, sf_dir: str, group: str | None = None) -> DataFrame:
    return rounded(describe.categorical_summary(described(spark, sf_dir), CATEGORICAL, group))


def table1_numeric(spark: SparkSession, sf_dir: str, group: str | None = None) -> DataFrame:
    return rounded(describe.numeric_summary(described(spark, sf_dir), NUMERIC, group))


def chi_square_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(describe.chi_square(describe.level_counts(described(spark, sf_dir), CATEGORICAL, GROUP_BY)))


def t_test_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(describe.t_test(described(spark, sf_dir), NUMERIC, GROUP_BY))


def table1_formatted(spark: SparkSession, sf_dir: str, group: str | None = None) -> DataFrame:
    groups = GROUPS if group else None
    return describe.formatted_table(described(spark, sf_dir), CATEGORICAL, NUMERIC, group, groups=groups)


def charted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crude incidence with small counts suppressed, so that some panels are empty."""
    crude = rates.analyse(views.cohort(spark, sf_dir), CONDITIONS, STRATA, INC)
    return disclosure.suppress_crude(crude, CHART_CUT, INC.measure)


def report_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(series.report_series(charted(spark, sf_dir), INC.measure, CHART_GROUPS))


def panel_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(series.panel_limits(charted(spark, sf_dir), INC.measure))


def split_panel_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prevalence by practice in panels of a few practices each, with one axis per condition."""
    crude = rates.analyse(views.cohort(spark, sf_dir), CONDITIONS, ["PRACTICE_ID"], PREV, overall=False)
    return rounded(series.split_panels(crude, PREV.measure, PANEL_SIZE))


def error_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    crude = rates.analyse(views.cohort(spark, sf_dir), CONDITIONS, [["PRACTICE_ID", "SEX"], "SEX"], PREV)
    return rounded(series.error_bars(crude, PREV.measure))


def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(series.histogram_bins(described(spark, sf_dir), "balance", "pat_catg_a", BINS))


def box_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(series.box_summary(described(spark, sf_dir), "balance", "AGE_CATEGORY", "pat_catg_a"))


def box_whiskers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(series.box_whiskers(spent(spark, sf_dir), "spent", "AGE_CATEGORY", "BALANCE_BAND"))


def box_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(series.box_outliers(spent(spark, sf_dir), "spent", "AGE_CATEGORY", "BALANCE_BAND"))


def spent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons with a number that is skewed: the cube of the balance, which a few have far outside."""
    cube = F.when(F.col("PATIENT_ID") % 13 != 0, F.col("balance") * F.col("balance") * F.col("balance") / 1e6)
    return views.cohort(spark, sf_dir).select("AGE_CATEGORY", "BALANCE_BAND", cube.alias("spent"))


def level_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panels of part sizes, which are numbers, and of part brands, which are not."""
    pairs = F.array(
        F.struct(F.lit("size").alias("Group"), F.col("p_size").cast("string").alias("Subgroup")),
        F.struct(F.lit("brand").alias("Group"), F.col("p_brand").alias("Subgroup")),
    )
    return series.level_panels(views.table(spark, sf_dir, "part").select(F.inline(pairs)), PANEL_SIZE)


DESCRIBED = (
    "select SEX, AGE_CATEGORY, pat_catg_a, case when PATIENT_ID % 17 <> 0 then pat_catg_b end as pat_catg_b, "
    "case when INDEX_DATE < date '1995-06-01' then 'early' else 'late' end as early, "
    "case when PATIENT_ID % 13 <> 0 then balance end as balance, "
    "date_diff('day', INDEX_DATE, END_DATE) as follow_up, "
    "case when condition_b is null then 'no' else 'yes' end as has_b from v_cohort"
)


def stacked(columns: list[str], value: str, group: str | None) -> str:
    label = group or "'group'"
    return " union all ".join(
        f"select '{c}' as variable, {label} as grp, {c if value == 'level' else f'cast({c} as double)'} as {value} from d"
        for c in columns
    )


STEPS = 20_000


def tail(density: str, end: str, source: str) -> str:
    """One minus the integral of a density in ``x`` from 0 to ``end``, by Simpson's rule."""
    weight = f"case when k = 0 or k = {STEPS} then 1 when k % 2 = 1 then 4 else 2 end"
    return (
        f"select variable, 1 - sum({weight} * {density}) * max({end}) / {STEPS} / 3 as pvalue from "
        f"(select *, k * {end} / {STEPS} as x from {source}, (select unnest(range({STEPS} + 1)) as k)) group by variable"
    )


CHI_DENSITY = "2 * pow(x, freedom - 1) * exp(-x * x / 2 - lgamma(freedom / 2.0) - freedom / 2.0 * ln(2))"
T_DENSITY = (
    "2 * exp(lgamma((freedom + 1) / 2.0) - lgamma(freedom / 2.0) - 0.5 * ln(freedom * pi()) "
    "- (freedom + 1) / 2.0 * ln(1 + x * x / freedom))"
)


def category_ctes(group: str | None) -> dict[str, str]:
    return {
        "d": DESCRIBED,
        "stacked": stacked(CATEGORICAL, "level", group),
        "totals": "select variable, grp, count(*) as group_total, count(*) - count(level) as n_missing "
        "from stacked group by all",
        "levels": "select variable, grp, level, count(*) as n from stacked where level is not null group by all",
        "wide": "select variable, level, count(*) filter (grp = 'no') as a, count(*) filter (grp = 'yes') as b "
        "from stacked where level is not null group by all",
        "expected": "select *, (a + b) * ta / (ta + tb) as ea, (a + b) * tb / (ta + tb) as eb from "
        "(select *, cast(sum(a) over (partition by variable) as double) as ta, "
        "cast(sum(b) over (partition by variable) as double) as tb, count(*) over (partition by variable) as k from wide)",
        "tests": "select variable, "
        "sum(pow(abs(a - ea) - case when k = 2 then least(0.5, abs(a - ea)) else 0 end, 2) / ea "
        "+ pow(abs(b - eb) - case when k = 2 then least(0.5, abs(b - eb)) else 0 end, 2) / eb) as statistic, "
        "cast(max(k) - 1 as int) as freedom from expected group by variable",
        "ps": tail(CHI_DENSITY, "sqrt(statistic)", "tests"),
    }


def number_ctes(group: str | None) -> dict[str, str]:
    pooled = "((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)"
    return {
        "d": DESCRIBED,
        "numbers": stacked(NUMERIC, "value", group),
        "summary": "select variable, grp, avg(value) as mean, stddev_samp(value) as std, median(value) as median, "
        "min(value) as min, max(value) as max, count(*) - count(value) as n_missing, count(*) as group_total "
        "from numbers group by all",
        "moments": "select variable, count(value) filter (grp = 'no') as na, avg(value) filter (grp = 'no') as ma, "
        "var_samp(value) filter (grp = 'no') as va, count(value) filter (grp = 'yes') as nb, "
        "avg(value) filter (grp = 'yes') as mb, var_samp(value) filter (grp = 'yes') as vb "
        "from numbers group by variable",
        "ttests": f"select variable, (ma - mb) / sqrt({pooled} * (1.0 / na + 1.0 / nb)) as statistic, "
        "na + nb - 2 as freedom from moments",
        "tps": tail(T_DENSITY, "abs(statistic)", "ttests"),
    }


def categorical_sql(group: str | None) -> str:
    tail_ = ", round(pvalue, 6) as pvalue" if group else ""
    join = " join ps using (variable)" if group else ""
    return oracle.with_views(
        'select variable, grp as "group", level, n, round(n * 100.0 / (group_total - n_missing), 6) as percent, '
        f"n_missing, group_total{tail_} from levels join totals using (variable, grp){join}",
        **category_ctes(group),
    )


def numeric_sql(group: str | None) -> str:
    tail_ = ", round(pvalue, 6) as pvalue" if group else ""
    join = " join tps using (variable)" if group else ""
    values = ", ".join(f"round({c}, 6) as {c}" for c in ("mean", "std", "median", "min", "max"))
    return oracle.with_views(
        f'select variable, grp as "group", {values}, n_missing, group_total{tail_} from summary{join}',
        **number_ctes(group),
    )


def text2(x: str) -> str:
    return f"regexp_replace(cast(cast(round({x}, 2) as decimal(38, 2)) as varchar), '(\\.\\d+?)0+$', '\\1')"


def share(n: str, of: str) -> str:
    return f"{n} || ' (' || {text2(f'{n} * 100.0 / {of}')} || '%)'"


def formatted_sql(group: str | None) -> str:
    """Table lines: categorical variables, then numeric ones."""
    groups = ["no", "yes"] if group else ["group"]
    spots = " ".join(f"when '{c}' then {i}" for i, c in enumerate([*CATEGORICAL, *NUMERIC]))
    line = f"cast(case variable {spots} end as int) as line"
    columns, numbers = [], []
    for g in groups:
        suffix = f"_{g}" if group else ""
        total = f"max(group_total) filter (grp = '{g}')"
        missing = f"max(n_missing) filter (grp = '{g}')"
        columns.append(f"case when level = first_level then {share(f'm{suffix}', f't{suffix}')} else '' end as Missing{suffix}")
        columns.append(f"{share(f'n{suffix}', f'(t{suffix} - m{suffix})')} as Count{suffix}")
        numbers.append(
            f"case when level = 'mean std' then max({share('n_missing', 'group_total')}) filter (grp = '{g}') else '' end as Missing{suffix}"
        )
        numbers.append(f"max(shown) filter (grp = '{g}') as Count{suffix}")
    sides = ", ".join(
        f"coalesce(max(n) filter (grp = '{g}'), 0) as n{f'_{g}' if group else ''}" for g in groups
    )
    bounds = ", ".join(
        f"max(group_total) filter (grp = '{g}') as t{f'_{g}' if group else ''}, "
        f"max(n_missing) filter (grp = '{g}') as m{f'_{g}' if group else ''}"
        for g in groups
    )
    p1 = f", case when level = first_level then {text2('pvalue')} else '' end as pvalue" if group else ""
    p2 = f", case when level = 'mean std' then {text2('max(pvalue)')} else '' end as pvalue" if group else ""
    j1, j2 = (" join ps using (variable)", " join tps using (variable)") if group else ("", "")
    whole = "case when variable = 'follow_up' then cast(cast({0} as bigint) as varchar) else {1} end"
    both = category_ctes(group) | number_ctes(group) | {
        "sides": f"select variable, level, {sides} from levels group by all",
        "bounds": f"select variable, {bounds} from totals group by all",
        "firsts": "select variable, min(level) as first_level from levels group by all",
        "shown": "select *, 'mean std' as level, " + text2("mean") + " || ' ' || " + text2("std") + " as shown from summary "
        "union all select *, 'median min max', " + text2("median") + " || ' ' || " + whole.format("min", text2("min"))
        + " || ' ' || " + whole.format("max", text2("max")) + " from summary",
    }
    return oracle.with_views(
        f"select {line}, case when level = first_level then variable else '' end as \"Group\", level as Subgroup, "
        f"{', '.join(columns)}{p1} from sides join bounds using (variable) join firsts using (variable){j1} "
        f"union all select {line}, case when level = 'mean std' then variable else '' end, level, "
        f"{', '.join(numbers)}{p2} from shown{j2} group by variable, level",
        **both,
    )


def chart_ctes() -> dict[str, str]:
    safe = f"Numerator > {CHART_CUT} and Denominator > {CHART_CUT}"
    values = ", ".join(f"case when {safe} then {v} end as {v}" for v in (INC.measure, "Lower_CI", "Upper_CI"))
    return oracle.crude_ctes(INC, STRATA) | {
        "charted": f'select "Condition", "Group", Subgroup, "Date", {values} from crude'
    }


def span(x: str) -> str:
    return f"case when {x} = 0 then 0 else ceil({x} / pow(10, floor(log10({x}))) / 0.5) * 0.5 * pow(10, floor(log10({x}))) end"


def limit_ctes(measure: str, source: str) -> dict[str, str]:
    return {
        "ends": f'select "Condition", "Group", case when min({measure}) >= 0 then 0.0 else min({measure}) * (1 + 1 / 6.5) end as y_min, '
        f"max({measure}) + max({measure}) / 6.5 as y_top from {source} where {measure} is not null group by all",
        "limits": f"select *, {span('(y_top - y_min)')} as span from ends",
    }


SERIES_SQL = oracle.with_views(
    'select "Condition", "Group", coalesce(Subgroup, \'Null\') as Subgroup, "Date", round(Incidence, 6) as Incidence, round(Lower_CI, 6) as Lower_CI, '
    "round(Upper_CI, 6) as Upper_CI from charted where \"Group\" in ("
    + ", ".join(f"'{g}'" for g in CHART_GROUPS)
    + ") and Incidence is not null",
    **chart_ctes(),
)

LIMIT_SQL = oracle.with_views(
    'select "Condition", "Group", round(y_min, 6) as y_min, round(y_min + span, 6) as y_max, round(span / 50, 6) as tick from limits',
    **(chart_ctes() | limit_ctes(INC.measure, "charted")),
)

SPLIT_SQL = oracle.with_views(
    'select "Condition", "Group", panel, levels, points, round(y_min, 6) as y_min, round(y_min + span, 6) as y_max, round(span / 50, 6) as tick '
    'from parts join limits using ("Condition", "Group")',
    **(oracle.crude_ctes(PREV, ["PRACTICE_ID"]) | {"shown": f"select * from crude where {PREV.measure} is not null and \"Group\" <> 'Overall'"} | limit_ctes(PREV.measure, "shown")),
    places="select Subgroup, cast((dense_rank() over (order by Subgroup) - 1) // %d as int) as panel from (select distinct Subgroup from shown)" % PANEL_SIZE,
    parts='select "Condition", "Group", panel, count(distinct Subgroup) as levels, count(*) as points from shown join places using (Subgroup) group by all',
)

ERROR_SQL = oracle.with_views(
    'select "Condition", "Group", Subgroup, "Date", round(Prevalence, 6) as Prevalence, '
    "round(least(coalesce(Upper_CI, y_min + span), y_min + span) - Prevalence, 6) as error_up, "
    "round(Prevalence - greatest(coalesce(Lower_CI, y_min), y_min), 6) as error_down "
    'from crude join limits using ("Condition", "Group") where Prevalence is not null',
    **(oracle.crude_ctes(PREV, [["PRACTICE_ID", "SEX"], "SEX"]) | limit_ctes(PREV.measure, "crude")),
)

HISTOGRAM_SQL = oracle.with_views(
    f"select coalesce(pat_catg_a, 'Null') as Subgroup, cast(least(floor((balance - low) * {BINS} / (high - low)) + 1, {BINS}) as int) as bin, "
    f"round(low + (bin - 1) * (high - low) / {BINS}, 6) as lower, round(low + bin * (high - low) / {BINS}, 6) as upper, "
    "count(*) as n from d, (select min(balance) as low, max(balance) as high from d) "
    "where balance is not null group by 1, bin, low, high",
    d=DESCRIBED,
)

BOX_SQL = oracle.with_views(
    "select coalesce(pat_catg_a, 'Null') as Subgroup, AGE_CATEGORY, round(min(balance), 6) as low, round(max(balance), 6) as high, count(balance) as n, "
    "round(quantile_cont(balance, 0.25), 6) as q1, round(quantile_cont(balance, 0.5), 6) as median, "
    "round(quantile_cont(balance, 0.75), 6) as q3 from d where balance is not null group by all",
    d=DESCRIBED,
)

FENCED = {
    "d": "select AGE_CATEGORY, coalesce(BALANCE_BAND, 'Null') as Subgroup, case when PATIENT_ID % 13 <> 0 then balance * balance * balance / 1e6 end as y from v_cohort",
    "boxes": "select Subgroup, AGE_CATEGORY, min(y) as low, max(y) as high, count(y) as n, quantile_cont(y, 0.25) as q1, quantile_cont(y, 0.5) as median, "
    "quantile_cont(y, 0.75) as q3 from d where y is not null group by all",
    "fenced": f"select d.*, low, high, n, q1, median, q3, q1 - {series.FENCE} * (q3 - q1) as lower_fence, q3 + {series.FENCE} * (q3 - q1) as upper_fence "
    "from d join boxes using (Subgroup, AGE_CATEGORY) where y is not null",
}

WHISKER_SQL = oracle.with_views(
    "select Subgroup, AGE_CATEGORY, "
    + ", ".join(f"round({c}, 6) as {c}" for c in ("q1", "median", "q3", "low", "high"))
    + ", n, round(min(y) filter (where y between lower_fence and upper_fence), 6) as lower_whisker, "
    "round(max(y) filter (where y between lower_fence and upper_fence), 6) as upper_whisker, "
    "count(*) filter (where not (y between lower_fence and upper_fence)) as n_outliers from fenced "
    "group by Subgroup, AGE_CATEGORY, q1, median, q3, low, high, n",
    **FENCED,
)

OUTLIER_SQL = oracle.with_views(
    "select Subgroup, AGE_CATEGORY, round(y, 6) as y, count(*) as n from fenced where not (y between lower_fence and upper_fence) group by Subgroup, AGE_CATEGORY, fenced.y",
    **FENCED,
)

PANELS_SQL = f"""
with levels as (
    select distinct 'size' as "Group", cast(p_size as varchar) as level, p_size as size from part
    union all
    select distinct 'brand', p_brand, 0 from part
),
places as (select "Group", level, row_number() over (partition by "Group" order by size, level) as place from levels)
select "Group", level, cast(place as int) as place, cast((place - 1) // {PANEL_SIZE} as int) as panel from places
"""


def _grouped(function):
    return lambda spark, sf_dir: function(spark, sf_dir, GROUP_BY)


QUERIES = {
    "table1_categorical": (table1_categorical, categorical_sql(None)),
    "table1_categorical_grouped": (_grouped(table1_categorical), categorical_sql(GROUP_BY)),
    "table1_numeric": (table1_numeric, numeric_sql(None)),
    "table1_numeric_grouped": (_grouped(table1_numeric), numeric_sql(GROUP_BY)),
    "chi_square_stat": (
        chi_square_stat,
        oracle.with_views(
            "select variable, round(statistic, 6) as statistic, freedom, round(pvalue, 6) as pvalue "
            "from tests join ps using (variable)",
            **category_ctes(GROUP_BY),
        ),
    ),
    "t_test_stat": (
        t_test_stat,
        oracle.with_views(
            "select variable, round(statistic, 6) as statistic, freedom, round(pvalue, 6) as pvalue "
            "from ttests join tps using (variable)",
            **number_ctes(GROUP_BY),
        ),
    ),
    "table1_formatted": (table1_formatted, formatted_sql(None)),
    "table1_formatted_grouped": (_grouped(table1_formatted), formatted_sql(GROUP_BY)),
    "report_series": (report_series, SERIES_SQL),
    "panel_limits": (panel_limits, LIMIT_SQL),
    "split_panel_limits": (split_panel_limits, SPLIT_SQL),
    "error_bars": (error_bars, ERROR_SQL),
    "histogram_bins": (histogram_bins, HISTOGRAM_SQL),
    "box_summary": (box_summary, BOX_SQL),
    "box_whiskers": (box_whiskers, WHISKER_SQL),
    "box_outliers": (box_outliers, OUTLIER_SQL),
    "level_panels": (level_panels, PANELS_SQL),
}
