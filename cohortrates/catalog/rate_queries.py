"""Registered queries: study grid, crude rates, limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import strata_label
from ..functions.limits import byar_lower, byar_upper
from ..operators import rates
from ..operators.grid import Study
from . import oracle, views
from .settings import (
    CONDITIONS,
    DIGITS,
    INC,
    INC_MONTHLY,
    PREV,
    PREV_MONTHLY,
    PREV_WEEKLY,
    STRATA,
    STUDY_END,
)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Every double column rounded, as the SQL texts do."""
    return df.withColumns({n: F.round(n, digits) for n, t in df.dtypes if t == "double"})


def crude(spark: SparkSession, sf_dir: str, study: Study, strata=(), overall: bool = True) -> DataFrame:
    return rounded(rates.analyse(views.cohort(spark, sf_dir), CONDITIONS, strata, study, overall))


def study_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each study month with the persons under observation on its first day."""
    seen = rates.analyse(views.cohort(spark, sf_dir), CONDITIONS[:1], (), PREV_MONTHLY)
    return seen.select("Date", F.col("Denominator").alias("persons"))


def cohort_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.cohort_long(views.cohort(spark, sf_dir), CONDITIONS, STRATA)


def fill_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = rates.strata_columns(STRATA)
    return rates.fill_strata(views.cohort(spark, sf_dir), names).select("PATIENT_ID", *names)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons per label of a four-way cross."""
    label = strata_label(STRATA[-1]).alias("Subgroup")
    return views.cohort(spark, sf_dir).groupBy(label).agg(F.count(F.lit(1)).alias("persons"))


def crude_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of an earlier extract brought up to date; equal to one run over the present one.

    The earlier extract did not know ``condition_a`` of some persons, and knew ``condition_b`` of nobody. Signed rows of
    these persons, and cells of the further condition, are merged into its cells.
    """
    cohort = views.cohort(spark, sf_dir).select("PATIENT_ID", "INDEX_DATE", "END_DATE", "SEX", *CONDITIONS)
    changed = F.col("PATIENT_ID") % 10 == 3
    earlier = cohort.withColumn("condition_a", F.when(~changed, F.col("condition_a")))
    both = F.array(F.struct(F.lit(1).alias("sign"), F.col("condition_a").alias("a")), F.struct(F.lit(-1).alias("sign"), F.lit(None).cast("date").alias("a")))
    signed = cohort.where(changed).select("INDEX_DATE", "END_DATE", "SEX", F.inline(both)).withColumnRenamed("a", "condition_a")
    first, later = CONDITIONS
    cells = rates.rate_cells(earlier, [first], ["SEX"], [PREV])
    more = rates.rate_cells(signed, [first], ["SEX"], [PREV], sign="sign")
    further = rates.condition_cells(rates.rate_cells(cohort, [later], ["SEX"], [PREV]))
    return rounded(rates.crude_rates(rates.merge_cells(cells, more, further), PREV, CONDITIONS, ["SEX"]))


#: More conditions than one expansion lists.
MANY = [f"c{i}" for i in range(40)]


def crude_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prevalence of many conditions, each of them one that fewer persons have."""
    dates = [F.when(F.col("PATIENT_ID") % 41 > i, F.col("condition_a")).alias(c) for i, c in enumerate(MANY)]
    cohort = views.cohort(spark, sf_dir).select("INDEX_DATE", "END_DATE", "SEX", *dates)
    return rounded(rates.analyse(cohort, MANY, ["SEX"], PREV))


MANY_SQL = oracle.with_views(
    oracle.show_crude(PREV),
    many="select INDEX_DATE, END_DATE, SEX, "
    + ", ".join(f"case when PATIENT_ID % 41 > {i} then condition_a end as {c}" for i, c in enumerate(MANY))
    + " from v_cohort",
    **oracle.crude_ctes(PREV, ["SEX"], MANY, "many"),
)


def byar_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits of the number of persons with a condition per practice, sex and age band."""
    counts = (
        views.cohort(spark, sf_dir)
        .groupBy("PRACTICE_ID", "SEX", "AGE_CATEGORY")
        .agg(F.count("condition_b").alias("cases"), F.count(F.lit(1)).alias("persons"))
    )
    return rounded(
        counts.select(
            "*",
            (byar_lower("cases") / F.col("persons")).alias("lower"),
            (byar_upper("cases") / F.col("persons")).alias("upper"),
        )
    )


def _crude(study: Study, strata=(), overall: bool = True):
    return lambda spark, sf_dir: crude(spark, sf_dir, study, strata, overall)


GROUPED = "\"Group\" <> 'Overall'"

LONG = oracle.with_views(
    'select i as INDEX_DATE, x as END_DATE, "Condition", e as EVENT_DATE, "Group", Subgroup from longs',
    longs=oracle.long_form(CONDITIONS, STRATA),
)

FIRST, LAST = PREV_MONTHLY.grid.dates[0], STUDY_END

GRID_SQL = f"""
with recursive v_cohort as ({views.V_COHORT}),
points(d) as (
    select date '{FIRST}'
    union all
    select cast(d + interval 1 month as date) from points
    where cast(d + interval 1 month as date) <= date '{LAST}' + 1
)
select d as "Date", cast(sum(case when INDEX_DATE <= d and END_DATE >= d then 1 else 0 end) as bigint) as persons
from points, v_cohort group by d
"""

BYAR_SQL = oracle.with_views(
    "select PRACTICE_ID, SEX, AGE_CATEGORY, cases, persons, "
    f"{oracle.rounded(oracle.byar('cases', False) + ' / persons')} as lower, "
    f"{oracle.rounded(oracle.byar('cases', True) + ' / persons')} as upper from counts",
    counts="select PRACTICE_ID, SEX, AGE_CATEGORY, count(condition_b) as cases, count(*) as persons "
    "from v_cohort group by all",
)

FILLED_SQL = oracle.with_views(
    "select PATIENT_ID, "
    + ", ".join(f"coalesce({c}, 'null') as {c}" for c in rates.strata_columns(STRATA))
    + " from v_cohort"
)

LABEL_SQL = oracle.with_views(
    "select coalesce(BALANCE_BAND, 'null') || ', ' || PRACTICE_ID || ', ' || SEX || ', ' || FOLLOW_UP as Subgroup, "
    "count(*) as persons from v_cohort group by 1"
)

QUERIES = {
    "prevalence_overall": (_crude(PREV), oracle.crude(PREV)),
    "incidence_overall": (_crude(INC), oracle.crude(INC)),
    "prevalence_grouped": (_crude(PREV, STRATA, False), oracle.crude(PREV, STRATA, GROUPED)),
    "incidence_grouped": (_crude(INC, STRATA, False), oracle.crude(INC, STRATA, GROUPED)),
    "crude_prevalence": (_crude(PREV, STRATA), oracle.crude(PREV, STRATA)),
    "crude_incidence": (_crude(INC, STRATA), oracle.crude(INC, STRATA)),
    "incidence_monthly": (_crude(INC_MONTHLY, ["SEX", "pat_catg_b"]), oracle.crude(INC_MONTHLY, ["SEX", "pat_catg_b"])),
    "prevalence_weekly": (_crude(PREV_WEEKLY, ["SEX"]), oracle.crude(PREV_WEEKLY, ["SEX"])),
    "incidence_by_practice": (_crude(INC, [["PRACTICE_ID", "SEX"]]), oracle.crude(INC, [["PRACTICE_ID", "SEX"]])),
    "study_grid": (study_grid, GRID_SQL),
    "byar_limits": (byar_limits, BYAR_SQL),
    "cohort_long": (cohort_long, LONG),
    "fill_strata": (fill_strata, FILLED_SQL),
    "strata_label": (labels, LABEL_SQL),
    "crude_many_conditions": (crude_many, MANY_SQL),
    "crude_union": (crude_union, oracle.crude(PREV, ["SEX"])),
}
