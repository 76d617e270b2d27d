"""Registered queries: standardisation and disclosure control."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import cleaning, disclosure, rates, standardise
from ..operators.grid import PREVALENCE, Study
from ..sources.maps import population_weights
from . import oracle, views
from .preparation_queries import QUERIES as PREPARATION
from .rate_queries import rounded
from .settings import AGE_BINS, AGE_LABELS, BREAKDOWNS, CONDITIONS, INC, PREV, SMALL_COUNT

GROUP_LISTS = [g.split(", ") for g in standardise.breakdown_groups(BREAKDOWNS)]
NAMES = rates.strata_columns(GROUP_LISTS)


def typed_crude(spark: SparkSession, sf_dir: str, study: Study, strata=GROUP_LISTS, overall: bool = True) -> DataFrame:
    """Crude rates of the groups that standardisation needs, with their stratum columns."""
    return rates.analyse(views.cohort(spark, sf_dir), CONDITIONS, strata, study, overall, keep_strata=True)


def weights_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return population_weights(views.reference_population(spark, sf_dir), AGE_BINS, AGE_LABELS)


def standardised_from(crude: DataFrame, weights: DataFrame, study: Study, breakdowns=BREAKDOWNS) -> DataFrame:
    parts = standardise.std_parts(crude, standardise.breakdown_groups(breakdowns))
    return standardise.standardise(parts, weights, breakdowns, study.measure)


def standardised(spark: SparkSession, sf_dir: str, study: Study, names) -> DataFrame:
    chosen = {n: BREAKDOWNS[n] for n in names}
    strata = [g.split(", ") for g in standardise.breakdown_groups(chosen)]
    crude = typed_crude(spark, sf_dir, study, strata, overall=False)
    return standardised_from(crude, weights_of(spark, sf_dir), study, chosen)


def dsr_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both measures, every condition and breakdown, from one pass of the cohort."""
    both = [INC, PREV]
    cells = rates.rate_cells(views.cohort(spark, sf_dir), CONDITIONS, GROUP_LISTS, both)
    crude = rates.crude_rates(cells, both, CONDITIONS, GROUP_LISTS, overall=False, keep_strata=True)
    parts = standardise.std_parts(crude, standardise.breakdown_groups(BREAKDOWNS))
    return rounded(standardise.standardise(parts, weights_of(spark, sf_dir), BREAKDOWNS, standardise.RATE, keys=["Measure"]))


#: The overall rate from the cells of a finer group.
POOLED = {"Overall": "AGE_CATEGORY, SEX, BALANCE_BAND"}


def dsr_overall_pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One overall rate per condition and date, from cells that are told apart by balance too."""
    crude = typed_crude(spark, sf_dir, PREV, [g.split(", ") for g in POOLED.values()], overall=False)
    return rounded(standardised_from(crude, weights_of(spark, sf_dir), PREV, POOLED))


def numerators(spark: SparkSession, sf_dir: str, study: Study) -> DataFrame:
    return disclosure.crude_numerators(typed_crude(spark, sf_dir, study), BREAKDOWNS)


def counted_dsr(spark: SparkSession, sf_dir: str, study: Study) -> DataFrame:
    """Standardised rates with their crude cases, from one pass of the cohort."""
    parts = standardise.std_parts(typed_crude(spark, sf_dir, study), standardise.breakdown_groups(BREAKDOWNS), whole=True)
    return standardise.standardise(parts, weights_of(spark, sf_dir), BREAKDOWNS, study.measure, counted=True)


def counted(spark: SparkSession, sf_dir: str, study: Study) -> DataFrame:
    return rounded(counted_dsr(spark, sf_dir, study))


def censored_dsr(spark: SparkSession, sf_dir: str, study: Study) -> DataFrame:
    return rounded(disclosure.suppress_standardised(counted_dsr(spark, sf_dir, study), SMALL_COUNT, study.measure))


def labelled(spark: SparkSession, sf_dir: str, study: Study) -> DataFrame:
    return typed_crude(spark, sf_dir, study).drop(*NAMES)


def censored_crude(spark: SparkSession, sf_dir: str, study: Study) -> DataFrame:
    return rounded(disclosure.suppress_crude(labelled(spark, sf_dir, study), SMALL_COUNT, study.measure))


def split_std_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(standardise.split_std_group(labelled(spark, sf_dir, PREV)).drop("Lower_CI", "Upper_CI"))


def drop_intersex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardise.drop_intersex(split_std_group(spark, sf_dir))


def drop_intersex_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(disclosure.drop_intersex_label(labelled(spark, sf_dir, PREV)))


def exclude_subgroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates without one practice; the cells of the overall rate stay."""
    return standardise.exclude_subgroups(split_std_group(spark, sf_dir), ["p3"])


def scrub_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly prevalence over years in which nobody was under observation yet or any more."""
    crude = rates.analyse(views.cohort(spark, sf_dir), CONDITIONS, [["PRACTICE_ID", "AGE_CATEGORY"]], SCRUB)
    return rounded(standardise.scrub_rates(crude, PREVALENCE))


def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cleaning.clean_condition_names(labelled(spark, sf_dir, PREV)))


SCRUB = Study(PREVALENCE, PREV.grid.between(PREV.grid.dates[0].replace(year=1994), PREV.grid.dates[-1].replace(year=2003)))

TOP = ", ".join(f"'{g}'" for g in standardise.breakdown_groups(BREAKDOWNS))


def rest_label(item: list[str]) -> str:
    """SQL of the label that remains after age and sex."""
    values = [f"replace({c}, ' ', '')" for c in item[2:]]
    return " || ', ' || ".join(values) or "''"


def ctes(study: Study) -> dict[str, str]:
    """Crude rates, their cells, weights, standardised rates and cases as SQL frames."""
    rest = " ".join(f"when '{', '.join(item)}' then {rest_label(item)}" for item in GROUP_LISTS)
    names = " union all ".join(
        f"select '{name}' as breakdown, '{group}' as grp" for name, group in BREAKDOWNS.items()
    )
    base = oracle.crude_ctes(study, GROUP_LISTS)
    per = rates.PER_PERSONS
    limit = "(weighted / total + sqrt(spread / (total * total) / cases) * ({} - cases)) * " + str(per)
    measure = study.measure
    return base | {
        "parts": f"select *, case \"Group\" {rest} end as rest, "
        "replace(AGE_CATEGORY, ' ', '') || ', ' || replace(SEX, ' ', '') as std_group "
        f"from crude where \"Group\" in ({TOP}) and SEX <> 'I'",
        "weights": PREPARATION["ref_population"][1],
        "names": names,
        "sums": "select \"Condition\", breakdown, rest, \"Date\", sum(weight) as total, "
        "sum(cast(weight as double) * Numerator / Denominator) as weighted, "
        "sum(cast(weight as double) * weight * Numerator / (cast(Denominator as double) * Denominator)) as spread, "
        "sum(Numerator) as cases, bool_or(weight is null or Denominator = 0) as void "
        "from parts join names on grp = \"Group\" left join weights using (std_group) "
        "where rest <> 'Ireland' or breakdown = 'Overall' group by all",
        "dsr": "select \"Condition\", case breakdown when 'Overall' then 'Overall' else rest end as Subgroup, "
        f"breakdown as \"Group\", \"Date\", weighted / total * {per} as {measure}, "
        f"case when cases > 0 then {limit.format(oracle.byar('cases', False))} end as Lower_CI, "
        f"case when cases > 0 then {limit.format(oracle.byar('cases', True))} end as Upper_CI "
        "from sums where not void",
        "cases": "select \"Condition\", breakdown as \"Group\", rest as Subgroup, \"Date\", "
        "cast(sum(Numerator) as bigint) as Numerator from parts join names on grp = \"Group\" "
        "where breakdown <> 'Overall' group by all "
        "union all select \"Condition\", 'Overall', 'Overall', \"Date\", Numerator from crude where \"Group\" = 'Overall'",
        "counted_dsr": "select dsr.*, cases.Numerator from dsr left join cases using (\"Condition\", \"Group\", Subgroup, \"Date\")",
    }


def show_dsr(study: Study, where: str = "true", measure: str | None = None) -> str:
    name = measure or study.measure
    return oracle.with_views(
        f'select "Condition", Subgroup, "Group", "Date", {oracle.rounded(study.measure)} as {name}, '
        f"{oracle.rounded('Lower_CI')} as Lower_CI, {oracle.rounded('Upper_CI')} as Upper_CI from dsr where {where}",
        **ctes(study),
    )


def pooled_sql() -> str:
    frames = ctes(PREV)
    pooled = frames["sums"].replace("from parts join names on grp = \"Group\"", f"from (select *, 'Overall' as breakdown from parts where \"Group\" = '{POOLED['Overall']}')")
    frames["sums"] = pooled.replace("breakdown, rest, \"Date\"", "breakdown, \"Date\"")
    frames["dsr"] = frames["dsr"].replace("case breakdown when 'Overall' then 'Overall' else rest end", "'Overall'")
    shown = f'select "Condition", Subgroup, "Group", "Date", {oracle.rounded(PREV.measure)} as {PREV.measure}, '
    return oracle.with_views(
        f"{shown}{oracle.rounded('Lower_CI')} as Lower_CI, {oracle.rounded('Upper_CI')} as Upper_CI from dsr",
        **{k: frames[k] for k in ("longs", "grid", "counted", "crude", "parts", "weights", "sums", "dsr")},
    )


def show_both(study: Study, censor: bool) -> str:
    values = [study.measure, "Lower_CI", "Upper_CI"]
    safe = f"Numerator > {SMALL_COUNT}"
    columns = [
        (f"case when {safe} then {oracle.rounded(v)} end" if censor else oracle.rounded(v)) + f" as {v}" for v in values
    ]
    extra = "" if censor else ", Numerator"
    return oracle.with_views(
        f'select "Condition", Subgroup, "Group", "Date", {", ".join(columns)}{extra} from counted_dsr', **ctes(study)
    )


def censor_crude_sql(study: Study) -> str:
    counts = [f"case when {c} > {SMALL_COUNT} then {oracle.rounded(c) if c == 'Denominator' and study is INC else c} end as {c}"
              for c in ("Numerator", "Denominator")]
    safe = f"Numerator > {SMALL_COUNT} and Denominator > {SMALL_COUNT}"
    values = [f"case when {safe} then {oracle.rounded(v)} end as {v}" for v in (study.measure, "Lower_CI", "Upper_CI")]
    return oracle.with_views(
        f'select "Condition", "Group", Subgroup, "Date", {", ".join(counts + values)} from crude',
        **oracle.crude_ctes(study, GROUP_LISTS),
    )


def numerator_sql(study: Study) -> str:
    return oracle.with_views(
        'select "Condition", "Group", rest as Subgroup, "Date", cast(sum(Numerator) as bigint) as Numerator '
        "from parts where rest <> '' group by all "
        'union all select "Condition", \'Overall\', \'Overall\', "Date", Numerator from crude where "Group" = \'Overall\'',
        **ctes(study),
    )


SPLIT_ROWS = (
    'select "Condition", "Group", "Date", Numerator, Denominator, round(Prevalence, 6) as Prevalence, '
    "array_to_string(list_slice(string_split(replace(Subgroup, ' ', ''), ','), 1, 2), ', ') as std_group, "
    "array_to_string(string_split(replace(Subgroup, ' ', ''), ',')[3:], ', ') as Subgroup from crude"
)


def split_sql(where: str) -> str:
    return oracle.with_views(f"select * from split where {where}", **oracle.crude_ctes(PREV, GROUP_LISTS), split=SPLIT_ROWS)


def scrub_sql() -> str:
    strata = [["PRACTICE_ID", "AGE_CATEGORY"]]
    return oracle.with_views(
        'select "Condition", "Group", Subgroup, "Date", Numerator, Denominator, '
        "coalesce(round(Prevalence, 6), 0) as Prevalence, round(Lower_CI, 6) as Lower_CI, "
        "round(Upper_CI, 6) as Upper_CI from crude",
        **oracle.crude_ctes(SCRUB, strata),
    )


def clean_sql() -> str:
    return oracle.with_views(
        'select regexp_replace("Condition", \'_|:|BD_MEDI\', \'\', \'g\') as "Condition", "Group", Subgroup, "Date", '
        "Numerator, Denominator, round(Prevalence, 6) as Prevalence, round(Lower_CI, 6) as Lower_CI, "
        "round(Upper_CI, 6) as Upper_CI from crude",
        **oracle.crude_ctes(PREV, GROUP_LISTS),
    )


def _dsr(study: Study, *names: str):
    return lambda spark, sf_dir: rounded(standardised(spark, sf_dir, study, names))


def _of(function, study: Study):
    return lambda spark, sf_dir: function(spark, sf_dir, study)


CATG = [n for n in BREAKDOWNS if n != "Overall"]
IS_OVERALL, NOT_OVERALL = "\"Group\" = 'Overall'", "\"Group\" <> 'Overall'"

QUERIES = {
    "split_std_group": (split_std_group, split_sql("true")),
    "drop_intersex": (drop_intersex, split_sql("std_group not like '%, I'")),
    "drop_intersex_label": (
        drop_intersex_label,
        oracle.crude(PREV, GROUP_LISTS, "not (contains(Subgroup, ', I,') or Subgroup like '%, I')"),
    ),
    "exclude_subgroup": (exclude_subgroup, split_sql("Subgroup <> 'p3'")),
    "scrub_rates": (scrub_rates, scrub_sql()),
    "clean_condition_name": (clean_names, clean_sql()),
    "dsr_overall_prev": (_dsr(PREV, "Overall"), show_dsr(PREV, IS_OVERALL)),
    "dsr_overall_inc": (_dsr(INC, "Overall"), show_dsr(INC, IS_OVERALL)),
    "dsr_by_catg_prev": (_dsr(PREV, *CATG), show_dsr(PREV, NOT_OVERALL)),
    "dsr_by_catg_inc": (_dsr(INC, *CATG), show_dsr(INC, NOT_OVERALL)),
    "dsr_all": (
        dsr_all,
        " union all ".join(
            f"select *, '{study.measure}' as Measure from ({show_dsr(study, measure='Rate')})" for study in (INC, PREV)
        ),
    ),
    "dsr_overall_pooled": (dsr_overall_pooled, pooled_sql()),
    "crude_numerator_map": (_of(numerators, PREV), numerator_sql(PREV)),
    "attach_numerators": (_of(counted, INC), show_both(INC, censor=False)),
    "censor_crude_prev": (_of(censored_crude, PREV), censor_crude_sql(PREV)),
    "censor_crude_inc": (_of(censored_crude, INC), censor_crude_sql(INC)),
    "censor_dsr_prev": (_of(censored_dsr, PREV), show_both(PREV, censor=True)),
    "censor_dsr_inc": (_of(censored_dsr, INC), show_both(INC, censor=True)),
}
