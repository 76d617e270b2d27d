"""The five stages of a study, driven by one configuration mapping.

``process -> incprev -> strd -> censor -> report``. Each reads what the one before wrote. Results are
kept as parquet, with their stratum columns, and beside it as CSV for people. Person-level rows are
read by ``process``, once by ``incprev`` for both measures, and by the table of ``report``.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..operators import cleaning, describe, disclosure, linkage, rates, series, standardise
from ..operators.grid import INCIDENCE, PREVALENCE, Study, StudyGrid
from ..sources import keyed, maps, tables

Config = Mapping[str, Any]

PROCESSED = "dat_processed.parquet"
LINK_STATS = "LINK_STATS.csv"
MATCHED = "practices_matched.parquet"
KEPT, KEPT_RECORDS = "dat_by_person", "records_by_person"
PUBLISH = "Publish/"
SHORT = {INCIDENCE: "inc", PREVALENCE: "prev"}


#: The order of rows in result files for people.
RESULT_ORDER = ("Condition", "Group", "Subgroup", "Date")


def _write(df: DataFrame, path: str, drop=()) -> None:
    """``path``.parquet, and ``path``.csv read back from it, so that nothing is computed twice."""
    tables.write_parquet(df, f"{path}.parquet")
    tables.write_csv(df.sparkSession.read.parquet(f"{path}.parquet").drop(*drop), f"{path}.csv", RESULT_ORDER)


def _cleaned(spark: SparkSession, path: str, aside: bool = False) -> DataFrame:
    """The extract with formatted nulls and names; text files become columnar once, here.

    Malformed rows of a text file fail the stage, or with ``aside`` go to a file of their own.
    """
    is_text = path.endswith(".csv")
    if is_text and aside:
        found = tables.read_csv(spark, path)
        tables.write_csv(found.malformed, f"{path.removesuffix('.csv')}_malformed.csv", ["file", "row"])
        df = found.rows
    else:
        df = tables.scan(spark, path)
    df = cleaning.strip_codelist_suffix(cleaning.empty_to_null(df))
    if not is_text:
        return df
    target = f"{path.removesuffix('.csv')}_formNulls.parquet"
    tables.write_parquet(df, target)
    return spark.read.parquet(target)


def process(spark: SparkSession, config: Config) -> DataFrame:
    """Clean, link, merge and recode the extracts into one cohort table."""
    options, root = config["processing"], config["dir_data"]
    fmt, aside = config.get("date_fmt", "%Y-%m-%d"), bool(options.get("malformed_aside"))
    if options.get("filename"):
        cohort = _cleaned(spark, f"{root}{options['filename']}", aside)
    else:
        a = _cleaned(spark, f"{root}{options['filename_gold']}", aside)
        b = _cleaned(spark, f"{root}{options['filename_aurum']}", aside)
        practices = maps.read_practice_map(
            spark, f"{root}{options['map_file_AtoB']}", sep=options.get("map_delim_AtoB", "\t")
        )
        tables.write_parquet(linkage.match_practices(practices, a, b), f"{root}{MATCHED}")
        matched = spark.read.parquet(f"{root}{MATCHED}")
        if options.get("all_as_text"):
            a, b = cleaning.all_to_text(a), cleaning.all_to_text(b)
        tables.write_csv(linkage.link_stats(matched), f"{root}{LINK_STATS}")
        cohort = linkage.link_practices(matched, a, b)
    if options.get("path_hes"):
        records = tables.scan(spark, options["path_hes"])
        own, theirs = options["col_patid_cprd"], options["col_patid_hes"]
        if options.get("link_buckets"):  # both kept by key on the way, for linkage without a shuffle and again
            kept = keyed.write_keyed(cohort, own, f"{root}{KEPT}", options["link_buckets"], T.StringType())
            found = keyed.write_keyed(records, theirs, f"{root}{KEPT_RECORDS}", options["link_buckets"], T.StringType())
            cohort = linkage.link_kept(kept, found).rows
        else:
            cohort = linkage.link_one_to_one(cohort, records, own, theirs)
    if options.get("mergeCols_AtoB"):
        cohort = cleaning.merge_condition_dates(
            cohort, options["mergeCols_AtoB"], fmt, options.get("rm_old_cols", True)
        )
    if options.get("combineLevels"):
        cohort = cleaning.combine_levels(cohort, options["combineLevels"])
    if options.get("link_imd"):
        lookup = maps.read_deprivation_map(spark, f"{root}{options['imd_map_file']}")
        cohort = linkage.link_deprivation(cohort, lookup)
    tables.write_parquet(cohort, f"{root}{PROCESSED}")
    return spark.read.parquet(f"{root}{PROCESSED}")


def studies(config: Config) -> list[Study]:
    options = config["incprev"]
    months = options.get("INCREMENT_BY_MONTH", 12)

    def day(which: str, short: str) -> date:
        parts = options[which][short]
        return date(parts["year"], parts["month"], parts["day"])

    return [
        Study(measure, StudyGrid.between(day("start_date", short), day("end_date", short), months=months))
        for measure, short in SHORT.items()
    ]


def incprev(spark: SparkSession, config: Config) -> dict[str, DataFrame]:
    """Crude incidence and prevalence of all conditions and breakdowns, from one pass of the cohort."""
    options, out = config["incprev"], config["dir_out"]
    cohort = tables.scan(spark, f"{config['dir_data']}{options['filename']}")
    index_date, end_date = options.get("col_index_date", "INDEX_DATE"), options.get("col_end_date", "END_DATE")
    conditions = options.get("BD_LIST") or tables.discover_conditions(cohort)
    cohort = tables.ingest_dates(cohort, [index_date, end_date, *conditions], config.get("date_fmt", "%Y-%m-%d"))
    strata = options.get("DEMOGRAPHY") or []
    both = studies(config)
    tables.write_parquet(
        rates.rate_cells(cohort, conditions, strata, both, index_date, end_date), f"{out}cells.parquet"
    )
    cells = spark.read.parquet(f"{out}cells.parquet")
    results = {}
    for study in both:
        path = f"{out}{SHORT[study.measure]}_crude"
        crude = rates.crude_rates(cells, study, conditions, strata, keep_strata=True)
        _write(crude, path, rates.strata_columns(strata))
        results[study.measure] = spark.read.parquet(f"{path}.parquet")
    return results


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}.parquet")


def strd(spark: SparkSession, config: Config) -> dict[str, DataFrame]:
    """Rates standardised to the reference population."""
    options, out = config["strd"], config["dir_out"]
    weights = maps.read_reference(
        spark, f"{config['dir_data']}{options['reference_population']}",
        options["age_bins"], options["age_group_labels"],
    )
    breakdowns = options["standard_breakdowns"]
    results = {}
    for measure, short in SHORT.items():
        crude = _read(spark, f"{out}{short}_crude")
        parts = standardise.std_parts(crude, standardise.breakdown_groups(breakdowns))
        _write(standardise.standardise(parts, weights, breakdowns, measure), f"{out}{short}_DSR")
        results[measure] = _read(spark, f"{out}{short}_DSR")
    return results


def censor(spark: SparkSession, config: Config) -> dict[str, DataFrame]:
    """Publishable copies of all results, small counts suppressed."""
    options, out = config["censor"], config["dir_out"]
    n, results = options["n"], {}
    for measure, short in SHORT.items():
        crude = _read(spark, f"{out}{short}_crude")
        labelled = crude.select("Condition", "`Group`", "Subgroup", "Date", "Numerator", "Denominator", measure, *series.LIMITS)
        published = cleaning.clean_condition_names(disclosure.suppress_crude(labelled, n, measure))
        _write(published, f"{out}{PUBLISH}{short}_crude")
        results[f"{short}_crude"] = _read(spark, f"{out}{PUBLISH}{short}_crude")
        if options.get("strd"):
            breakdowns = config["strd"]["standard_breakdowns"]
            standardised = _read(spark, f"{out}{short}_DSR")
            numerators = disclosure.crude_numerators(crude, breakdowns)
            counted = disclosure.attach_numerators(standardised, numerators, breakdowns)
            safe = disclosure.suppress_standardised(counted, n, measure)
            _write(safe, f"{out}{PUBLISH}{short}_DSR")
            results[f"{short}_DSR"] = _read(spark, f"{out}{PUBLISH}{short}_DSR")
    return results


def report(spark: SparkSession, config: Config) -> None:
    """Table 1, and series with panel limits and error bars for all results and published results.

    Results that no earlier stage has published are passed over.
    """
    options, out = config["report"], config["dir_out"]
    if options.get("table1"):
        cohort = tables.scan(spark, f"{config['dir_data']}{config['incprev']['filename']}")
        table = describe.formatted_table(cohort, options["table1_catgs"], options["table1_nums"])
        tables.write_csv(table, f"{out}table1.csv")
    for root in (out, f"{out}{PUBLISH}"):
        for kind, groups in (("crude", "catgs_crude"), ("DSR", "catgs_strd")):
            if not options.get("crude" if kind == "crude" else "strd"):
                continue
            for measure, short in SHORT.items():
                try:
                    results = _read(spark, f"{root}{short}_{kind}").where(F.col("Group").isin(*options[groups]))
                except AnalysisException as error:
                    if root == out or error.getCondition() != "PATH_NOT_FOUND":
                        raise
                    continue
                target = f"{root}report/{short}_{kind}"
                tables.write_csv(series.report_series(results, measure, options[groups]), f"{target}_series.csv")
                tables.write_csv(series.panel_limits(results, measure), f"{target}_limits.csv")
                tables.write_csv(series.error_bars(results, measure), f"{target}_error_bars.csv")


STAGES = {"process": process, "incprev": incprev, "strd": strd, "censor": censor, "report": report}


def run(spark: SparkSession, config: Config, names=tuple(STAGES)) -> None:
    """Run stages in the order given."""
    for name in names:
        STAGES[name](spark, config)
