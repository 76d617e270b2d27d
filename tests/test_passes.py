"""How often a result reads the person table: file scans of the plan that ran, and jobs before it ran."""

from __future__ import annotations

import re
import uuid

import pytest

from cohortrates.catalog import preparation_queries, report_queries, result_queries, views
from cohortrates.catalog.settings import INC, PREV
from cohortrates.operators import linkage

SF_DIR = "/root/testdata/sf0.01"

#: Query, and the scans of the cohort it may make.
WANTED = {
    "dsr_all": (result_queries.dsr_all, 1),
    "censor_dsr": (lambda s, d: result_queries.censored_dsr(s, d, PREV), 1),
    "attach_numerators": (lambda s, d: result_queries.counted(s, d, INC), 1),
    "report_series": (report_queries.report_series, 1),
    "error_bars": (report_queries.error_bars, 1),
    "table1_categorical": (report_queries.table1_categorical, 1),
    "table1_categorical_grouped": (lambda s, d: report_queries.table1_categorical(s, d, "has_b"), 1),
    "table1_numeric": (report_queries.table1_numeric, 2),
    "table1_numeric_grouped": (lambda s, d: report_queries.table1_numeric(s, d, "has_b"), 2),
    "table1_formatted": (report_queries.table1_formatted, 3),
    "table1_formatted_grouped": (lambda s, d: report_queries.table1_formatted(s, d, "has_b"), 3),
    "t_test_stat": (report_queries.t_test_stat, 1),
    "chi_square_stat": (report_queries.chi_square_stat, 1),
}


@pytest.fixture(scope="module")
def cohort_file(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cohort") / "person_rows.parquet")
    views.cohort(spark, SF_DIR).write.parquet(path)
    return path


def jobs_of(spark, build):
    """What ``build`` returns, and how many jobs it ran."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        made = build()
        return made, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def scans(df, name: str) -> int:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    ran = plan.split("== Initial Plan ==")[0]
    return len(re.findall(rf"FileScan parquet[^\n]*{name}", ran))


@pytest.mark.parametrize("name", list(WANTED))
def test_person_table_is_read_no_more_than_needed(spark, cohort_file, monkeypatch, name):
    monkeypatch.setattr(views, "cohort", lambda s, d: s.read.parquet(cohort_file))
    build, most = WANTED[name]
    cohort_schema_job = 1  # the file's schema is read when it is opened
    df, jobs = jobs_of(spark, lambda: build(spark, SF_DIR))
    assert jobs <= cohort_schema_job
    assert 1 <= scans(df, "person_rows") <= most


def test_linkage_runs_nothing_early(spark, cohort_file):
    cohort = spark.read.parquet(cohort_file)
    people = cohort.select("PATIENT_ID", "balance")
    records = views.hospital(spark, SF_DIR)
    df, jobs = jobs_of(spark, lambda: linkage.link_one_to_one(people, records, "PATIENT_ID", "patid"))
    assert jobs == 0
    # one pass for the rows with a key, one for those without
    assert scans(df, "person_rows") == 2
    places = cohort.select("PATIENT_ID", "PRACTICE_ID", "PRACTICE_PATIENT_ID")
    _, jobs = jobs_of(spark, lambda: linkage.link_deprivation(places, preparation_queries.views.deprivation(spark, SF_DIR)))
    assert jobs == 0
