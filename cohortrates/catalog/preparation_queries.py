"""Registered queries: scans, cleaning, recoding and linkage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, linkage
from ..sources import maps, tables
from . import views
from .oracle import with_views
from .settings import AGE_BINS, AGE_LABELS

A_MAX, B_MIN = 15, 10
DAY_FORMAT = "%d-%m-%Y"


def scan_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns of a parquet table; no others are read."""
    orders = tables.scan_parquet(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_orderdate", "o_orderstatus"])
    return orders.select("o_orderkey", F.to_date("o_orderdate").alias("ordered"), "o_orderstatus")


def ingest_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written without padding, parsed back."""
    dates = ["INDEX_DATE", "END_DATE", "condition_a"]
    text = views.cohort(spark, sf_dir).select(
        "PATIENT_ID", *[F.date_format(d, "d-M-yyyy").alias(d) for d in dates], "condition_b"
    )
    return tables.ingest_dates(text, [*dates, "condition_b"], DAY_FORMAT)


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.cohort(spark, sf_dir).select(
        "PATIENT_ID",
        F.col("condition_a").alias("BD_MEDI:alpha:12"),
        F.col("condition_b").alias("BD_beta"),
        F.col("INDEX_DATE").alias("BD_MEDI:entry"),
        "END_DATE",
    )


def strip_codelist_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.strip_codelist_suffix(_coded(spark, sf_dir))


def discover_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons per discovered condition."""
    coded = strip_codelist_suffix(spark, sf_dir)
    found = tables.discover_conditions(coded)
    counts = coded.agg(*[F.count(f"`{c}`").alias(c) for c in found])
    return counts.unpivot([], [F.col(f"`{c}`") for c in found], "Condition", "persons")


def _with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("PATIENT_ID")
    return views.cohort(spark, sf_dir).select(
        "PATIENT_ID",
        F.when(key % 5 == 0, "").otherwise(F.col("SEX")).alias("SEX"),
        F.when(key % 7 == 0, "MISSING").when(key % 11 == 0, "none").otherwise(F.col("pat_catg_b")).alias("pat_catg_b"),
        "INDEX_DATE",
    )


def empty_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.empty_to_null(_with_blanks(spark, sf_dir))


def sentinels_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.sentinels_to_null(_with_blanks(spark, sf_dir), ["SEX", "pat_catg_b"])


def dates_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.dates_to_text(_with_blanks(spark, sf_dir))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.cohort(spark, sf_dir).select(
        "PATIENT_ID", F.date_format("condition_a", "dd-MM-yyyy").alias("condition_a"), "condition_b", "END_DATE"
    )


MERGES = {"either": ["condition_a", "condition_b"], "alone": ["END_DATE"], "first": ["either", "END_DATE"]}


def merge_condition_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = cleaning.merge_condition_dates(_dated(spark, sf_dir), MERGES, DAY_FORMAT, drop_sources=False)
    return merged.select("PATIENT_ID", "condition_a", "condition_b", "END_DATE", "either", "first")


def merge_drop_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.merge_condition_dates(_dated(spark, sf_dir), MERGES, DAY_FORMAT)


def combine_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    merges = {
        "pat_catg_b": {"OLD WORLD": ["AFRICA", "ASIA", "EUROPE"], "ALL": ["OLD WORLD", "AMERICA"]},
        "pat_catg_a": {"HOME": ["HOUSEHOLD", "FURNITURE"]},
    }
    cohort = views.cohort(spark, sf_dir).select("PATIENT_ID", "pat_catg_a", "pat_catg_b")
    return cleaning.combine_levels(cohort, merges)


def _sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Overlapping extracts: A lacks the deprivation-free columns that B has, and some practice ids."""
    cohort = views.cohort(spark, sf_dir)
    nation = F.substring("PRACTICE_ID", 2, 9).cast("int")
    practice = F.when(F.col("PATIENT_ID") % 29 != 0, F.col("PRACTICE_ID")).alias("PRACTICE_ID")
    a = cohort.where(nation < A_MAX).select("PATIENT_ID", practice, "SEX", F.col("balance").alias("only_a"))
    b = cohort.where(nation >= B_MIN).select(
        F.col("PATIENT_ID").cast("string"), "PRACTICE_ID", "SEX", F.col("pat_catg_a").alias("only_b")
    )
    return a, b


def practice_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pair per supplier, in order of supplier: of the pairs of a nation the last one wins."""
    pairs = views.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("key"),
        F.col("s_suppkey").cast("string").alias("value"),
        F.col("s_suppkey").alias("place"),
    )
    return maps.practice_pairs(pairs)


def ref_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maps.population_weights(views.reference_population(spark, sf_dir), AGE_BINS, AGE_LABELS)


def link_practices(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _sources(spark, sf_dir)
    return linkage.link_practices(linkage.match_practices(views.practice_map(spark, sf_dir), a, b), a, b)


def link_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.link_stats(linkage.match_practices(views.practice_map(spark, sf_dir), *_sources(spark, sf_dir)))


def union_diagonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _sources(spark, sf_dir)
    return linkage.union_diagonal(b, a)


def link_one_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    cohort = views.cohort(spark, sf_dir).select("PATIENT_ID", "INDEX_DATE", F.col("balance").alias("n_items"))
    return linkage.link_one_to_one(cohort, views.hospital(spark, sf_dir), "PATIENT_ID", "patid", dates_as_text=True)


def link_deprivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = views.deprivation(spark, sf_dir).select(
        "pracid", maps.clean_deprivation(F.col("imd")).alias("imd")
    )
    cohort = views.cohort(spark, sf_dir).select("PATIENT_ID", "PRACTICE_ID", "PRACTICE_PATIENT_ID")
    return linkage.link_deprivation(cohort, lookup)


BLANKS = (
    "select PATIENT_ID, case when PATIENT_ID % 5 = 0 then '' else SEX end as SEX, "
    "case when PATIENT_ID % 7 = 0 then 'MISSING' when PATIENT_ID % 11 = 0 then 'none' else pat_catg_b end as pat_catg_b, "
    "INDEX_DATE from v_cohort"
)

SOURCE_A = (
    "select PATIENT_ID, case when PATIENT_ID % 29 <> 0 then PRACTICE_ID end as PRACTICE_ID, SEX, balance as only_a "
    f"from v_cohort where cast(substr(PRACTICE_ID, 2) as int) < {A_MAX}"
)
SOURCE_B = (
    "select PATIENT_ID, PRACTICE_ID, SEX, pat_catg_a as only_b "
    f"from v_cohort where cast(substr(PRACTICE_ID, 2) as int) >= {B_MIN}"
)
BOTH = (
    "select cast(PATIENT_ID as varchar) as PATIENT_ID, PRACTICE_ID, SEX, only_b, null as only_a from b "
    "union all select cast(PATIENT_ID as varchar), PRACTICE_ID, SEX, null, only_a from a"
)
CHECKS = (
    "select id_a, id_b, id_a in (select PRACTICE_ID from a where PRACTICE_ID is not null) as in_a, "
    "id_b in (select PRACTICE_ID from b) as in_b from v_practice_map"
)

MERGED = "select PATIENT_ID, condition_a, condition_b, END_DATE, least(condition_a, condition_b) as either from v_cohort"

QUERIES = {
    "scan_cohort": (
        scan_cohort,
        "select o_orderkey, cast(o_orderdate as date) as ordered, o_orderstatus from orders",
    ),
    "ingest_dates": (
        ingest_dates,
        with_views("select PATIENT_ID, INDEX_DATE, END_DATE, condition_a, condition_b from v_cohort"),
    ),
    "strip_codelist_suffix": (
        strip_codelist_suffix,
        with_views(
            'select PATIENT_ID, condition_a as "BD_MEDI:alpha", condition_b as BD_beta, '
            'INDEX_DATE as "BD_MEDI:entry", END_DATE from v_cohort'
        ),
    ),
    "discover_conditions": (
        discover_conditions,
        with_views(
            "select 'BD_MEDI:alpha' as \"Condition\", count(condition_a) as persons from v_cohort union all "
            "select 'BD_beta', count(condition_b) from v_cohort union all "
            "select 'BD_MEDI:entry', count(INDEX_DATE) from v_cohort"
        ),
    ),
    "empty_to_null": (
        empty_to_null,
        with_views("select PATIENT_ID, nullif(SEX, '') as SEX, pat_catg_b, INDEX_DATE from blanks", blanks=BLANKS),
    ),
    "sentinels_to_null": (
        sentinels_to_null,
        with_views(
            "select PATIENT_ID, case when SEX not in ('MISSING', '', 'null', 'none') then SEX end as SEX, "
            "case when pat_catg_b not in ('MISSING', '', 'null', 'none') then pat_catg_b end as pat_catg_b, "
            "INDEX_DATE from blanks",
            blanks=BLANKS,
        ),
    ),
    "dates_to_text": (
        dates_to_text,
        with_views(
            "select PATIENT_ID, SEX, pat_catg_b, strftime(INDEX_DATE, '%Y-%m-%d') as INDEX_DATE from blanks",
            blanks=BLANKS,
        ),
    ),
    "merge_condition_dates": (
        merge_condition_dates,
        with_views("select *, least(either, END_DATE) as first from merged", merged=MERGED),
    ),
    "merge_drop_sources": (
        merge_drop_sources,
        with_views("select PATIENT_ID, least(either, END_DATE) as first from merged", merged=MERGED),
    ),
    "combine_levels": (
        combine_levels,
        with_views(
            "select PATIENT_ID, case when pat_catg_a in ('HOUSEHOLD', 'FURNITURE') then 'HOME' else pat_catg_a end "
            "as pat_catg_a, case when pat_catg_b in ('AFRICA', 'ASIA', 'EUROPE', 'AMERICA') then 'ALL' "
            "else pat_catg_b end as pat_catg_b from v_cohort"
        ),
    ),
    "practice_map": (
        practice_map,
        "select 'p' || cast(s_nationkey as varchar) as id_a, 'p' || cast(max(s_suppkey) as varchar) as id_b "
        "from supplier group by s_nationkey",
    ),
    "ref_population": (
        ref_population,
        with_views(
            "select band || ', ' || substr(Sex, 1, 1) as std_group, cast(sum(Count) as bigint) as weight from banded "
            "where band is not null group by 1",
            banded="select Sex, Count, case "
            + " ".join(
                f"when Age >= {low} and Age < {high} then '{label}'"
                for low, high, label in zip(AGE_BINS[:-1], AGE_BINS[1:], AGE_LABELS, strict=True)
            )
            + " end as band from v_refpop",
        ),
    ),
    "union_diagonal": (union_diagonal, with_views(BOTH, a=SOURCE_A, b=SOURCE_B)),
    "link_practices": (
        link_practices,
        with_views(
            f"select * from ({BOTH.replace('from a', 'from kept')})",
            a=SOURCE_A,
            b=SOURCE_B,
            kept="select * from a where PRACTICE_ID is not null and PRACTICE_ID not in "
            "(select id_a from v_practice_map where id_a in (select PRACTICE_ID from a where PRACTICE_ID is not null) "
            "and id_b in (select PRACTICE_ID from b))",
        ),
    ),
    "link_stats": (
        link_stats,
        with_views(
            "select (select count(distinct PRACTICE_ID) from a where PRACTICE_ID in (select id_a from v_practice_map)) "
            'as "n_pracMap_inA", '
            "(select count(distinct PRACTICE_ID) from b where PRACTICE_ID in (select id_b from v_practice_map)) "
            'as "n_pracMap_inB", '
            'count(*) filter (in_a and in_b) as "n_inA_inB", count(*) filter (in_a and not in_b) as "n_inA_notB", '
            'count(*) filter (not in_a and in_b) as "n_notA_inB", '
            'count(*) filter (not in_a and not in_b) as "n_notA_notB" from checks',
            a=SOURCE_A,
            b=SOURCE_B,
            checks=CHECKS,
        ),
    ),
    "link_one_to_one": (
        link_one_to_one,
        with_views(
            "select PATIENT_ID, strftime(INDEX_DATE, '%Y-%m-%d') as INDEX_DATE, balance as n_items, "
            "h.n_items as n_items_right, strftime(first_item, '%Y-%m-%d') as first_item "
            "from v_cohort left join v_hospital h on patid = PATIENT_ID"
        ),
    ),
    "link_deprivation": (
        link_deprivation,
        with_views(
            "select PATIENT_ID, PRACTICE_ID, PRACTICE_PATIENT_ID, replace(imd, '*', '') as \"IMD_pracid\" "
            "from v_cohort left join v_deprivation on pracid = PRACTICE_ID"
        ),
    ),
}
