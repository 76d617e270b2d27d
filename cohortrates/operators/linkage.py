"""Linking extracts: two practice systems, hospital records, deprivation.

Adaptive execution broadcasts lookup tables by their size, or joins them by shuffle and splits hot
practices. Nothing is read before the query runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import named, quoted
from ..sources.keyed import KeyedTable
from ..sources.maps import DEPRIVATION_KEYS
from .cleaning import dates_to_text

PRACTICE = "PRACTICE_ID"


def union_diagonal(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows and all columns of both; shared columns of different types become text."""
    mine, theirs = dict(first.dtypes), dict(second.dtypes)
    clash = [c for c in mine if c in theirs and mine[c] != theirs[c]]
    as_text = {c: named(c).cast("string") for c in clash}
    if as_text:
        first, second = first.withColumns(as_text), second.withColumns(as_text)
    return first.unionByName(second, allowMissingColumns=True)


def _known(practices: DataFrame, source: DataFrame, column: str, flag: str) -> DataFrame:
    """Ids of ``practices[column]`` that occur in ``source``, once each.

    The source is joined against the mapped ids before it is reduced, so what is shuffled is no
    larger than the map.
    """
    ids = practices.select(F.col(column).alias(PRACTICE)).distinct()
    found = source.select(PRACTICE).join(ids, PRACTICE, "left_semi").distinct()
    return found.select(F.col(PRACTICE).alias(column), F.lit(True).alias(flag))


def match_practices(practices: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Each mapped practice with whether it occurs in source A and in source B.

    The one pass over both sources; write it where both functions below need it.
    """
    return (
        practices.join(_known(practices, a, "id_a", "in_a"), "id_a", "left")
        .join(_known(practices, b, "id_b", "in_b"), "id_b", "left")
        .select(
            "id_a",
            "id_b",
            F.coalesce("in_a", F.lit(False)).alias("in_a"),
            F.coalesce("in_b", F.lit(False)).alias("in_b"),
        )
    )


def link_stats(matched: DataFrame) -> DataFrame:
    """One row: how many matched practices occur in A, in B, in both or in neither."""

    def where(in_a: bool, in_b: bool):
        return F.count_if((F.col("in_a") == in_a) & (F.col("in_b") == in_b))

    return matched.agg(
        F.countDistinct(F.when(F.col("in_a"), F.col("id_a"))).alias("n_pracMap_inA"),
        F.countDistinct(F.when(F.col("in_b"), F.col("id_b"))).alias("n_pracMap_inB"),
        where(True, True).alias("n_inA_inB"),
        where(True, False).alias("n_inA_notB"),
        where(False, True).alias("n_notA_inB"),
        where(False, False).alias("n_notA_notB"),
    )


def link_practices(matched: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """B, and A without the practices that moved to B; rows of A without a practice are dropped."""
    moved = matched.where("in_a AND in_b").select(F.col("id_a").alias(PRACTICE))
    kept = a.where(F.col(PRACTICE).isNotNull()).join(moved, PRACTICE, "left_anti")
    return union_diagonal(b, kept.select(*[named(c) for c in a.columns]))


LINK_KEY, LINK_COUNT = "link key", "link count"


def _once(df: DataFrame, what: str) -> DataFrame:
    """``df``, or an error when the query runs if a key was counted more than once."""
    message = f"concat('{what}: key ', string({quoted(LINK_KEY)}), ' occurs ', string({quoted(LINK_COUNT)}), ' times')"
    check = f"CASE WHEN {quoted(LINK_COUNT)} = 1 THEN true ELSE boolean(raise_error({message})) END"
    return df.where(F.expr(check)).drop(LINK_COUNT)


def link_one_to_one(
    cohort: DataFrame, records: DataFrame, cohort_key: str, record_key: str, dates_as_text: bool = False
) -> DataFrame:
    """Cohort rows with the columns of their one record; clashing names end in ``_right``.

    Both keys must be unique, which is checked in passing: each side is dealt out by its key once, for
    the check and the join alike. Cohort rows without a key cannot match, so they bypass the join
    instead of meeting in one partition of it.
    """
    if dates_as_text:
        cohort, records = dates_to_text(cohort), dates_to_text(records)
    joined_type = _common_type(cohort.schema[cohort_key].dataType, records.schema[record_key].dataType)
    keyed = cohort.withColumn(LINK_KEY, named(cohort_key).cast(joined_type)).where(named(LINK_KEY).isNotNull())
    found = records.withColumn(LINK_KEY, named(record_key).cast(joined_type)).where(named(LINK_KEY).isNotNull())
    matched, added = _linked(keyed, found, cohort.columns, [c for c in records.columns if c != record_key])
    return matched.unionByName(_unlinked(cohort, cohort_key, added))


def link_kept(cohort: KeyedTable, records: KeyedTable) -> KeyedTable:
    """``link_one_to_one`` of two tables kept by their keys: neither side is dealt out again.

    The result is dealt by the cohort's key as the cohort is, for further links in the same query.
    """
    kinds = [t.keyed.schema[t.key].dataType for t in (cohort, records)]
    if kinds[0] != kinds[1] or cohort.buckets != records.buckets:
        raise ValueError(f"keys of types {kinds} in {cohort.buckets} and {records.buckets} buckets cannot be linked as they are kept")
    keyed, found = (t.keyed.withColumn(LINK_KEY, named(t.key)) for t in (cohort, records))
    matched, added = _linked(keyed, found, cohort.keyed.columns, [c for c in records.keyed.columns if c != records.key])
    return KeyedTable(cohort.key, cohort.buckets, matched, _unlinked(cohort.keyless, cohort.key, added))


def _linked(keyed: DataFrame, found: DataFrame, own: Sequence[str], others: Sequence[str]) -> tuple[DataFrame, dict[str, T.DataType]]:
    """Rows of ``keyed`` with the other columns of their one row of ``found`` by LINK_KEY, and the types of these."""
    target = {c: f"{c}_right" if c in own else c for c in others}
    right = _once(
        found.groupBy(named(LINK_KEY)).agg(
            F.any_value(F.struct(F.lit(1), *[named(c) for c in others])).alias("record"), F.count(F.lit(1)).alias(LINK_COUNT)
        ),
        "records",
    ).select(named(LINK_KEY).alias("record key"), *[F.col("record").getField(c).alias(target[c]) for c in others])
    left = _once(keyed.withColumn(LINK_COUNT, F.count(F.lit(1)).over(Window.partitionBy(named(LINK_KEY)))), "cohort")
    matched = left.join(right, named(LINK_KEY) == named("record key"), "left").drop(LINK_KEY, "record key")
    return matched, {target[c]: found.schema[c].dataType for c in others}


def _unlinked(cohort: DataFrame, key: str, columns: dict[str, T.DataType]) -> DataFrame:
    """Rows without a key, which no join needs to see, with null for what it would add."""
    return cohort.where(named(key).isNull()).select("*", *[F.lit(None).cast(t).alias(c) for c, t in columns.items()])


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    return a if a == b else T.StringType()


def link_deprivation(cohort: DataFrame, lookup: DataFrame) -> DataFrame:
    """Deprivation by practice or by person; the lookup's first column names its key, which must be unique."""
    key, value = lookup.columns
    if key not in DEPRIVATION_KEYS:
        raise ValueError(f"deprivation key must be one of {sorted(DEPRIVATION_KEYS)}, not {key}")
    column = DEPRIVATION_KEYS[key]
    name = f"IMD_{key}"
    counted = lookup.groupBy(F.col(key).cast("string").alias(LINK_KEY)).agg(F.any_value(value).alias(name), F.count(F.lit(1)).alias(LINK_COUNT))
    values = _once(counted.where(named(LINK_KEY).isNotNull()), "deprivation")
    keyed = cohort.where(named(column).isNotNull())
    linked = keyed.join(values, named(column).cast("string") == named(LINK_KEY), "left").drop(LINK_KEY)
    return linked.unionByName(_unlinked(cohort, column, {name: lookup.schema[value].dataType}))
