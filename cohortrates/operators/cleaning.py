"""Cleaning and recoding of extracts. Every step is a projection: no shuffle, no Python rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    MISSING_WORDS,
    clean_condition,
    date_pattern,
    named,
    null_if_in,
    over,
    text_columns,
)

CODELIST_PREFIX = "BD_MEDI:"


def empty_to_null(df: DataFrame) -> DataFrame:
    """Empty strings as null in every text column."""
    return over(df, text_columns(df), lambda c: F.nullif(c, F.lit("")))


def sentinels_to_null(df: DataFrame, columns: Sequence[str] | None = None, words: Sequence[str] = MISSING_WORDS) -> DataFrame:
    """Words that mean missing as null, in the text columns among ``columns``."""
    chosen = [c for c in text_columns(df) if columns is None or c in columns]
    return over(df, chosen, lambda c: null_if_in(c, words))


def strip_codelist_suffix(df: DataFrame) -> DataFrame:
    """Drop the number that ends the name of a code-list column."""
    renames = {c: re.sub(r":\d+$", "", c) for c in df.columns if c.startswith(CODELIST_PREFIX)}
    result = [renames.get(c, c) for c in df.columns]
    clashes = sorted({c for c in result if result.count(c) > 1})
    if clashes:
        raise ValueError(f"code-list columns share a name without their number: {clashes}")
    return df.withColumnsRenamed(renames)


def dates_to_text(df: DataFrame) -> DataFrame:
    """Date columns as ISO text, for linking with extracts that hold text."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return over(df, dates, lambda c: c.cast("string"))


def all_to_text(df: DataFrame) -> DataFrame:
    return over(df, df.columns, lambda c: c.cast("string"))


def merge_condition_dates(
    df: DataFrame,
    merges: Mapping[str, Sequence[str]],
    fmt: str = "%Y-%m-%d",
    drop_sources: bool = True,
) -> DataFrame:
    """New condition dates, each the earliest of several; nulls count as never.

    Entries with one source are ignored. A later entry may use a date an earlier one made. Sources
    are dropped at the end, so several entries may share one.
    """
    used: list[str] = []
    for target, sources in merges.items():
        if len(sources) < 2:
            continue
        types = {f.name: f.dataType for f in df.schema.fields}
        parsed = [
            F.to_date(named(c), date_pattern(fmt)) if isinstance(types[c], T.StringType) else named(c)
            for c in sources
        ]
        changes = dict(zip(sources, parsed, strict=True))
        df = df.withColumns({**changes, target: F.least(*parsed)})
        used.extend(sources)
    return df.drop(*dict.fromkeys(used)) if drop_sources else df


def combine_levels(df: DataFrame, merges: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Recode listed levels to a new label, label by label; a later one may pick up an earlier one."""
    changes = {}
    for name, labels in merges.items():
        value = named(name).cast("string")
        for label, levels in labels.items():
            value = F.when(value.isin(*levels), label).otherwise(value)
        changes[name] = value
    return df.withColumns(changes) if changes else df


def clean_condition_names(results: DataFrame, column: str = "Condition") -> DataFrame:
    return results.withColumn(column, clean_condition(named(column)))
