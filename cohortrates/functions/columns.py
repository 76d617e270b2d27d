"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Strings a report counts as missing.
MISSING_WORDS = ("MISSING", "", "null", "none")

#: Label of an absent stratum.
NO_STRATUM = "null"

SPARK_DATE_PARTS = {"%d": "d", "%m": "M", "%Y": "yyyy", "%y": "yy", "%b": "MMM", "%B": "MMMM"}


def quoted(name: str) -> str:
    """A column name for use in SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(name: str) -> Column:
    return F.col(quoted(name))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def date_pattern(fmt: str) -> str:
    """A Spark date pattern for a ``strftime`` one; days and months may come without padding."""
    for part, pattern in SPARK_DATE_PARTS.items():
        fmt = fmt.replace(part, pattern)
    if "%" in fmt:
        raise ValueError(f"date format part not supported: {fmt}")
    return fmt


def over(columns: DataFrame, names: Iterable[str], change) -> DataFrame:
    """``columns`` with ``change`` applied to each of ``names``, in one projection."""
    names = list(names)
    return columns.withColumns({n: change(named(n)) for n in names}) if names else columns


def null_if_in(col: Column, words: Sequence[str]) -> Column:
    return F.when(col.isin(*words), None).otherwise(col)


def strata_label(names: Sequence[str]) -> Column:
    """Values of several strata joined to one label; absent ones read ``null``."""
    return F.concat_ws(", ", *[F.coalesce(named(n).cast("string"), F.lit(NO_STRATUM)) for n in names])


def clean_condition(col: Column) -> Column:
    return F.regexp_replace(col, "_|:|BD_MEDI", "")


def rounded_text(col: Column, digits: int) -> Column:
    """A number rounded for print: at least one decimal, no further trailing zeros."""
    fixed = F.round(col, digits).cast(T.DecimalType(38, max(digits, 1))).cast("string")
    return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")
