"""Row filters over sets of columns, and positional rows of a sheet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_any_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=subset)


def drop_all_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop("all", subset=subset)


def in_list(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is listed; NULL is not."""
    return df.filter(F.col(column).isin(*values))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def drop_last_row(df: DataFrame, sheet_keys: list[str], row: str) -> DataFrame:
    """Without the last row of each sheet (its grand total).

    The last row number per sheet is a map-side combined maximum joined back,
    so that one huge sheet never has to sit in a single window partition.
    """
    last = df.groupBy(*sheet_keys).agg(F.max(row).alias("_last_row"))
    joined = df.join(last, sheet_keys)
    return joined.filter(F.col(row) < F.col("_last_row")).drop("_last_row")


def measure_lookup(df: DataFrame, keys: dict[str, object], value: str) -> DataFrame:
    """The cells of one measure addressed by fixed values of other columns."""
    where = all_of([F.col(name) == F.lit(wanted) for name, wanted in keys.items()])
    return df.filter(where).select(*keys, value)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all (a diagnostic; one pass).

    The schema depends on the data, so this is the one operator that must run
    an aggregate before it can say what it returns.
    """
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    row = counts.first()
    return df.select(*[f"`{c}`" for i, c in enumerate(df.columns) if row[i] > 0])


def first_columns(df: DataFrame, n: int) -> DataFrame:
    return df.select(*[f"`{c}`" for c in df.columns[:n]])
