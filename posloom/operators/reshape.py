"""Wide to long and back. Column values are named by the caller, so a plan
never has to look at the data first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_long(
    df: DataFrame, ids: list[str], values: list[str], name: str, value: str
) -> DataFrame:
    return df.unpivot(
        [F.col(f"`{i}`") for i in ids], [F.col(f"`{v}`") for v in values], name, value
    )


def pivot_first(
    df: DataFrame, index: list[str], key: str, value: str, order: Column, keys: list
) -> DataFrame:
    """One column per key value, holding the first known value by ``order``.

    A key value that ``keys`` does not list fails the job by name.
    """
    known = df.withColumn(key, listed(key, keys))
    return known.groupBy(*index).pivot(key, keys).agg(first_known(value, order))


def pivot_sum(df: DataFrame, index: list[str], key: str, value: str, keys: list) -> DataFrame:
    known = df.withColumn(key, listed(key, keys))
    return known.groupBy(*index).pivot(key, keys).agg(F.sum(value))


def first_known(value: str, order: Column) -> Column:
    """The value that is not NULL and comes first by ``order``."""
    return F.min_by(value, F.when(F.col(f"`{value}`").isNotNull(), order))


def listed(column: str, values: list) -> Column:
    """The column, checked: a value not listed is an error, NULL is no value."""
    value = F.col(f"`{column}`")
    unknown = F.raise_error(F.concat(F.lit(f"{column} is not listed: "), value.cast("string")))
    return F.when(value.isin(*values) | value.isNull(), value).otherwise(unknown.cast("string"))


def transposed(
    df: DataFrame, label: str, labels: list, columns: list[str], name: str = "key"
) -> DataFrame:
    """Rows named by ``label`` become columns, columns become rows.

    ``labels`` lists the row names. Done as unpivot and pivot, so the frame is
    never gathered on the driver.
    """
    long = to_long(df, [label], columns, name, "_value")
    return long.groupBy(name).pivot(label, labels).agg(F.first("_value", ignorenulls=True))


def master_long(master: DataFrame, account_keys: dict[str, str], keep: list[str]) -> DataFrame:
    """One row per account and listed key, so that all accounts join at once.

    ``account_keys`` maps an account name to the master column of its key.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(account).alias("account"), F.col(column).alias("account_key"))
            for account, column in account_keys.items()
        ]
    )
    return (
        master.select(*keep, F.inline(pairs))
        .filter(F.col("account_key").isNotNull())
    )


def key_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()
