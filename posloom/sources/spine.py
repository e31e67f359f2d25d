"""Every day between the first and the last date of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_spine(df: DataFrame, column: str, name: str = "day") -> DataFrame:
    bounds = df.agg(
        F.min(F.col(column).cast("date")).alias("first"), F.max(F.col(column).cast("date")).alias("last")
    )
    days = F.sequence("first", "last", F.make_dt_interval(F.lit(1)))
    return bounds.select(F.explode(days).alias(name))


def with_random_value(df: DataFrame, seed: int, key: str, name: str = "value") -> DataFrame:
    """A standard normal draw per row, fixed by the seed and the row's ``key``.

    Two uniform numbers from hashes of the key make one normal number
    (Box-Muller), so no partitioning and no repeated task changes a draw.
    """
    def uniform(step: int):
        digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit(step), F.col(key).cast("string")).cast("binary")), 1, 13)
        return (F.conv(digits, 16, 10).cast("double") + 0.5) / 2.0**52

    return df.withColumn(name, F.sqrt(-2 * F.log(uniform(1))) * F.cos(2 * F.pi() * uniform(2)))
