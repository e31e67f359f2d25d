"""Appending, consolidating and combining value lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name, absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def seeded_values(seed: list[str], df: DataFrame, column: str) -> DataFrame:
    """A seed list and the values found in a column, each once."""
    found = df.select(F.col(column).alias(column)).filter(F.col(column).isNotNull())
    listed = df.sparkSession.createDataFrame([(s,) for s in seed], f"`{column}` string")
    return listed.unionByName(found).distinct()


def each_with_all(df: DataFrame, values: list[str], column: str) -> DataFrame:
    """Every row of ``df`` with every value of the caller's list (measure names).

    The list is a constant of the plan and is exploded in place: no join, no
    shuffle of ``df``, nothing gathered from data.
    """
    names = F.array(*[F.lit(value) for value in dict.fromkeys(values)])
    return df.select("*", F.explode(names).alias(column))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
