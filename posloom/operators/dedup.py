"""Keep-first without file order: the order is a column, the plan a window.

Every function filters ``row_number() = 1``, which Spark turns into a group
limit on both sides of the shuffle. A key that holds a third of all rows thus
ships one row per map task, not the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """First row per key by ``order``; NULL keys are one group."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")
    )


def first_per_key_if(
    df: DataFrame, flag: DataFrame, keys: list[str | Column], order: list[str | Column]
) -> DataFrame:
    """``first_per_key`` if the one-row, one-column ``flag`` is true, else ``df``.

    One plan: the flag is a scalar subquery, so nothing runs while the plan is
    built and ``df`` is read once beside the flag. Where the flag is false every
    row gets a key of its own; the rows then spread evenly and all are first.
    """
    alone = F.when(F.coalesce(flag.scalar(), F.lit(False)), F.lit(None)).otherwise(F.monotonically_increasing_id())
    steered = df.withColumn("_alone", alone)
    return first_per_key(steered, [*keys, "_alone"], order).drop("_alone")
