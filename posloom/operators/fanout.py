"""Would the join to the master multiply rows? Asked without doing the join.

Only keys listed more than once in the master can do so, and they are few, so
each flag is one pruned pass over the feed's key (and amount).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posloom.operators.lookup import small_side


def repeated_keys(master: DataFrame, key: str) -> DataFrame:
    """Keys of more than one master row, with the number of rows."""
    return (
        master.groupBy(F.col(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_copies"))
        .filter(F.col("_copies") > 1)
    )


def _same_key(feed: DataFrame, feed_key: str, repeats: DataFrame, null_safe: bool):
    return (
        feed[feed_key].eqNullSafe(repeats["_key"])
        if null_safe
        else feed[feed_key] == repeats["_key"]
    )


def rows_multiply(
    feed: DataFrame,
    master: DataFrame,
    feed_key: str,
    master_key: str,
    null_safe: bool = True,
    master_bytes: int | None = None,
) -> DataFrame:
    """One row: does the left join have more rows than the feed?"""
    repeats = repeated_keys(master, master_key)
    same = _same_key(feed, feed_key, repeats, null_safe)
    hit = feed.select(feed_key).join(small_side(repeats, master_bytes), same, "left_semi")
    return hit.agg((F.count(F.lit(1)) > 0).alias("fan_out"))


def amount_changes(
    feed: DataFrame,
    master: DataFrame,
    feed_key: str,
    master_key: str,
    amount: str = "POSAmount",
    null_safe: bool = True,
    master_bytes: int | None = None,
) -> DataFrame:
    """One row: is the amount total of the left join another than the feed's?

    The difference is the sum of ``amount * (copies - 1)`` in exact decimals;
    unknown amounts add nothing.
    """
    repeats = repeated_keys(master, master_key)
    same = _same_key(feed, feed_key, repeats, null_safe)
    extra = feed.select(feed_key, amount).join(small_side(repeats, master_bytes), same, "inner")
    per_copies = extra.groupBy("_copies").agg(F.sum(amount).alias("_amount"))
    difference = F.sum(F.col("_amount").cast("decimal(28,4)") * (F.col("_copies") - 1).cast("decimal(9,0)"))
    return per_copies.agg((F.coalesce(difference, F.lit(0)) != 0).alias("fan_out"))
