"""Control totals, reconciliation and run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def control_totals(
    final: DataFrame, by: tuple[str, ...] = ("AccountMajor",), counted: str = "counted"
) -> DataFrame:
    """Amount, units and number of filled ``counted`` cells per account.

    Outcome rows bring a ``counted`` column that is filled where the account
    wants the row counted.
    """
    return final.groupBy(*by).agg(
        F.sum("POSAmount").alias("POSAmount"),
        F.sum("POSQuantity").alias("POSQuantity"),
        F.count(counted).alias("row_count"),
    )


def total(df: DataFrame, column: str) -> DataFrame:
    """One row: the sum, 0 when nothing is known."""
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).alias(column))


def reconcile(
    feed: DataFrame, outcomes: DataFrame, by: str, amount: str = "POSAmount"
) -> DataFrame:
    """Feed against final plus exceptions, per account: rows and amounts.

    Both sides are aggregated before they meet, so only totals are joined.
    """
    fed = feed.groupBy(by).agg(
        F.count(F.lit(1)).alias("feed_rows"),
        F.coalesce(F.sum(amount), F.lit(0)).alias("feed_amount"),
    )
    out = outcomes.groupBy(by).agg(
        F.count_if(F.col("outcome") == "final").alias("final_rows"),
        F.count_if(F.col("outcome") == "exception").alias("exception_rows"),
        F.coalesce(F.sum(amount), F.lit(0)).alias("outcome_amount"),
    )
    joined = fed.join(out, by, "left").na.fill(0, ["final_rows", "exception_rows"])
    balanced = (F.col("feed_rows") == F.col("final_rows") + F.col("exception_rows")) & (
        F.col("feed_amount") == F.coalesce(F.col("outcome_amount"), F.lit(0))
    )
    return joined.withColumn("balanced", balanced)


def pre_aggregate(
    df: DataFrame, keys: list[str], sums: list[str], keep_null_keys: bool = True, **extra
) -> DataFrame:
    """Sums per key; without ``keep_null_keys`` rows with a NULL key drop out."""
    if not keep_null_keys:
        df = df.na.drop("any", subset=keys)
    return df.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums], *[e.alias(name) for name, e in extra.items()]
    )


def observed(df: DataFrame, name: str, amount: str = "POSAmount") -> tuple[DataFrame, Observation]:
    """Row count and amount noted while the rows pass by, at no extra job."""
    observation = Observation(name)
    return (
        df.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(amount), F.lit(0)).alias("amount"),
        ),
        observation,
    )
