"""A measures-by-period sheet (one row per item and measure, one column per
period) as one row per item and period with the measures side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posloom.functions.conditions import not_sentinel
from posloom.operators.reshape import pivot_sum, to_long

# The measures such a sheet lists.
MEASURES = ("Total Units Sold", "Total Sell Dollars", "Avg On-Hand Qty", "Avg On-Order Qty")
ITEM_COLUMNS = ("Item Nbr", "Item Desc 1", "Vendor Stock Nbr")


def period_rows(
    sheet: DataFrame, periods: list[str], measure: str = "Data Type", ids: tuple[str, ...] = ITEM_COLUMNS
) -> DataFrame:
    """Item, measure, period, value; without blank and total rows. A row becomes as
    many as there are periods: to be summed, sum first (``summed_rows``)."""
    return to_long(item_rows(sheet), [*ids, measure], periods, "period", "value")


def summed_rows(sheet: DataFrame, periods: list[str], by: tuple[str, ...], count: str = "n") -> DataFrame:
    """The sheet with one row per key, still a column per period, and its number of rows."""
    sums = [F.sum(f"`{p}`").alias(p) for p in periods]
    return item_rows(sheet).groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.count(F.lit(1)).alias(count), *sums)


def item_rows(sheet: DataFrame) -> DataFrame:
    return sheet.filter(F.col("Item Nbr").isNotNull()).filter(not_sentinel(F.col("Item Nbr"), "Inventory"))


def period_report(
    sheet: DataFrame,
    periods: list[str],
    measure: str = "Data Type",
    measures: tuple[str, ...] = MEASURES,
) -> DataFrame:
    """Sums by item and period. The sheet is summed before its periods become rows."""
    sums = [F.sum(f"`{p}`").alias(p) for p in periods]
    summed = item_rows(sheet).groupBy(*[F.col(f"`{c}`") for c in (*ITEM_COLUMNS, measure)]).agg(*sums)
    long = to_long(summed, [*ITEM_COLUMNS, measure], periods, "period", "value")
    return pivot_sum(long, [*ITEM_COLUMNS, "period"], measure, "value", list(measures))
