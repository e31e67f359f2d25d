"""All accounts in one job: one feed table, one join, one set of totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posloom.functions.conditions import brand_tier
from posloom.operators.dedup import first_per_key
from posloom.operators.lookup import lookup
from posloom.operators.reshape import master_long
from posloom.plans.master import Master
from posloom.schema import EXCEPTION, FINAL

KEPT = ["item_number", "short_brand", "master_row"]


def first_master_per_account(master: Master, account_keys: dict[str, str]) -> DataFrame:
    """First master row per account and customer item number."""
    long = master_long(master.rows, account_keys, KEPT)
    return first_per_key(long, ["account", "account_key"], ["master_row"]).select(
        F.col("account").alias("m_account"),
        F.col("account_key").alias("m_key"),
        F.col("item_number").alias("m_item_number"),
        F.col("short_brand").alias("m_short_brand"),
    )


def consolidated_outcomes(
    feed: DataFrame, master: Master, account_keys: dict[str, str], item: str = "cust_item"
) -> DataFrame:
    """Every feed row with its item, tier and outcome.

    The long master has at most one row per account and master row, which
    bounds its size by the measured one times the number of accounts.
    """
    dim = first_master_per_account(master, account_keys)
    joined = lookup(
        feed,
        dim,
        [("account", "m_account"), (item, "m_key")],
        dim_bytes=master.size * len(account_keys),
    )
    hit = F.col("m_item_number").isNotNull()
    return joined.withColumns(
        {
            "ItemNumber": F.col("m_item_number"),
            "MainlinePremium": F.when(hit, brand_tier(F.col("m_short_brand"))),
            "outcome": F.when(hit, FINAL).otherwise(EXCEPTION),
        }
    ).drop("m_account", "m_key", "m_item_number", "m_short_brand")
