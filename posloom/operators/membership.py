"""Item master against the warehouse's item list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posloom.functions.conditions import zero_one


def _known(warehouse: DataFrame, warehouse_key: str) -> DataFrame:
    return warehouse.select(F.col(warehouse_key).alias("_known")).filter(
        F.col("_known").isNotNull()
    ).distinct()


def invalid_items(
    master: DataFrame, warehouse: DataFrame, key: str = "item_number", warehouse_key: str = "ItemNumber"
) -> DataFrame:
    """Master rows whose item number the warehouse does not list."""
    items = master.filter(F.col(key).isNotNull())
    known = _known(warehouse, warehouse_key)
    return items.join(known, items[key] == known["_known"], "left_anti")


def valid_items(
    master: DataFrame, warehouse: DataFrame, key: str = "item_number", warehouse_key: str = "ItemNumber"
) -> DataFrame:
    known = _known(warehouse, warehouse_key)
    return master.join(known, master[key] == known["_known"], "left_semi")


def flag_items(
    master: DataFrame, warehouse: DataFrame, key: str = "item_number", warehouse_key: str = "ItemNumber"
) -> DataFrame:
    """Master rows with ``invalid`` 1 (not listed) or 0; blank numbers drop out."""
    items = master.filter(F.col(key).isNotNull())
    known = _known(warehouse, warehouse_key)
    joined = items.join(known, items[key] == known["_known"], "left")
    return joined.withColumn("invalid", zero_one(F.col("_known").isNull())).drop("_known")


def not_yet_run(accounts: DataFrame, done: DataFrame, account: str, done_account: str) -> DataFrame:
    """Accounts missing from the consolidated table, compared in lower case."""
    seen = done.select(F.lower(done_account).alias("_done")).filter(
        F.col("_done").isNotNull()
    ).distinct()
    wanted = accounts.select(F.lower(account).alias(account)).distinct()
    return wanted.join(seen, wanted[account] == seen["_done"], "left_anti")
