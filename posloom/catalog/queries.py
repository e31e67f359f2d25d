"""All registered queries by name, each over whole tables.

``QUERIES`` and ``TWIN_SQL`` are filled by the modules imported here and by the
account runs below.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from posloom.catalog import account_sql, views
from posloom.catalog import file_queries, operator_queries, table_queries  # noqa: F401  (they register)
from posloom.catalog.registry import QUERIES, TWIN_SQL, Query, register
from posloom.plans.accounts import ACCOUNTS, LEGACY_ACCOUNTS
from posloom.plans.engine import run_account
from posloom.plans.master import measured
from posloom.plans.spec import REFERENCE, STRICT

RUN_DATE = dt.date(2020, 3, 1)


def _account(name: str, mode: str) -> Query:
    spec = {**ACCOUNTS, **LEGACY_ACCOUNTS}[name]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        master = measured(views.master_rows(spark, sf_dir, name))
        feed = views.raw_feed(spark, sf_dir, name)
        return run_account(spec, feed, master, RUN_DATE, mode).rows.drop("counted")

    return query


for _name in {**ACCOUNTS, **LEGACY_ACCOUNTS}:
    _label = _name if _name in LEGACY_ACCOUNTS else f"acct_{_name}"
    register(_label, account_sql.strict_sql(_name))(_account(_name, STRICT))
    register(f"{_label}_reference", account_sql.reference_sql(_name))(_account(_name, REFERENCE))
