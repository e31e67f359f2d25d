"""The duplicate rules of reference mode, as one plan each."""

from __future__ import annotations

import datetime as dt

import pytest

from posloom.catalog import views as v
from posloom.plans.accounts import ACCOUNTS
from posloom.plans.engine import run_account
from posloom.plans.master import measured
from posloom.plans.spec import REFERENCE

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["amazon", "bbb", "walmart", "meijer"])
def test_building_an_account_starts_no_job(spark, name):
    master = measured(v.master_rows(spark, DATA, name))  # once, before any account
    raw = v.raw_feed(spark, DATA, name)
    spark.sparkContext.setJobGroup(f"build-{name}", "")
    result = run_account(ACCOUNTS[name], raw, master, dt.date(2020, 3, 1), REFERENCE)
    result.rows._jdf.queryExecution().optimizedPlan()
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}") == []
    spark.sparkContext.setJobGroup("other", "")
    scans = result.rows._jdf.queryExecution().executedPlan().toString()
    assert scans.count("FileScan") >= 1
