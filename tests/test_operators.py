from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from posloom.catalog.queries import QUERIES
from posloom.operators import control, dedup, fanout, filters, lookup, membership, reshape, sets
from posloom.plans.accounts import ACCOUNTS
from posloom.plans.engine import run_account
from posloom.plans.master import Master, measured
from posloom.plans.periods import period_rows, summed_rows
from posloom.schema import MASTER_HEADERS
from posloom.session import BROADCAST_LIMIT_KEY


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


@pytest.fixture()
def skewed(spark):
    """A third of the rows share one key, a third have none."""
    return spark.range(6000).selectExpr(
        "id", "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE concat('k', id % 997) END AS key"
    )


@pytest.fixture()
def dim(spark):
    return spark.sql(
        "SELECT concat('k', id) AS d_key, id AS d_id FROM range(900) UNION ALL SELECT 'hot', -1 UNION ALL SELECT NULL, -2"
    )


@pytest.mark.parametrize("null_safe", [False, True])
def test_weighted_lookup_equals_the_plain_join(skewed, dim, null_safe):
    on = [("key", "d_key")]
    same = skewed["key"].eqNullSafe(dim["d_key"]) if null_safe else skewed["key"] == dim["d_key"]
    expected = rows(skewed.join(dim, same, "left"), "id", "d_id")
    assert rows(lookup.weighted_lookup(skewed, dim, on, null_safe), "id", "d_id") == expected
    assert rows(lookup.lookup(skewed, dim, on, null_safe), "id", "d_id") == expected


def test_sketch_misses_no_heavy_key_and_names_few_others(spark):
    """Two dozen keys over the limit among 200,000 light ones, in many tasks."""
    feed = spark.range(0, 400_000, 1, 13).selectExpr(
        "CASE WHEN id % 2 = 0 THEN concat('h', id % 48) WHEN id % 1001 = 1 THEN NULL ELSE concat('k', id) END AS key"
    )
    counts = feed.groupBy("key").count()
    total = feed.count()
    true = counts.filter(F.col("count") * lookup.HEAVY_SHARE > total).select(F.xxhash64("key").alias("_heavy"))
    found = {r[0] for r in lookup.heavy_keys(feed, ["key"]).collect()}
    assert {r[0] for r in true.collect()} <= found and len(found) <= 40
    plan = lookup.heavy_keys(feed, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan  # of sketches, not of keys


def test_weighted_lookup_reads_the_feed_twice(spark, tmp_path, skewed, dim):
    skewed.write.parquet(str(tmp_path / "feed"))
    dim.write.parquet(str(tmp_path / "dim"))
    feed, items = spark.read.parquet(str(tmp_path / "feed")), spark.read.parquet(str(tmp_path / "dim"))
    joined = lookup.weighted_lookup(feed, items, [("key", "d_key")])
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    reads = [line for line in final.splitlines() if "FileScan" in line and "/feed" in line]
    assert len(reads) <= 2, plan


def test_rows_that_are_done_spread_over_the_shuffle(skewed, dim):
    plan = lookup.weighted_lookup(skewed, dim, [("key", "d_key")])._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line and "_salt" in line]
    assert len(joins) == 1 and re.search(r"_salt#\d+L = _zero#\d+L", joins[0])


def test_broadcast_only_within_the_measured_limit(spark, skewed, dim):
    size = lookup.measured_bytes(dim)
    assert 902 * 16 < size < 902 * 100

    def hints():
        joined = lookup.lookup(skewed, dim, [("key", "d_key")])
        return joined._jdf.queryExecution().analyzed().toString()

    spark.conf.set(BROADCAST_LIMIT_KEY, str(size))
    try:
        assert hints().count("_heavy") == 0
        spark.conf.set(BROADCAST_LIMIT_KEY, str(size - 1))
        assert hints().count("_heavy") > 0
    finally:
        spark.conf.unset(BROADCAST_LIMIT_KEY)


def test_shuffled_lookup_sorts_no_feed(skewed, dim):
    text = lookup.weighted_lookup(skewed, dim, [("key", "d_key")])._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text


def test_only_the_columns_sent_count_for_the_broadcast(spark):
    """A master over the limit whose key and item are within it."""
    master = measured(spark.range(500).selectExpr("concat('k', id) AS key", "id AS master_row", "repeat('x', 1000) AS title"))
    assert master.size == lookup.measured_bytes(master.rows)
    assert master.bytes_of("key", "master_row") == lookup.measured_bytes(master.rows.select("key", "master_row")) < master.size / 10
    assert Master(master.rows, 7).bytes_of("key") == 7 and master.bytes_of("key", "none") == master.size


def test_strict_match_broadcasts_by_what_it_sends(spark):
    raw = spark.sql("SELECT 'i1' AS ASIN, 't' AS `Product Title`, CAST(1 AS DECIMAL(18,2)) AS `Ordered Revenue`, 1 AS `Ordered Units`")
    other = [c for c in MASTER_HEADERS if c not in ("item_number", "amazon_id")]
    items = spark.range(300).selectExpr("concat('i', id) AS amazon_id", "concat('n', id) AS item_number", "id AS master_row",
                                        *[f"repeat('x', 500) AS {c}" for c in other])
    spark.conf.set(BROADCAST_LIMIT_KEY, str(300 * 200))
    try:
        rows = run_account(ACCOUNTS["amazon"], raw, measured(items), dt.date(2020, 3, 1)).rows
        assert "approx_top_k" not in rows._jdf.queryExecution().analyzed().toString()
        assert [r["ItemNumber"] for r in rows.collect()] == ["n1"]
    finally:
        spark.conf.unset(BROADCAST_LIMIT_KEY)


def test_first_per_key_treats_null_as_a_key(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3), ("a", 4)], "k string, o int")
    assert rows(dedup.first_per_key(df, ["k"], ["o"])) == [("a", 3), (None, 1)]


def test_first_per_key_reduces_a_hot_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id < 400 THEN 'hot' ELSE concat('k', id) END AS k", "id")
    plan = dedup.first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert len(limits) == 2 and "Partial" in limits[1]
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_conditional_dedup_is_one_plan(spark, tmp_path):
    spark.range(500).selectExpr("id % 7 AS k", "id AS o").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    flag = df.agg((F.max("o") > 3).alias("f"))
    spark.sparkContext.setJobGroup("planning", "")
    kept = dedup.first_per_key_if(df, flag, ["k"], ["o"])
    kept._jdf.queryExecution().executedPlan()
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("planning") == []
    spark.sparkContext.setJobGroup("other", "")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("WindowGroupLimit") == 2
    assert sorted(r.o for r in kept.collect()) == list(range(7))


@pytest.mark.parametrize("fired", [True, False, None])
def test_conditional_dedup(spark, fired):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, o int")
    flag = spark.createDataFrame([(fired,)], "f boolean")
    expected = [("a", 1)] if fired else [("a", 1), ("a", 2)]
    assert rows(dedup.first_per_key_if(df, flag, ["k"], ["o"])) == expected


@pytest.mark.parametrize(
    "amounts, copies, by_rows, by_amount",
    [
        ([1, 2], 1, False, False),
        ([1, 2], 2, True, True),
        ([10, -10], 2, True, False),
        ([None, None], 2, True, False),
        ([0, 5], 3, True, True),
    ],
)
def test_fan_out_flags(spark, amounts, copies, by_rows, by_amount):
    feed = spark.createDataFrame(
        [("a", None if a is None else Decimal(a)) for a in amounts], "k string, POSAmount decimal(18,4)"
    )
    master = spark.createDataFrame([("a",)] * copies + [("b",)], "m string")
    assert fanout.rows_multiply(feed, master, "k", "m").first()[0] is by_rows
    assert fanout.amount_changes(feed, master, "k", "m").first()[0] is by_amount
    joined = feed.join(master, feed.k == master.m, "left")
    assert (joined.count() != len(amounts)) is by_rows


def test_fan_out_of_null_keys(spark):
    feed = spark.createDataFrame([(None, Decimal(3))], "k string, POSAmount decimal(18,4)")
    master = spark.createDataFrame([(None,), (None,)], "m string")
    assert fanout.rows_multiply(feed, master, "k", "m").first()[0] is True
    assert fanout.rows_multiply(feed, master, "k", "m", null_safe=False).first()[0] is False


def test_control_total_and_empty_sum(spark):
    df = spark.createDataFrame(
        [("A", Decimal("1.50"), 2, 1), ("A", Decimal("-0.25"), 1, None), ("B", None, None, 1)],
        "AccountMajor string, POSAmount decimal(18,4), POSQuantity int, counted int",
    )
    assert rows(control.control_totals(df)) == [("A", Decimal("1.2500"), 3, 1), ("B", None, None, 1)]
    assert control.total(df.filter("AccountMajor = 'B'"), "POSAmount").first()[0] == 0


def test_reconcile_finds_a_lost_row(spark):
    feed = spark.createDataFrame([("A", Decimal(1)), ("A", Decimal(2)), ("B", Decimal(3))], "a string, POSAmount decimal(18,4)")
    out = spark.createDataFrame(
        [("A", Decimal(1), "final"), ("A", Decimal(2), "exception")], "a string, POSAmount decimal(18,4), outcome string"
    )
    assert rows(control.reconcile(feed, out, "a"), "a", "balanced") == [("A", True), ("B", False)]


def test_pre_aggregate_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int")
    assert rows(control.pre_aggregate(df, ["k"], ["v"])) == [("a", 1), (None, 5)]
    assert rows(control.pre_aggregate(df, ["k"], ["v"], keep_null_keys=False)) == [("a", 1)]


def test_observed_counts_while_rows_pass(spark):
    df, noted = control.observed(spark.sql("SELECT CAST(id AS DECIMAL(18,4)) AS POSAmount FROM range(5)"), "feed")
    df.write.format("noop").mode("overwrite").save()
    assert noted.get == {"rows": 5, "amount": Decimal(10)}


def test_membership(spark):
    master = spark.createDataFrame([("1",), ("2",), (None,)], "item_number string")
    listed = spark.createDataFrame([("1",), ("1",), (None,)], "ItemNumber string")
    assert rows(membership.invalid_items(master, listed)) == [("2",)]
    assert rows(membership.valid_items(master, listed)) == [("1",)]
    assert rows(membership.flag_items(master, listed)) == [("1", 0), ("2", 1)]


def test_accounts_not_yet_run(spark):
    accounts = spark.createDataFrame([("Amazon",), ("kmart",)], "account string")
    done = spark.createDataFrame([("AMAZON",), (None,)], "`ACCT MAJOR` string")
    assert rows(membership.not_yet_run(accounts, done, "account", "ACCT MAJOR")) == [("kmart",)]


def test_positional_and_null_filters(spark):
    df = spark.createDataFrame(
        [("s", 0, "a", None), ("s", 1, None, None), ("t", 5, "b", "c")], "sheet string, row int, x string, y string"
    )
    assert rows(filters.drop_last_row(df, ["sheet"], "row"), "sheet", "row") == [("s", 0)]
    assert rows(filters.drop_all_null(df, ["x", "y"]), "row") == [(0,), (5,)]
    assert filters.drop_empty_columns(df.filter("sheet = 's'")).columns == ["sheet", "row", "x"]


def test_reshape(spark):
    # The pivot example: values by row, one column per key.
    data = [(0, "foo", "oranges"), (1, "bar", "bananas"), (2, "baz", "apples"), (3, "foo", "grapes"), (4, "bar", "kiwis")]
    df = spark.createDataFrame(data, "i int, key string, val string")
    wide = reshape.pivot_first(df, ["i"], "key", "val", F.col("i"), ["bar", "baz", "foo"])
    assert rows(wide) == [
        (0, None, None, "oranges"), (1, "bananas", None, None), (2, None, "apples", None),
        (3, None, None, "grapes"), (4, "kiwis", None, None),
    ]
    across = reshape.pivot_first(df.withColumn("one", F.lit(1)), ["one"], "key", "val", F.col("i"), ["bar", "baz", "foo"])
    assert rows(across) == [(1, "bananas", "apples", "oranges")]
    late = spark.createDataFrame([("k", 1, None), ("k", 2, 7), (None, 3, 8)], "key string, i int, val int").withColumn("one", F.lit(1))
    assert rows(reshape.pivot_first(late, ["one"], "key", "val", F.col("i"), ["k"])) == [(1, 7)]
    with pytest.raises(Exception, match="key is not listed: baz"):
        rows(reshape.pivot_sum(df, ["i"], "key", "i", ["bar", "foo"]))
    periods = spark.createDataFrame([("x", 1, 2)], "item string, `201901` int, `201902` int")
    assert rows(reshape.to_long(periods, ["item"], ["201901", "201902"], "period", "value")) == [
        ("x", "201901", 1), ("x", "201902", 2),
    ]
    turned = reshape.transposed(
        spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "n string, p int, q int"), "n", ["a", "b"], ["p", "q"]
    )
    assert rows(turned) == [("p", 1, 3), ("q", 2, 4)]


def test_sets(spark):
    left = spark.createDataFrame([(1, "a")], "x int, y string")
    right = spark.createDataFrame([("b", 2)], "z string, x int")
    assert rows(sets.append(left, right)) == [(1, "a", None), (2, None, "b")]
    measures = sets.seeded_values(["u", "d"], spark.createDataFrame([("d",), ("e",), (None,)], "m string"), "m")
    assert rows(measures) == [("d",), ("e",), ("u",)]
    crossed = sets.each_with_all(spark.range(2), ["u", "d", "e", "d"], "m")
    assert rows(crossed) == [(i, m) for i in (0, 1) for m in ("d", "e", "u")]
    plan = crossed._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_periods_become_rows_after_the_sums(spark):
    sheet = spark.sql(
        "SELECT * FROM VALUES ('1', 'u', 1, NULL), ('1', 'u', 2, NULL), ('1', NULL, 5, 6), (NULL, 'u', 7, 7), ('Inventory', 'u', 8, 8) "
        "AS t(`Item Nbr`, `Data Type`, `2001`, `2002`)"
    )
    summed = summed_rows(sheet, ["2001", "2002"], ("Item Nbr", "Data Type"))
    long = period_rows(summed, ["2001", "2002"], ids=("Item Nbr", "n"))
    assert rows(long, "Item Nbr", "Data Type", "period", "n", "value") == [
        ("1", "u", "2001", 2, 3), ("1", "u", "2002", 2, None), ("1", None, "2001", 1, 5), ("1", None, "2002", 1, 6),
    ]


def test_unpivoted_rows_are_not_shuffled(spark, tmp_path):
    spark.sql("SELECT 1L AS l_partkey, 0.1D AS l_tax, 'A' AS l_returnflag, 3D AS l_quantity, TIMESTAMP '1997-05-05' AS l_shipdate").write.parquet(
        str(tmp_path / "lineitem.parquet")
    )
    found = QUERIES["unpivot_periods"](spark, str(tmp_path))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.index("Expand") < text.index("Exchange")  # above it
    assert rows(found.filter("value IS NOT NULL")) == [("1", "Total Units Sold", "1997", 1, 3.0)] and found.count() == 7
