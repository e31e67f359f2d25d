"""Filters, joins, duplicates, sets and totals over line items and parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posloom.catalog import views as v
from posloom.catalog.account_sql import strict_feed_sql
from posloom.catalog.registry import register
from posloom.functions import calendar as cal
from posloom.functions import conditions as cond
from posloom.functions import numbers as num
from posloom.functions import text
from posloom.operators import control, dedup, fanout, filters, lookup, membership, reshape, sets
from posloom.plans.accounts import ACCOUNTS
from posloom.plans.consolidated import consolidated_outcomes
from posloom.plans.engine import layout_errors, run_account
from posloom.plans.master import Master, measured
from posloom.plans.publish import gate, stage
from posloom.schema import PREMIUM_BRANDS

WITH = v.common_sql()
ROW = ["src_file", "src_sheet", "src_row"]
ROW_SQL = ", ".join(ROW)
PREMIUM = "({})".format(", ".join(f"'{brand}'" for brand in PREMIUM_BRANDS))
WEEK = dt.date(2020, 2, 22)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.common_feed(spark, sf_dir)


def master(spark: SparkSession, sf_dir: str) -> Master:
    return measured(v.master_rows(spark, sf_dir))


# --- all accounts at once ---------------------------------------------------

KEY_CASE = " ".join(f"WHEN '{a}' THEN {c}" for a, c in v.ACCOUNT_KEYS.items())
LONG = (
    "long AS (SELECT account, account_key, item_number, short_brand, master_row FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS account, {c} AS account_key, item_number, short_brand, master_row FROM master"
        for a, c in v.ACCOUNT_KEYS.items()
    )
    + ") WHERE account_key IS NOT NULL)"
)
OUTCOMES = (
    WITH + ", " + LONG + ", firsts AS (SELECT * FROM long QUALIFY row_number() OVER "
    "(PARTITION BY account, account_key ORDER BY master_row) = 1), "
    "outcomes AS (SELECT feed.*, firsts.item_number AS ItemNumber, CASE WHEN firsts.item_number IS NOT NULL "
    f"THEN CASE WHEN short_brand IN {PREMIUM} THEN 'Premium' ELSE 'Mainline' END END AS MainlinePremium, "
    "CASE WHEN firsts.item_number IS NOT NULL THEN 'final' ELSE 'exception' END AS outcome "
    "FROM feed LEFT JOIN firsts ON feed.account = firsts.account AND feed.cust_item = firsts.account_key "
    "WHERE POSAmount IS NULL OR POSAmount <> 0) "
)


def sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).filter(cond.nonzero(F.col("POSAmount")))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidated_outcomes(sold(spark, sf_dir), master(spark, sf_dir), v.ACCOUNT_KEYS)


@register(
    "pos_control_totals",
    OUTCOMES + "SELECT upper(account) AS AccountMajor, MainlinePremium, "
    "CAST(sum(POSAmount) AS DOUBLE) AS POSAmount, CAST(sum(POSQuantity) AS BIGINT) AS POSQuantity, "
    "count(*) AS row_count FROM outcomes WHERE outcome = 'final' GROUP BY ALL",
)
def _(spark, sf_dir):
    final = outcomes(spark, sf_dir).filter("outcome = 'final'")
    final = final.withColumn("AccountMajor", F.upper("account"))
    return control.control_totals(final, ("AccountMajor", "MainlinePremium"), "outcome")


@register(
    "pos_final_rows",
    OUTCOMES + "SELECT upper(account) AS AccountMajor, upper(account) AS Account, "
    "CASE WHEN channel = 'ONLINE' THEN 'Clicks' ELSE 'Bricks' END AS BricksClicks, "
    "cust_item AS CustItemNumber, concat('Item ', src_sheet) AS CustItemDesc, stock_no AS CustVendStkNo, "
    "'' AS ItemID, ItemNumber, MainlinePremium, CAST(POSAmount AS DOUBLE) AS POSAmount, POSQuantity, "
    "upc AS UPC, '2020-02-22' AS WeekEnding FROM outcomes WHERE outcome = 'final'",
)
def _(spark, sf_dir):
    final = outcomes(spark, sf_dir).filter("outcome = 'final'")
    return final.select(
        F.upper("account").alias("AccountMajor"),
        F.upper("account").alias("Account"),
        cond.clicks_when(F.col("channel"), "ONLINE").alias("BricksClicks"),
        F.col("cust_item").alias("CustItemNumber"),
        F.concat(F.lit("Item "), F.col("src_sheet")).alias("CustItemDesc"),
        F.col("stock_no").alias("CustVendStkNo"),
        F.lit("").alias("ItemID"),
        "ItemNumber",
        "MainlinePremium",
        "POSAmount",
        "POSQuantity",
        F.col("upc").alias("UPC"),
        F.lit(WEEK).alias("WeekEnding"),
    )


@register(
    "pos_exceptions",
    OUTCOMES + f"SELECT {ROW_SQL}, account, cust_item, CAST(POSAmount AS DOUBLE) AS POSAmount, POSQuantity "
    "FROM outcomes WHERE outcome = 'exception'",
)
def _(spark, sf_dir):
    failed = outcomes(spark, sf_dir).filter("outcome = 'exception'")
    return failed.select(*ROW, "account", "cust_item", "POSAmount", "POSQuantity")


@register(
    "reconcile_rows",
    OUTCOMES + ", fed AS (SELECT account, count(*) AS feed_rows, coalesce(sum(POSAmount), 0) AS feed_amount "
    "FROM feed WHERE POSAmount IS NULL OR POSAmount <> 0 GROUP BY account), "
    "done AS (SELECT account, count(*) FILTER (outcome = 'final') AS final_rows, "
    "count(*) FILTER (outcome = 'exception') AS exception_rows, coalesce(sum(POSAmount), 0) AS outcome_amount "
    "FROM outcomes GROUP BY account) SELECT account, feed_rows, CAST(feed_amount AS DOUBLE) AS feed_amount, "
    "final_rows, exception_rows, CAST(outcome_amount AS DOUBLE) AS outcome_amount, "
    "(feed_rows = final_rows + exception_rows AND feed_amount = outcome_amount) AS balanced "
    "FROM fed JOIN done USING (account)",
)
def _(spark, sf_dir):
    return control.reconcile(sold(spark, sf_dir), outcomes(spark, sf_dir), "account")


@register(
    "gate_clean_accounts",
    OUTCOMES + "SELECT account, src_file, outcome, count(*) AS n FROM outcomes o WHERE NOT EXISTS "
    "(SELECT 1 FROM outcomes x WHERE x.outcome = 'exception' AND x.account = o.account "
    "AND x.src_file = o.src_file AND x.src_sheet = o.src_sheet) GROUP BY ALL",
)
def _(spark, sf_dir):
    # As in publishing: outcomes are computed once, staged, and read by the gate.
    rows = outcomes(spark, sf_dir).select("account", "src_file", "src_sheet", "outcome")
    passed = gate(stage(rows, spark, "outcomes"), ("account", "src_file", "src_sheet"))
    return passed.groupBy("account", "src_file", "outcome").agg(F.count(F.lit(1)).alias("n"))


@register("master_long", WITH + ", " + LONG + " SELECT account, account_key, item_number, master_row FROM long")
def _(spark, sf_dir):
    return reshape.master_long(
        v.master_rows(spark, sf_dir), v.ACCOUNT_KEYS, ["item_number", "master_row"]
    ).select("account", "account_key", "item_number", "master_row")


# --- filters ----------------------------------------------------------------


def _filter_query(name: str, where: str, keep, columns: list[str]) -> None:
    shown = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c == "POSAmount" else c for c in columns)

    @register(name, f"{WITH} SELECT {ROW_SQL}, {shown} FROM feed WHERE {where}")
    def _(spark, sf_dir):
        return feed(spark, sf_dir).filter(keep()).select(*ROW, *columns)


_filter_query(
    "nonzero_null_passes", "POSAmount IS NULL OR POSAmount <> 0",
    lambda: cond.nonzero(F.col("POSAmount")), ["POSAmount"],
)
_filter_query(
    "nonnull_nonzero", "POSAmount <> 0", lambda: cond.known_nonzero(F.col("POSAmount")), ["POSAmount"]
)
_filter_query("positive_only", "POSAmount > 0", lambda: cond.positive(F.col("POSAmount")), ["POSAmount"])
_filter_query("not_null_filter", "item IS NOT NULL", lambda: F.col("item").isNotNull(), ["item"])
_filter_query("null_filter", "item IS NULL", lambda: F.col("item").isNull(), ["account"])
_filter_query(
    "sentinel_filter", "channel IS NULL OR channel <> 'DC'",
    lambda: cond.not_sentinel(F.col("channel"), "DC"), ["channel"],
)
_filter_query(
    "conjunction_filter", "POSAmount > 0 AND item IS NOT NULL",
    lambda: filters.all_of([cond.positive(F.col("POSAmount")), F.col("item").isNotNull()]),
    ["item", "POSAmount"],
)
_filter_query(
    "prefix_filter", "substr(upc, 1, 2) IN ('19','44','52','65','72','93')",
    lambda: text.starts_with_any(F.col("upc"), text.SHORTENED_UPC_PREFIXES), ["upc"],
)
_filter_query("substring_filter", "contains(upc, '880')", lambda: F.col("upc").contains("880"), ["upc"])


@register(
    "in_list_filter",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def _(spark, sf_dir):
    orders = v.table(spark, sf_dir, "orders")
    return filters.in_list(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"]).select(
        "o_orderkey", "o_orderpriority"
    )


@register(
    "measure_lookup",
    "SELECT o_orderpriority, o_orderstatus, o_totalprice FROM orders "
    "WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'",
)
def _(spark, sf_dir):
    orders = v.table(spark, sf_dir, "orders")
    keys = {"o_orderpriority": "1-URGENT", "o_orderstatus": "F"}
    return filters.measure_lookup(orders, keys, "o_totalprice")


# --- joins ------------------------------------------------------------------


def _first(key: str, extra: str = "") -> str:
    return (
        f", firsts AS (SELECT * FROM master {extra} QUALIFY row_number() OVER "
        f"(PARTITION BY {key} ORDER BY master_row) = 1) "
    )


def _lookup_query(name: str, feed_key, feed_sql: str, key: str, null_safe: bool = False) -> None:
    same = "IS NOT DISTINCT FROM" if null_safe else "="

    @register(
        name,
        WITH + _first(key) + f"SELECT {ROW_SQL}, {feed_sql} AS feed_key, item_number, short_brand "
        f"FROM feed LEFT JOIN firsts ON {feed_sql} {same} {key}",
    )
    def _(spark, sf_dir):
        items = master(spark, sf_dir)
        dim = lookup.first_match(
            items.rows.select(F.col(key).alias("m_key"), "item_number", "short_brand", "master_row"),
            "m_key", ["master_row"],
        )
        keyed = feed(spark, sf_dir).select(*ROW, feed_key().alias("feed_key"))
        return lookup.lookup(
            keyed, dim, [("feed_key", "m_key")], null_safe=null_safe, dim_bytes=items.size
        ).drop("m_key", "master_row")


_lookup_query("left_match_strict", lambda: F.col("item"), "item", "amazon_id")
_lookup_query("left_match_nullsafe", lambda: F.col("item"), "item", "amazon_id", null_safe=True)
_lookup_query("left_match_stock", lambda: F.col("stock_no"), "stock_no", "item_number")
_lookup_query(
    "left_match_upc", lambda: text.pad_upc(F.col("upc")),
    "CASE WHEN substr(upc, 1, 2) IN ('19','44','52','65','72','93') THEN concat('0', upc) ELSE upc END", "upc12",
)
_lookup_query(
    "left_match_short_upc", lambda: text.from_offset(F.col("upc"), 2), "upc[3:]", "short_upc"
)


@register(
    "weighted_match",
    WITH + _first("short_upc") + f"SELECT {ROW_SQL}, item_number FROM feed LEFT JOIN firsts ON upc[3:] = short_upc",
)
def _(spark, sf_dir):
    """The join for masters beyond the broadcast limit, whatever the size here."""
    items = v.master_rows(spark, sf_dir).select("short_upc", "item_number", "master_row")
    dim = lookup.first_match(items, "short_upc", ["master_row"])
    keyed = feed(spark, sf_dir).select(*ROW, text.from_offset(F.col("upc"), 2).alias("feed_key"))
    return lookup.weighted_lookup(keyed, dim, [("feed_key", "short_upc")]).select(*ROW, "item_number")


@register(
    "fan_out_join",
    WITH + f"SELECT {ROW_SQL}, stock_no, master_row FROM feed LEFT JOIN master "
    "ON stock_no IS NOT DISTINCT FROM item_number",
)
def _(spark, sf_dir):
    items = master(spark, sf_dir)
    dim = items.rows.select("item_number", "master_row")
    keyed = feed(spark, sf_dir).select(*ROW, "stock_no")
    return lookup.fan_out_join(
        keyed, dim, [("stock_no", "item_number")], master_bytes=items.size
    ).drop("item_number")


CASCADE = (
    WITH + ", d1 AS (SELECT * FROM master QUALIFY row_number() OVER (PARTITION BY amazon_id ORDER BY master_row) = 1), "
    "d2 AS (SELECT * FROM master QUALIFY row_number() OVER (PARTITION BY item_number ORDER BY master_row) = 1), "
    "both_passes AS (SELECT feed.*, d1.item_number AS i1, d2.item_number AS i2 FROM feed "
    "LEFT JOIN d1 ON item = d1.amazon_id LEFT JOIN d2 ON stock_no = d2.item_number) "
)


def cascade(spark, sf_dir):
    items = master(spark, sf_dir)
    rows = feed(spark, sf_dir)
    matched = rows
    for number, (feed_key, key) in enumerate([("item", "amazon_id"), ("stock_no", "item_number")], 1):
        dim = lookup.first_match(items.rows, key, ["master_row"]).select(
            F.col(key).alias(f"k{number}"), F.col("item_number").alias(f"i{number}")
        )
        matched = lookup.lookup(matched, dim, [(feed_key, f"k{number}")], dim_bytes=items.bytes_of(key, "item_number"))
    return matched.withColumns(
        {
            "ItemNumber": F.coalesce("i1", "i2"),
            "match_pass": F.when(F.col("i1").isNotNull(), 1).when(F.col("i2").isNotNull(), 2),
        }
    )


@register(
    "two_pass_cascade",
    CASCADE + f"SELECT {ROW_SQL}, coalesce(i1, i2) AS ItemNumber, CASE WHEN i1 IS NOT NULL THEN 1 "
    "WHEN i2 IS NOT NULL THEN 2 END AS match_pass FROM both_passes",
)
def _(spark, sf_dir):
    return cascade(spark, sf_dir).select(*ROW, "ItemNumber", "match_pass")


@register(
    "matched_exception_split",
    CASCADE + "SELECT account, (coalesce(i1, i2) IS NOT NULL) AS matched, count(*) AS n, "
    "CAST(sum(POSAmount) AS DOUBLE) AS POSAmount FROM both_passes GROUP BY ALL",
)
def _(spark, sf_dir):
    split = cascade(spark, sf_dir).withColumn("matched", F.col("ItemNumber").isNotNull())
    return split.groupBy("account", "matched").agg(
        F.count(F.lit(1)).alias("n"), F.sum("POSAmount").alias("POSAmount")
    )


@register(
    "fanout_by_rows",
    WITH + "SELECT ((SELECT count(*) FROM feed LEFT JOIN master ON stock_no IS NOT DISTINCT FROM item_number) "
    "<> (SELECT count(*) FROM feed)) AS fan_out",
)
def _(spark, sf_dir):
    items = master(spark, sf_dir)
    return fanout.rows_multiply(
        feed(spark, sf_dir), items.rows, "stock_no", "item_number", master_bytes=items.size
    )


@register(
    "fanout_by_amount",
    WITH + "SELECT (coalesce((SELECT sum(POSAmount) FROM feed LEFT JOIN master ON stock_no IS NOT DISTINCT FROM "
    "item_number), 0) <> coalesce((SELECT sum(POSAmount) FROM feed), 0)) AS fan_out",
)
def _(spark, sf_dir):
    items = master(spark, sf_dir)
    return fanout.amount_changes(
        feed(spark, sf_dir), items.rows, "stock_no", "item_number", master_bytes=items.size
    )


WAREHOUSE = "warehouse AS (SELECT DISTINCT concat('IT', CAST(l_partkey AS STRING)) AS ItemNumber FROM lineitem WHERE l_discount = 0.1)"


def warehouse(spark, sf_dir):
    """Items sold at the full discount stand for the warehouse's list."""
    lines = v.table(spark, sf_dir, "lineitem").where("l_discount = 0.1")
    return lines.selectExpr(f"{v.STOCK} AS ItemNumber").distinct()


@register(
    "master_invalid_items",
    WITH + f", {WAREHOUSE} SELECT item_number, master_row FROM master WHERE item_number IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM warehouse w WHERE w.ItemNumber = item_number)",
)
def _(spark, sf_dir):
    items = v.master_rows(spark, sf_dir).select("item_number", "master_row")
    return membership.invalid_items(items, warehouse(spark, sf_dir))


@register(
    "master_valid_items",
    WITH + f", {WAREHOUSE} SELECT item_number, master_row FROM master WHERE EXISTS "
    "(SELECT 1 FROM warehouse w WHERE w.ItemNumber = item_number)",
)
def _(spark, sf_dir):
    items = v.master_rows(spark, sf_dir).select("item_number", "master_row")
    return membership.valid_items(items, warehouse(spark, sf_dir))


@register(
    "master_flag",
    WITH + f", {WAREHOUSE} SELECT item_number, master_row, CASE WHEN ItemNumber IS NULL THEN 1 ELSE 0 END AS invalid "
    "FROM master LEFT JOIN warehouse ON ItemNumber = item_number WHERE item_number IS NOT NULL",
)
def _(spark, sf_dir):
    items = v.master_rows(spark, sf_dir).select("item_number", "master_row")
    return membership.flag_items(items, warehouse(spark, sf_dir))


@register(
    "item_measure_cross",
    "SELECT p_partkey, measure FROM part CROSS JOIN (SELECT unnest(['view', 'units', 'dollars', 'margin']) AS measure)",
)
def _(spark, sf_dir):
    items = v.table(spark, sf_dir, "part").select("p_partkey")
    return sets.each_with_all(items, ["view", "units", "dollars", "margin", "units"], "measure")


# --- duplicates -------------------------------------------------------------


@register(
    "dedup_first",
    WITH + f"SELECT {ROW_SQL}, item, channel, POSQuantity FROM feed QUALIFY row_number() OVER "
    f"(PARTITION BY item, channel, POSQuantity ORDER BY {ROW_SQL}) = 1",
)
def _(spark, sf_dir):
    rows = feed(spark, sf_dir).select(*ROW, "item", "channel", "POSQuantity")
    return dedup.first_per_key(rows, ["item", "channel", "POSQuantity"], ROW)


def _dedup_if(name: str, changed: str, key: str, feed_key: str, make_flag) -> None:
    @register(
        name,
        WITH + f", joined AS (SELECT feed.*, master_row FROM feed LEFT JOIN master ON {feed_key} "
        f"IS NOT DISTINCT FROM {key}) SELECT {ROW_SQL}, {feed_key} AS feed_key, POSQuantity FROM feed "
        f"QUALIFY NOT ({changed}) OR row_number() OVER (PARTITION BY {feed_key}, POSQuantity ORDER BY {ROW_SQL}) = 1",
    )
    def _(spark, sf_dir):
        items = master(spark, sf_dir)
        rows = feed(spark, sf_dir)
        flag = make_flag(rows, items.rows, feed_key, key, master_bytes=items.size)
        kept = rows.select(*ROW, F.col(feed_key).alias("feed_key"), "POSQuantity")
        return dedup.first_per_key_if(kept, flag, ["feed_key", "POSQuantity"], ROW)


_dedup_if(
    "dedup_if_rows", "(SELECT count(*) FROM joined) <> (SELECT count(*) FROM feed)",
    "item_number", "stock_no", fanout.rows_multiply,
)
_dedup_if(
    "dedup_if_amount", "(SELECT coalesce(sum(POSAmount), 0) FROM joined) <> (SELECT coalesce(sum(POSAmount), 0) FROM feed)",
    "item_number", "stock_no", fanout.amount_changes,
)
# No feed UPC stands in the customer number column, so nothing can fan out.
_dedup_if(
    "dedup_if_not_needed", "(SELECT count(*) FROM joined) <> (SELECT count(*) FROM feed)",
    "amazon_id", "upc", fanout.rows_multiply,
)


@register(
    "keep_first_match",
    WITH + f"SELECT {ROW_SQL}, item_number FROM (SELECT f.*, item_number, master_row FROM "
    "(SELECT *, row_number() OVER () AS id FROM feed) f LEFT JOIN master ON item = meijer_id) "
    "QUALIFY row_number() OVER (PARTITION BY id ORDER BY master_row) = 1",
)
def _(spark, sf_dir):
    items = master(spark, sf_dir)
    dim = lookup.first_match(items.rows, "meijer_id", ["master_row"]).select("meijer_id", "item_number")
    keyed = feed(spark, sf_dir).select(*ROW, "item")
    return lookup.lookup(keyed, dim, [("item", "meijer_id")], dim_bytes=items.size).select(*ROW, "item_number")


# --- totals -----------------------------------------------------------------

PRE = (
    "SELECT item, channel, CAST(sum(amount) AS DOUBLE) AS POSAmount, CAST(sum(POSQuantity) AS BIGINT) AS POSQuantity "
    "FROM (SELECT *, CAST(round_even(POSQuantity * CAST(price AS DECIMAL(18,4)), 2) AS DECIMAL(18,4)) AS amount FROM "
    "(SELECT feed.*, CAST(src_file AS BIGINT) * 0.125 AS price FROM feed)) "
)


def _pre(spark, sf_dir, keep_null_keys):
    price = (F.col("src_file").cast("bigint") * F.lit(0.125).cast("decimal(4,3)")).cast("decimal(18,4)")
    rows = feed(spark, sf_dir).withColumn("price", price)
    rows = rows.withColumn(
        "POSAmount", num.round_cents(num.extended_amount(F.col("POSQuantity"), F.col("price")))
    )
    return control.pre_aggregate(rows, ["item", "channel"], ["POSAmount", "POSQuantity"], keep_null_keys)


@register("preagg_drop_null_keys", WITH + PRE + "WHERE item IS NOT NULL AND channel IS NOT NULL GROUP BY ALL")
def _(spark, sf_dir):
    return _pre(spark, sf_dir, keep_null_keys=False)


@register("preagg_keep_null_keys", WITH + PRE + "GROUP BY ALL")
def _(spark, sf_dir):
    return _pre(spark, sf_dir, keep_null_keys=True)


@register(
    "nonnull_item_count",
    CASCADE + "SELECT account AS AccountMajor, CAST(sum(POSAmount) AS DOUBLE) AS POSAmount, "
    "CAST(sum(POSQuantity) AS BIGINT) AS POSQuantity, count(i1) AS row_count FROM both_passes GROUP BY account",
)
def _(spark, sf_dir):
    rows = cascade(spark, sf_dir).withColumn("AccountMajor", F.col("account"))
    return control.control_totals(rows, counted="i1")


@register("total_amount", WITH + "SELECT CAST(coalesce(sum(POSAmount), 0) AS DOUBLE) AS POSAmount FROM feed")
def _(spark, sf_dir):
    return control.total(feed(spark, sf_dir), "POSAmount")


@register(
    "total_of_unknown",
    WITH + "SELECT CAST(coalesce(sum(POSAmount), 0) AS DOUBLE) AS POSAmount FROM feed WHERE POSAmount IS NULL",
)
def _(spark, sf_dir):
    return control.total(feed(spark, sf_dir).filter(F.col("POSAmount").isNull()), "POSAmount")


@register("row_count", "SELECT count(*) AS n FROM lineitem")
def _(spark, sf_dir):
    return feed(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


# --- tags and dates on sales rows -------------------------------------------


@register(
    "brand_tier",
    WITH + f"SELECT item_number, master_row, CASE WHEN short_brand IN {PREMIUM} THEN 'Premium' ELSE 'Mainline' END "
    "AS MainlinePremium FROM master",
)
def _(spark, sf_dir):
    return v.master_rows(spark, sf_dir).select(
        "item_number", "master_row", cond.brand_tier(F.col("short_brand")).alias("MainlinePremium")
    )


@register(
    "channel_tag",
    WITH + f"SELECT {ROW_SQL}, CASE WHEN channel = 'ONLINE' THEN 'Clicks' ELSE 'Bricks' END AS by_online, "
    "CASE WHEN channel = 'STORE' THEN 'Bricks' ELSE 'Clicks' END AS by_store FROM feed",
)
def _(spark, sf_dir):
    return feed(spark, sf_dir).select(
        *ROW,
        cond.clicks_when(F.col("channel"), "ONLINE").alias("by_online"),
        cond.bricks_when(F.col("channel"), "STORE").alias("by_store"),
    )


@register(
    "week_totals",
    WITH + "SELECT strftime(date_trunc('week', sale_date)::DATE + 5, '%Y-%m-%d') AS WeekEnding, account, "
    "CAST(sum(POSAmount) AS DOUBLE) AS POSAmount, count(*) AS n FROM feed GROUP BY ALL",
)
def _(spark, sf_dir):
    stamped = feed(spark, sf_dir).withColumn("WeekEnding", cal.week_saturday(F.col("sale_date")))
    return stamped.groupBy("WeekEnding", "account").agg(
        F.sum("POSAmount").alias("POSAmount"), F.count(F.lit(1)).alias("n")
    )


# --- checks of a run --------------------------------------------------------

# Cells as text: every second line's amount and every third line's units are no number.
BAD_CELLS = {
    **v.SOURCE,
    **v.FEEDS["amazon"],
    "Ordered Revenue": "CASE WHEN l_linenumber = 2 THEN concat('$', CAST(l_extendedprice AS STRING)) "
    "WHEN l_discount = 0 THEN '0' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END",
    "Ordered Units": "CASE WHEN l_linenumber = 3 THEN '1,000' WHEN l_linenumber = 4 THEN '99999999999' "
    "ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
}


@register(
    "bad_cells",
    "SELECT CASE l_linenumber WHEN 2 THEN 'bad_amount' WHEN 3 THEN 'bad_quantity' WHEN 4 THEN 'bad_quantity' END AS reason, "
    "count(*) AS n FROM lineitem WHERE l_linenumber IN (2, 3, 4) GROUP BY ALL",
)
def _(spark, sf_dir):
    """Rows with unreadable cells are exceptions that say so, whatever the filters ask."""
    cells = v.table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS `{n}`" for n, e in BAD_CELLS.items()])
    master = measured(v.master_rows(spark, sf_dir))
    rows = run_account(ACCOUNTS["amazon"], cells, master, dt.date(2020, 3, 1)).rows
    return rows.filter("outcome = 'exception' AND reason LIKE 'bad%'").groupBy("reason").agg(F.count("*").alias("n"))


@register(
    "layout_errors_reported",
    "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS path, problem FROM lineitem, LATERAL (VALUES "
    "('no column Vendor Stock Nbr', l_suppkey % 3 = 1), ('no sheet number 0 with a header row', l_suppkey % 3 = 2)) r(problem, holds) "
    "WHERE holds",
)
def _(spark, sf_dir):
    """One workbook per supplier: a third lacks a column, a third has no first sheet."""
    names = ["Item Nbr", "Item Desc 1", "Vendor Stock Nbr", "Total Sell Dollars", "Total Units Sold"]
    header = F.array(*[F.lit(n) for n in names])
    third = F.col("l_suppkey") % 3
    kept = F.when(third == 1, F.filter(header, lambda n: n != "Vendor Stock Nbr")).otherwise(header)
    sales = v.table(spark, sf_dir, "lineitem")
    sheet = F.when(third == 2, 1).otherwise(0).alias("sheet_idx")
    path = F.col("l_suppkey").cast("string").alias("path")
    heads = sales.select(path, sheet, F.lit("S").alias("sheet_name"), F.lit(0).cast("long").alias("row_idx"), kept.alias("cells")).distinct()
    cells = F.transform(kept, lambda n: F.col("l_extendedprice").cast("string"))
    body = sales.select(path, sheet, F.lit("S").alias("sheet_name"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_idx"), cells.alias("cells"))
    return layout_errors(ACCOUNTS["sams"], heads.unionByName(body)).select("path", "problem")


WATCHED = ["amazon", "depot", "walmart"]


@register(
    "run_metrics",
    " UNION ALL ".join(
        f"SELECT '{name}' AS account, (SELECT count(*) FROM ({strict_feed_sql(name)})) AS feed_rows, "
        f"(SELECT CAST(coalesce(sum(POSAmount), 0) AS DOUBLE) FROM ({strict_feed_sql(name)})) AS feed_amount"
        for name in WATCHED
    ),
)
def _(spark, sf_dir):
    """Feed rows and amounts noted by observations while the outcomes are staged."""
    watched = {}
    master = measured(v.master_rows(spark, sf_dir))
    for name in WATCHED:
        def watch(feed, name=name):
            feed, watched[name] = control.observed(feed, f"metrics {name}")
            return feed

        rows = run_account(ACCOUNTS[name], v.raw_feed(spark, sf_dir, name), master, dt.date(2020, 3, 1), watch=watch).rows
        rows.write.format("noop").mode("overwrite").save()
    found = [(name, o.get["rows"], o.get["amount"]) for name, o in watched.items()]
    return spark.createDataFrame(found, "account string, feed_rows long, feed_amount decimal(38,4)")
