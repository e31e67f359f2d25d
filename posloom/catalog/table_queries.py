"""Grids, reshapes, strings, numbers, dates and files over the other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posloom.catalog import views as v
from posloom.catalog.registry import register
from posloom.functions import calendar as cal
from posloom.functions import conditions as cond
from posloom.functions import numbers as num
from posloom.functions import text
from posloom.operators import filters, membership, reshape, sets
from posloom.plans.periods import MEASURES, period_report, period_rows, summed_rows
from posloom.sources import files as listing
from posloom.sources import grid as g
from posloom.sources.spine import date_spine, with_random_value

CUSTOMER = "CAST(c_custkey AS STRING)"
BALANCE = "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING)"


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "customer")


# --- sheets: every customer is a small workbook -----------------------------
# Row 0 is a title, row 1 the header, row 2 has blanks, row 3 and 4 are data
# (row 4 without the balance where it is negative), row 5 is the total.

HEADER = "array('Name', 'Item Nbr', 'POS Sales 1', '', 'POS Sales 2', 'POS Qty', 'Name')"


def customer_grid(spark: SparkSession, sf_dir: str, header: str = HEADER) -> DataFrame:
    rows = f"""array(
        array('Weekly report', NULL, NULL, NULL, NULL, NULL, NULL),
        {header},
        array(c_name, NULL, NULL, NULL, NULL, NULL, NULL),
        array(c_name, {CUSTOMER}, '1', c_mktsegment, {BALANCE}, '7', 'x'),
        array(c_name, {CUSTOMER}, '2', c_mktsegment, CASE WHEN c_acctbal < 0 THEN NULL ELSE {BALANCE} END, '8', 'y'),
        array('Total', 'Total', '3', 'Total', {BALANCE}, '15', 'z'))"""
    return customer(spark, sf_dir).selectExpr(
        f"concat('book-', {CUSTOMER}) AS path",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'Total' ELSE c_mktsegment END AS sheet_name",
        "c_nationkey AS sheet_idx",
        f"posexplode({rows}) AS (row_idx, cells)",
    ).withColumn("row_idx", F.col("row_idx").cast("bigint"))


SHEET_VALUES = (
    f"SELECT concat('book-', {CUSTOMER}) AS path, c_name, {CUSTOMER} AS nbr, c_mktsegment AS segment, "
    f"{BALANCE} AS balance, c_acctbal < 0 AS negative, c_nationkey FROM customer"
)


@register(
    "header_skip",
    f"SELECT path, row_idx, name, r.nbr, blank, sales, again FROM ({SHEET_VALUES}) s, LATERAL (VALUES "
    "(CAST(2 AS BIGINT), c_name, NULL, NULL, NULL, NULL), (3, c_name, s.nbr, segment, balance, 'x'), "
    "(4, c_name, s.nbr, segment, CASE WHEN negative THEN NULL ELSE balance END, 'y'), "
    "(5, 'Total', 'Total', 'Total', balance, 'z')) r(row_idx, name, nbr, blank, sales, again)",
)
def _(spark, sf_dir):
    rows = g.named_rows(customer_grid(spark, sf_dir), 1)
    return rows.select(
        "path", "row_idx", g.cell("Name").alias("name"), g.cell("Item Nbr").alias("nbr"),
        g.cell("Unnamed: 3").alias("blank"), g.cell("POS Sales 2").alias("sales"),
        g.cell("Name.1").alias("again"),
    )


FULL_HEADER = "array('Name', 'Item Nbr', 'POS Sales 1', 'Segment', 'POS Sales 2', 'POS Qty', 'Mark')"


@register(
    "header_promotion",
    f"SELECT path, row_idx, name, r.segment, sales, mark FROM ({SHEET_VALUES}) s, LATERAL (VALUES "
    "(CAST(3 AS BIGINT), c_name, s.segment, balance, 'x'), "
    "(4, c_name, s.segment, CASE WHEN negative THEN NULL ELSE balance END, 'y'), "
    "(5, 'Total', 'Total', balance, 'z')) r(row_idx, name, segment, sales, mark) WHERE sales IS NOT NULL",
)
def _(spark, sf_dir):
    rows = g.named_rows(customer_grid(spark, sf_dir, FULL_HEADER), None)
    return rows.select(
        "path", "row_idx", g.cell("Name").alias("name"), g.cell("Segment").alias("segment"),
        g.cell("POS Sales 2").alias("sales"), g.cell("Mark").alias("mark"),
    )


@register(
    "first_complete_row_header",
    f"SELECT path, 'Name|Item Nbr|POS Sales 1|Segment|POS Sales 2|POS Qty|Mark' AS header FROM ({SHEET_VALUES})",
)
def _(spark, sf_dir):
    header = g.promoted_header(customer_grid(spark, sf_dir, FULL_HEADER))
    return header.select("path", F.array_join("header", "|").alias("header"))


@register(
    "unnamed_headers",
    f"SELECT path, 'Name|Item Nbr|POS Sales 1|Unnamed: 3|POS Sales 2|POS Qty|Name.1' AS header FROM ({SHEET_VALUES})",
)
def _(spark, sf_dir):
    header = g.header_at(customer_grid(spark, sf_dir), 1)
    return header.select("path", F.array_join("header", "|").alias("header"))


@register(
    "dynamic_column_pick",
    f"SELECT path, row_idx, amount, units FROM ({SHEET_VALUES}) s, LATERAL (VALUES "
    "(CAST(3 AS BIGINT), balance, '7'), (4, CASE WHEN negative THEN NULL ELSE balance END, '8'), "
    "(5, balance, '15'), (2, NULL, NULL)) r(row_idx, amount, units)",
)
def _(spark, sf_dir):
    rows = g.named_rows(customer_grid(spark, sf_dir), 1)
    return rows.select(
        "path", "row_idx", g.cell_with("POS Sales").alias("amount"),
        g.cell_with("POS Qty", unless="POS Sales").alias("units"),
    )


@register(
    "positional_slice",
    f"SELECT path, concat_ws('|', nbr, '1', balance, 'x') AS cells FROM ({SHEET_VALUES})",
)
def _(spark, sf_dir):
    data = customer_grid(spark, sf_dir).filter("row_idx = 3")
    picked = g.pick_positions(F.col("cells"), "B:C, E, G:H")
    return data.select("path", F.array_join(picked, "|").alias("cells"))


@register(
    "layout_dispatch",
    f"SELECT path, CASE WHEN segment = 'BUILDING' THEN 'late' ELSE 'early' END AS layout FROM ({SHEET_VALUES})",
)
def _(spark, sf_dir):
    mark = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Walmart Item Number' ELSE 'Item ID' END"
    grid = customer_grid(spark, sf_dir, f"array({mark}, 'b', 'c', 'd', 'e', 'f', 'g')")
    return g.layout_of(grid, {"late": (1, "Walmart Item Number"), "early": (1, "Item ID")}).select(
        "path", "layout"
    )


@register(
    "sheet_by_name",
    "SELECT count(*) * 6 AS n FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def _(spark, sf_dir):
    return g.sheet_named(customer_grid(spark, sf_dir), "Total").agg(F.count(F.lit(1)).alias("n"))


@register("sheet_by_index", "SELECT count(*) * 6 AS n FROM customer WHERE c_nationkey = 1")
def _(spark, sf_dir):
    return g.sheet_at(customer_grid(spark, sf_dir), 1).agg(F.count(F.lit(1)).alias("n"))


@register(
    "sheets_without_total",
    "SELECT c_mktsegment AS sheet_name, count(*) * 6 AS n FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY ALL",
)
def _(spark, sf_dir):
    kept = g.sheets_without(customer_grid(spark, sf_dir), "Total")
    return kept.groupBy("sheet_name").agg(F.count(F.lit(1)).alias("n"))


@register(
    "drop_last_row",
    "SELECT o_custkey, o_orderkey FROM orders QUALIFY o_orderkey < max(o_orderkey) OVER (PARTITION BY o_custkey)",
)
def _(spark, sf_dir):
    rows = v.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return filters.drop_last_row(rows, ["o_custkey"], "o_orderkey")


# --- rows with missing values -----------------------------------------------

GAPS = {
    "c_custkey": "c_custkey",
    "balance": "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END",
    "segment": "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END",
    "nation": "CASE WHEN c_nationkey < 5 THEN NULL ELSE c_nationkey END",
    "nothing": "CAST(NULL AS STRING)",
}
GAPS_SQL = f"SELECT {v.columns_sql(GAPS)} FROM customer"
SOME = ["balance", "segment", "nation"]


def gaps(spark, sf_dir):
    return customer(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in GAPS.items()])


@register("drop_any_null", f"SELECT c_custkey, balance, segment, nation FROM ({GAPS_SQL}) WHERE balance IS NOT NULL AND segment IS NOT NULL AND nation IS NOT NULL")
def _(spark, sf_dir):
    return filters.drop_any_null(gaps(spark, sf_dir).drop("nothing"))


@register("drop_all_null", f"SELECT c_custkey, balance, segment, nation FROM ({GAPS_SQL}) WHERE NOT (balance IS NULL AND segment IS NULL AND nation IS NULL)")
def _(spark, sf_dir):
    return filters.drop_all_null(gaps(spark, sf_dir).drop("nothing"), SOME)


@register("drop_subset_null", f"SELECT c_custkey, balance, segment, nation FROM ({GAPS_SQL}) WHERE balance IS NOT NULL AND nation IS NOT NULL")
def _(spark, sf_dir):
    return filters.drop_any_null(gaps(spark, sf_dir).drop("nothing"), ["balance", "nation"])


@register("drop_empty_columns", f"SELECT c_custkey, balance, segment, nation FROM ({GAPS_SQL})")
def _(spark, sf_dir):
    return filters.drop_empty_columns(gaps(spark, sf_dir))


@register("first_columns", f"SELECT c_custkey, balance, segment FROM ({GAPS_SQL})")
def _(spark, sf_dir):
    return filters.first_columns(gaps(spark, sf_dir), 3)


# --- sets -------------------------------------------------------------------


@register(
    "union_by_name",
    "SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier",
)
def _(spark, sf_dir):
    buyers = customer(spark, sf_dir).selectExpr("c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment")
    sellers = v.table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS nation", "s_name AS name")
    return sets.append(buyers, sellers)


@register(
    "seeded_values",
    "SELECT 'BUILDING' AS segment UNION SELECT 'ONLINE' UNION SELECT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL",
)
def _(spark, sf_dir):
    return sets.seeded_values(["BUILDING", "ONLINE"], customer(spark, sf_dir).withColumnRenamed("c_mktsegment", "segment"), "segment")


@register("distinct_accounts", "SELECT DISTINCT o_custkey FROM orders")
def _(spark, sf_dir):
    return sets.distinct_values(v.table(spark, sf_dir, "orders"), "o_custkey")


@register(
    "accounts_not_run",
    "SELECT DISTINCT lower(c_name) AS c_name FROM customer WHERE lower(c_name) NOT IN "
    "(SELECT concat('customer#', lpad(CAST(o_custkey AS STRING), 9, '0')) FROM orders WHERE o_orderstatus = 'F')",
)
def _(spark, sf_dir):
    done = v.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").selectExpr(
        "concat('CUSTOMER#', lpad(CAST(o_custkey AS STRING), 9, '0')) AS `ACCT MAJOR`"
    )
    return membership.not_yet_run(customer(spark, sf_dir), done, "c_name", "ACCT MAJOR")


@register(
    "latest_per_account",
    "SELECT account, arg_max(path, (file_mtime, path)) AS path, strftime(max(file_mtime), '%Y-%m-%d') AS file_mtime "
    "FROM (SELECT o_custkey AS account, concat('file-', lpad(CAST(o_orderkey AS STRING), 12, '0')) AS path, "
    "CAST(o_orderdate AS DATE) AS file_mtime FROM orders) GROUP BY account",
)
def _(spark, sf_dir):
    files = v.table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS account", "concat('file-', lpad(CAST(o_orderkey AS STRING), 12, '0')) AS path",
        "CAST(o_orderdate AS DATE) AS file_mtime",
    )
    return listing.latest_per_account(files)


@register(
    "newest_files",
    "SELECT path, strftime(file_mtime, '%Y-%m-%d') AS file_mtime FROM (SELECT concat('file-', "
    "lpad(CAST(o_orderkey AS STRING), 12, '0')) AS path, CAST(o_orderdate AS DATE) AS file_mtime FROM orders) "
    "ORDER BY file_mtime DESC, path LIMIT 5",
)
def _(spark, sf_dir):
    files = v.table(spark, sf_dir, "orders").selectExpr(
        "concat('file-', lpad(CAST(o_orderkey AS STRING), 12, '0')) AS path",
        "CAST(o_orderdate AS DATE) AS file_mtime",
    )
    return listing.newest(files, 5)


@register(
    "file_discovery",
    "SELECT url, account FROM pages, (VALUES ('fr', 'FR!'), ('de', 'D-E'), ('thth', 'thth')) t(account, token) "
    r"WHERE contains(regexp_replace(lower(url), '[^\p{L}\p{N}_\s]', '', 'g'), "
    r"regexp_replace(lower(token), '[^\p{L}\p{N}_\s]', '', 'g'))",
)
def _(spark, sf_dir):
    names = v.table(spark, sf_dir, "pages").selectExpr("url", "url AS file_name")
    tokens = {"fr": "FR!", "de": "D-E", "thth": "thth"}
    return listing.files_of_accounts(names, tokens).select("url", "account")


# --- reshapes ---------------------------------------------------------------


# Every third order has no price.
SOME_PRICE = "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END"


@register(
    "pivot_first",
    "SELECT o_custkey, arg_min(price, o_orderkey) FILTER (o_orderstatus = 'F') AS F, "
    "arg_min(price, o_orderkey) FILTER (o_orderstatus = 'O') AS O, "
    f"arg_min(price, o_orderkey) FILTER (o_orderstatus = 'P') AS P FROM (SELECT *, {SOME_PRICE} AS price FROM orders) "
    "GROUP BY o_custkey",
)
def _(spark, sf_dir):
    orders = v.table(spark, sf_dir, "orders").withColumn("price", F.expr(SOME_PRICE))
    return reshape.pivot_first(
        orders, ["o_custkey"], "o_orderstatus", "price", F.col("o_orderkey"), ["F", "O", "P"]
    )


@register(
    "first_per_group",
    f"SELECT o_custkey, o_orderstatus, arg_min(price, o_orderkey) AS first_price FROM (SELECT *, {SOME_PRICE} AS price "
    "FROM orders) GROUP BY ALL",
)
def _(spark, sf_dir):
    orders = v.table(spark, sf_dir, "orders").withColumn("price", F.expr(SOME_PRICE))
    return orders.groupBy("o_custkey", "o_orderstatus").agg(
        reshape.first_known("price", F.col("o_orderkey")).alias("first_price")
    )


# The event types there are; any other fails the query.
EVENT_TYPES = ["view", "click", "purchase", "signup", "error"]


@register(
    "pivot_measures",
    "SELECT user_id, "
    + ", ".join(f"CAST(sum(amount) FILTER (event_type = '{t}') AS DOUBLE) AS {t}" for t in EVENT_TYPES)
    + " FROM (SELECT *, CAST(value AS DECIMAL(18,2)) AS amount FROM events) GROUP BY user_id",
)
def _(spark, sf_dir):
    events = v.table(spark, sf_dir, "events").withColumn("amount", F.col("value").cast("decimal(18,2)"))
    return reshape.pivot_sum(events, ["user_id"], "event_type", "amount", EVENT_TYPES)


@register("key_groups", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, sf_dir):
    return reshape.key_groups(v.table(spark, sf_dir, "events"), ["user_id", "event_type"])


# Items by measure, one column per year: the sheet the period report starts from.
# The years with sales; a sale of any other fails the query.
PERIODS = ["1995", "1996", "1997", "1998", "1999", "2000", "2001"]
SHEET = {
    "Item Nbr": f"CASE WHEN l_tax = 0.08 THEN 'Inventory' WHEN l_tax = 0 THEN NULL ELSE {v.ITEM} END",
    "Item Desc 1": v.TITLE,
    "Vendor Stock Nbr": f"concat('V', {v.ITEM})",
    "Data Type": "CASE l_returnflag WHEN 'A' THEN 'Total Units Sold' WHEN 'R' THEN 'Total Sell Dollars' "
    "WHEN 'N' THEN 'Avg On-Hand Qty' END",
    **{
        p: f"CASE WHEN year(l_shipdate) = {p} THEN CAST(l_quantity AS DECIMAL(18,2)) END"
        for p in PERIODS
    },
}
SHEET_SQL = f"SELECT {v.columns_sql(SHEET)} FROM lineitem"
ITEM_ROWS = '"Item Nbr" IS NOT NULL AND "Item Nbr" <> \'Inventory\''


def period_sheet(spark, sf_dir):
    year = "CASE WHEN year(l_shipdate) IN ({}) THEN l_partkey ELSE raise_error(concat('no period: ', l_shipdate)) END"
    sales = v.table(spark, sf_dir, "lineitem").withColumn("l_partkey", F.expr(year.format(", ".join(PERIODS))))
    return sales.selectExpr(*[f"{e} AS `{n}`" for n, e in SHEET.items()])


@register(
    "unpivot_periods",
    "SELECT item, \"Data Type\" AS measure, period, count(*) AS n, CAST(sum(value) AS DOUBLE) AS value FROM ("
    + " UNION ALL ".join(
        f"SELECT \"Item Nbr\" AS item, \"Data Type\", '{p}' AS period, \"{p}\" AS value FROM ({SHEET_SQL}) WHERE {ITEM_ROWS}"
        for p in PERIODS
    )
    + ") GROUP BY ALL",
)
def _(spark, sf_dir):
    summed = summed_rows(period_sheet(spark, sf_dir), PERIODS, ("Item Nbr", "Data Type"))
    rows = period_rows(summed, PERIODS, ids=("Item Nbr", "n"))
    return rows.select(F.col("Item Nbr").alias("item"), F.col("Data Type").alias("measure"), "period", "n", "value")


@register(
    "period_report",
    "SELECT \"Item Nbr\", \"Item Desc 1\", \"Vendor Stock Nbr\", period, "
    + ", ".join(f"CAST(sum(value) FILTER (\"Data Type\" = '{m}') AS DOUBLE) AS \"{m}\"" for m in MEASURES)
    + " FROM ("
    + " UNION ALL ".join(
        f"SELECT \"Item Nbr\", \"Item Desc 1\", \"Vendor Stock Nbr\", \"Data Type\", '{p}' AS period, \"{p}\" AS value "
        f"FROM ({SHEET_SQL}) WHERE {ITEM_ROWS}"
        for p in PERIODS
    )
    + ") GROUP BY ALL",
)
def _(spark, sf_dir):
    return period_report(period_sheet(spark, sf_dir), PERIODS)


@register(
    "transpose_small",
    "SELECT key, CAST(max(v) FILTER (flag = 'A') AS DOUBLE) AS A, CAST(max(v) FILTER (flag = 'N') AS DOUBLE) AS N, "
    "CAST(max(v) FILTER (flag = 'R') AS DOUBLE) AS R FROM (SELECT l_returnflag AS flag, 'units' AS key, "
    "sum(CAST(l_quantity AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY ALL UNION ALL SELECT l_returnflag, 'price', "
    "sum(CAST(l_extendedprice AS DECIMAL(18,2))) FROM lineitem GROUP BY ALL) GROUP BY key",
)
def _(spark, sf_dir):
    small = v.table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("units"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
    )
    return reshape.transposed(small, "flag", ["A", "N", "R"], ["units", "price"])


# --- strings: whole document texts and names --------------------------------


def _document_query(name: str, sql: str, function) -> None:
    """The function over every whole text; long results leave as their digest."""

    @register(name, f"SELECT doc_id, {sql} FROM documents")
    def _(spark, sf_dir):
        return v.table(spark, sf_dir, "documents").select("doc_id", *function(F.col("text")))


_document_query(
    "strip_text", "md5(trim(text, ' \t\n\r')) AS digest", lambda c: [F.md5(text.strip(c)).alias("digest")]
)
_document_query(
    "split_index",
    "string_split(text, '. ')[2] AS second, string_split(text, '. ')[500] AS far",
    lambda c: [text.part(c, ". ", 1).alias("second"), text.part(c, ". ", 499).alias("far")],
)
_document_query(
    "split_tail_join",
    "md5(array_to_string(string_split(text, ' ')[2:], ' ')) AS digest",
    lambda c: [F.md5(text.after_first(c, " ")).alias("digest")],
)
_document_query(
    "normalise_text",
    r"md5(regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g')) AS digest",
    lambda c: [F.md5(F.regexp_replace(c, r"(?U)[^\p{L}\p{N}_\s]", "")).alias("digest")],
)
_document_query(
    "digits_in_text",
    r"array_to_string(regexp_extract_all(text, '[0-9]'), '') AS digits",
    lambda c: [text.joined_digits(c).alias("digits")],
)
_document_query("lower_case", "md5(lower(text)) AS digest", lambda c: [F.md5(F.lower(c)).alias("digest")])
_document_query(
    "remove_literal", "md5(replace(text, '-', '')) AS digest", lambda c: [F.md5(text.without(c, "-")).alias("digest")]
)


@register(
    "normalise_name",
    r"SELECT c_custkey, regexp_replace(lower(c_name), '[^\p{L}\p{N}_\s]', '', 'g') AS name FROM customer",
)
def _(spark, sf_dir):
    return customer(spark, sf_dir).select("c_custkey", text.normalise_name(F.col("c_name")).alias("name"))


@register(
    "concat_prefix",
    f"SELECT c_custkey, concat_null AS prefixed FROM (SELECT c_custkey, '00' || CASE WHEN c_acctbal < 0 THEN NULL ELSE {CUSTOMER} END AS concat_null FROM customer)",
)
def _(spark, sf_dir):
    known = customer(spark, sf_dir).selectExpr("c_custkey", f"CASE WHEN c_acctbal < 0 THEN NULL ELSE {CUSTOMER} END AS k")
    return known.select("c_custkey", text.with_prefix("00", F.col("k")).alias("prefixed"))


@register(
    "substring_offset",
    "SELECT c_custkey, c_name[10:] AS tail, ltrim(c_name[10:], '0') AS number, "
    "CAST(c_custkey AS STRING) AS shown, c_name || ' / ' || c_mktsegment AS label FROM customer",
)
def _(spark, sf_dir):
    tail = text.from_offset(F.col("c_name"), 9)
    return customer(spark, sf_dir).select(
        "c_custkey", tail.alias("tail"), text.lstrip_chars(tail, "0").alias("number"),
        F.col("c_custkey").cast("string").alias("shown"),
        F.format_string("%s / %s", "c_name", "c_mktsegment").alias("label"),
    )


@register(
    "pad_upc",
    "SELECT p_partkey, CASE WHEN substr(upc, 1, 2) IN ('19','44','52','65','72','93') THEN '0' || trim(upc) ELSE upc END AS upc "
    "FROM (SELECT p_partkey, CASE WHEN p_size = 50 THEN NULL ELSE concat(CAST(p_size AS STRING), lpad(CAST(p_partkey AS STRING), 10, '0'), ' ') END AS upc FROM part)",
)
def _(spark, sf_dir):
    raw = v.table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "CASE WHEN p_size = 50 THEN NULL ELSE concat(CAST(p_size AS STRING), lpad(CAST(p_partkey AS STRING), 10, '0'), ' ') END AS upc",
    )
    return raw.select("p_partkey", text.pad_upc(F.col("upc")).alias("upc"))


LINE = "concat(c_name, ' ,  ', c_mktsegment, ',', CAST(c_nationkey AS STRING))"


@register(
    "line_to_record",
    "SELECT c_custkey, c_name AS name, c_mktsegment AS segment, CAST(c_nationkey AS STRING) AS nation FROM customer",
)
def _(spark, sf_dir):
    lines = customer(spark, sf_dir).selectExpr("c_custkey", f"{LINE} AS line")
    record = text.line_record(F.col("line"), ["name", "segment", "nation", "none"])
    return lines.select("c_custkey", record.alias("r")).select(
        "c_custkey", *[F.try_element_at("r", F.lit(k)).alias(k) for k in ("name", "segment", "nation")]
    )


# --- numbers and choices ----------------------------------------------------


@register(
    "dash_to_zero",
    "SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN 0 WHEN o_orderstatus = 'O' THEN NULL "
    "ELSE CAST(o_totalprice AS DECIMAL(18,4)) END AS DOUBLE) AS amount FROM orders",
)
def _(spark, sf_dir):
    cells = v.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderstatus WHEN 'P' THEN '--' WHEN 'O' THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS cell",
    )
    return cells.select("o_orderkey", num.money(num.dash_to_zero(F.col("cell"))).alias("amount"))


EIGHTH = "CAST(l_partkey AS BIGINT) * 0.125"


@register(
    "round_and_truncate",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round_even({EIGHTH}, 2) AS DOUBLE) AS cents, "
    f"CAST(trunc(-1 * {EIGHTH}) AS INT) AS whole, CAST(l_quantity * ({EIGHTH}) AS DOUBLE) AS extended FROM lineitem",
)
def _(spark, sf_dir):
    price = F.expr(f"CAST({EIGHTH} AS DECIMAL(18,4))")
    return v.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        num.round_cents(price).alias("cents"),
        num.whole(-price).alias("whole"),
        num.extended_amount(F.col("l_quantity").cast("decimal(18,4)"), price).alias("extended"),
    )


@register(
    "keep_where",
    "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE 'DEBT' END AS segment, "
    "CASE WHEN c_acctbal > 0 THEN 0 ELSE 1 END AS invalid FROM customer",
)
def _(spark, sf_dir):
    solvent = F.col("c_acctbal") > 0
    return customer(spark, sf_dir).select(
        "c_custkey", cond.keep_where(F.col("c_mktsegment"), solvent, F.lit("DEBT")).alias("segment"),
        cond.zero_one(~solvent).alias("invalid"),
    )


# --- dates ------------------------------------------------------------------

DAY = "CAST(o_orderdate AS DATE)"


def _date_query(name: str, sql: str, columns) -> None:
    @register(name, f"SELECT o_orderkey, {sql} FROM (SELECT o_orderkey, {DAY} AS d FROM orders)")
    def _(spark, sf_dir):
        days = v.table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{DAY} AS d")
        return days.select("o_orderkey", *columns(F.col("d")))


_date_query(
    "week_ending_previous",
    "strftime(date_trunc('week', d - 7)::DATE + 5, '%Y-%m-%d') AS week_ending",
    lambda d: [cal.previous_week_saturday(d).alias("week_ending")],
)
_date_query(
    "week_ending_roll",
    "strftime(d + CAST((6 - dayofweek(d) + 7) % 7 AS INT), '%Y-%m-%d') AS week_ending",
    lambda d: [cal.roll_to_saturday(d).alias("week_ending")],
)
_date_query(
    "week_quarter",
    "CAST(year(date_trunc('week', d - 7)::DATE + 5) AS INT) AS y, "
    "CAST(quarter(date_trunc('week', d - 7)::DATE + 5) AS INT) AS q",
    lambda d: [
        cal.year_of(cal.previous_week_saturday(d)).alias("y"),
        cal.quarter_of(cal.previous_week_saturday(d)).alias("q"),
    ],
)
_date_query(
    "week_range",
    "strftime(date_trunc('week', d)::DATE - 7, '%Y-%m-%d') AS first_day, "
    "strftime(date_trunc('week', d)::DATE - 1, '%Y-%m-%d') AS last_day",
    lambda d: [cal.previous_week_start(d).alias("first_day"), cal.previous_week_end(d).alias("last_day")],
)
_date_query(
    "date_parts",
    "CAST(isodow(d) - 1 AS INT) AS weekday, CAST(month(d) AS INT) AS month, strftime(d - 7, '%m/%d/%Y') AS week_ago, "
    "strftime(d, '%Y-%m-%d') AS parsed",
    lambda d: [
        F.weekday(d).alias("weekday"), F.month(d).alias("month"),
        F.date_format(F.date_sub(d, 7), "MM/dd/yyyy").alias("week_ago"),
        cal.us_date(F.date_format(d, "MM-dd-yyyy")).alias("parsed"),
    ],
)


@register(
    "date_spine",
    f"SELECT strftime(unnest(generate_series(lo, hi, INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM "
    f"(SELECT min({DAY}) AS lo, max({DAY}) AS hi FROM orders)",
)
def _(spark, sf_dir):
    return date_spine(v.table(spark, sf_dir, "orders"), "o_orderdate")


def _uniform_sql(step: int) -> str:
    return f"((('0x' || substr(md5('7:{step}:' || day), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"


@register(
    "date_spine_values",
    f"SELECT day, round(sqrt(-2 * ln({_uniform_sql(1)})) * cos(2 * pi() * {_uniform_sql(2)}), 6) AS value FROM ("
    f"SELECT strftime(unnest(generate_series(lo, hi, INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM "
    f"(SELECT min({DAY}) AS lo, max({DAY}) AS hi FROM orders))",
)
def _(spark, sf_dir):
    """A seeded normal draw beside each day, the same wherever it is drawn."""
    days = date_spine(v.table(spark, sf_dir, "orders"), "o_orderdate")
    return with_random_value(days, 7, "day").withColumn("value", F.round("value", 6))
