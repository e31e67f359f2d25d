"""Raw retailer feeds and item masters as views of the star-schema tables.

Each line item is read as one sales row in the raw headers of an account, each
part as one item. The view expressions are SQL text, so that Spark and the SQL
twin of a query start from the same input; nothing else is shared.

The views bring in what real feeds hold: missing keys (``l_tax = 0``), zero
and unknown amounts, negative amounts, total rows, items not listed at the
account, items listed twice, and items without brand or UPC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ITEM = "CAST(l_partkey AS STRING)"
ITEM_OR_NULL = f"CASE WHEN l_tax = 0 THEN NULL ELSE {ITEM} END"
TITLE = f"concat('Item ', {ITEM})"
STOCK = f"concat('IT', {ITEM})"
STOCK_OR_NULL = f"CASE WHEN l_tax = 0 THEN NULL ELSE {STOCK} END"
STOCK_OR_VENDOR = f"CASE WHEN l_linenumber <= 3 THEN {STOCK} ELSE concat('V', {ITEM}) END"
AMOUNT = (
    "CAST(CASE WHEN l_discount = 0 THEN 0 WHEN l_quantity = 13 THEN NULL "
    "WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,2))"
)
# Prices in eighths: repeated amounts, and ties when rounded to cents.
EIGHTHS = (
    "CAST(CASE WHEN l_discount = 0 THEN 0 WHEN l_quantity = 13 THEN NULL "
    "WHEN l_returnflag = 'R' THEN l_suppkey * -0.125 ELSE l_suppkey * 0.125 END AS DECIMAL(18,3))"
)
KNOWN_EIGHTHS = (
    "CAST(CASE WHEN l_discount = 0 THEN 0 "
    "WHEN l_returnflag = 'R' THEN l_suppkey * -0.125 ELSE l_suppkey * 0.125 END AS DECIMAL(18,3))"
)
PADDED = f"lpad({ITEM}, 10, '0')"
WIDE = f"lpad({ITEM}, 12, '0')"
FULL_UPC = f"concat(CASE WHEN l_returnflag = 'A' THEN '19' ELSE '88' END, {PADDED})"

SOURCE = {
    "src_file": "CAST(l_suppkey AS STRING)",
    "src_sheet": "l_partkey",
    "src_row": "l_orderkey * 10 + l_linenumber",
}

FEEDS: dict[str, dict[str, str]] = {
    "amazon": {
        "ASIN": ITEM_OR_NULL,
        "Product Title": TITLE,
        "Ordered Revenue": AMOUNT,
        "Ordered Units": "l_quantity",
    },
    "bbb": {
        "Concept": "CASE l_linenumber WHEN 7 THEN 'Total' WHEN 6 THEN NULL ELSE 'Baby' END",
        "Sku": ITEM,
        "VPN": f"CASE WHEN l_tax = 0 THEN NULL ELSE concat('V', {ITEM}) END",
        "Unnamed: 7": TITLE,
        "Sku Chain Retail": "CAST(l_suppkey * 0.125 AS DECIMAL(18,3))",
        "Sales Units LW TY": "CASE WHEN l_discount = 0 THEN 0 ELSE l_quantity END",
        "UPC": FULL_UPC,
        "Format": "l_linestatus",
    },
    "depot": {
        "SKU": f"CASE WHEN l_tax = 0 THEN NULL WHEN l_linenumber = 1 THEN {ITEM} "
        f"ELSE concat({ITEM}, '-001 Car Seat ', l_returnflag) END",
        "Sales $": EIGHTHS,
        "Sales Units": "l_quantity",
    },
    "kmart": {
        "Item ID": "CASE WHEN l_tax = 0 THEN NULL WHEN l_linenumber = 2 THEN 'a.b' "
        f"ELSE concat('a.b. ', {ITEM}, ' .d. Toy ', l_returnflag) END",
        "MODEL #": f"concat(' V', {ITEM}, ' ')",
        "Total Sales $ TY": EIGHTHS,
        "Total Sales Units TY": "l_quantity",
    },
    "marketplace": {
        "Item_ID": ITEM_OR_NULL,
        "ITEM_DESC": TITLE,
        "ITEM_SRCCD": STOCK_OR_NULL,
        "CustomerName": "CASE l_linestatus WHEN 'F' THEN 'Shop F' ELSE 'Shop O' END",
        "SHEXTAMOUNT": EIGHTHS,
        "SHQTYSHIPPED": "l_quantity",
    },
    "meijer": {
        "Product ID": ITEM_OR_NULL,
        "Unnamed: 3": TITLE,
        "Manufacturer Item Code": f"concat('V', {ITEM})",
        "UPC": f"CASE WHEN l_linenumber = 7 THEN NULL ELSE {FULL_UPC} END",
        "Sales: $": EIGHTHS,
        "Sales: Qty": "l_quantity",
        "Sales: $ LY": "CAST(l_quantity AS DECIMAL(18,2))",
        "Sales: $ % Diff TYLY": "CAST(l_tax AS DECIMAL(18,2))",
    },
    "nordstrom": {
        "Bus Unit": "CASE l_linenumber WHEN 1 THEN 'N.COM' WHEN 2 THEN 'RACK' "
        "WHEN 3 THEN 'CANADA' WHEN 4 THEN NULL ELSE 'FULL LINE' END",
        "Group": "l_returnflag",
        "Store": "CAST(l_suppkey AS STRING)",
        "VPN": f"CASE WHEN l_tax = 0 THEN NULL ELSE concat({STOCK}, ', Item ', {ITEM}) END",
        "Sales $": EIGHTHS,
        "Sales U": "l_quantity",
    },
    "sams": {
        "Item Nbr": ITEM,
        "Item Desc 1": TITLE,
        "Vendor Stock Nbr": STOCK_OR_NULL,
        "Total Sell Dollars": EIGHTHS,
        "Total Units Sold": "l_quantity",
    },
    "sears": {
        "Unnamed: 8": ITEM,
        "Unnamed: 9": TITLE,
        "MODEL #": f"CASE WHEN l_tax = 0 THEN NULL ELSE {STOCK_OR_VENDOR} END",
        "Sears Total Sales $": EIGHTHS,
        "Sears Total Sales Units": "l_quantity",
    },
    "target": {
        "Item": f"CASE WHEN l_tax = 0 THEN NULL ELSE concat('030-', substr({WIDE}, 1, 2), "
        f"'-', substr({WIDE}, 3)) END",
        "Description": TITLE,
        "Model": STOCK_OR_VENDOR,
        "Channel": "CASE WHEN l_returnflag = 'A' THEN 'STORE' WHEN l_returnflag = 'R' "
        "THEN 'ONLINE' WHEN l_linestatus = 'F' THEN 'DC' ELSE NULL END",
        "Fulfillment Method": "CASE l_linestatus WHEN 'F' THEN 'SHIP' ELSE 'PICKUP' END",
        "Sales $": f"CASE WHEN l_discount = 0 THEN '--' ELSE CAST({EIGHTHS} AS STRING) END",
        "Sales U": "CASE WHEN l_quantity = 14 THEN '--' "
        "ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
    },
    "walmart": {
        "Prime Item Nbr": "l_partkey",
        "Item Desc 1": TITLE,
        "Vendor Stk Nbr": STOCK,
        "Dept Category Description": "CASE l_returnflag WHEN 'N' THEN 'DOTCOM' ELSE 'STORES' END",
        "POS Sales 202004": "l_extendedprice",
        "POS Qty 202004": "l_tax",
        "POS Sales 202005": EIGHTHS,
        "POS Qty 202005": "l_quantity",
    },
    "wmcom_rl": {
        "Walmart Item Number": ITEM,
        "Item Name": TITLE,
        "Vendor Stock ID": STOCK,
        "UPC": f"CASE WHEN l_tax = 0 THEN NULL ELSE concat('00', {PADDED}) END",
        "Total Net Retail Sales": EIGHTHS,
        "Total Net Unit Sales": "l_quantity",
    },
    "wmcom_ts": {
        "Item ID": ITEM,
        "Item": TITLE,
        "Vendor Stk": STOCK,
        "UPC": f"concat('00', {PADDED})",
        "Time": "CASE l_linenumber WHEN 7 THEN 'YTD' WHEN 6 THEN NULL ELSE 'WK' END",
        "TY Sales": KNOWN_EIGHTHS,
        "TY Qty": "l_quantity",
    },
}
# One sheet a file there, whose last row is a total with an item id.
FEEDS["legacy_kmart"] = {**FEEDS["kmart"], "src_sheet": "CAST(0 AS BIGINT)"}
FEEDS["legacy_meijer"] = FEEDS["meijer"]
FEEDS["legacy_bbb"] = FEEDS["bbb"]

PART = "CAST(p_partkey AS STRING)"
LISTED = "CASE WHEN p_size = 46 THEN NULL WHEN p_type = 'PROMO' THEN concat('X', {0}) ELSE {0} END"

_KEYS = {
    "amazon_id": LISTED.format(PART),
    "depot_id": LISTED.format(PART),
    "kmart_id": LISTED.format(f"concat('00', {PART})"),
    "meijer_id": LISTED.format(PART),
    "target_id": LISTED.format(f"concat('030', lpad({PART}, 12, '0'))"),
    "walmart_id": LISTED.format(PART),
    "sears_id": LISTED.format(PART),
}
_TIER = (
    "CASE WHEN p_size = 49 THEN NULL WHEN p_brand = 'Brand#1' THEN 'QUINNY' "
    "WHEN p_brand = 'Brand#2' THEN 'MAXI COSI' WHEN p_brand = 'Brand#3' THEN 'Quinny' "
    "ELSE p_brand END"
)
_UPC12 = f"CASE WHEN p_size = 48 THEN NULL ELSE concat('019', lpad({PART}, 10, '0')) END"
_SHORT_UPC = f"CASE WHEN p_size = 47 THEN NULL ELSE lpad({PART}, 10, '0') END"

MASTER = {
    "item_number": f"concat('IT', {PART})",
    "upc12": _UPC12,
    "short_upc": _SHORT_UPC,
    "brand": "CASE WHEN p_size = 50 THEN NULL ELSE p_brand END",
    "short_brand": _TIER,
    **_KEYS,
    "master_row": "p_partkey",
}
# Items listed a second time, further down, under changed numbers and brands.
RELISTED = {
    **MASTER,
    "item_number": f"concat('IT', {PART}, CASE WHEN p_size = 1 THEN '-R' ELSE '' END)",
    "brand": "p_brand",
    "short_brand": "'TINY LOVE'",
    "master_row": "p_partkey + 1000000000000",
}
RELISTED_WHERE = "p_size IN (1, 2, 50)"

# The older cross reference sheets: the account's number, the item, the UPC.
CROSSREF = {
    "legacy_kmart": f"concat('00', {PART})",
    "legacy_meijer": PART,
    "legacy_bbb": PART,
}


def crossref_columns(account: str) -> dict[str, str]:
    upc = f"concat('19', lpad({PART}, 10, '0'))" if account == "legacy_bbb" else _UPC12
    return {
        "item_number": f"concat('V', {PART})",
        "vendor_item": LISTED.format(CROSSREF[account]),
        "upc12": upc,
        "description": "CASE WHEN p_size = 45 THEN NULL ELSE p_name END",
        "short_brand": _TIER,
        "master_row": "p_partkey",
    }


def columns_sql(columns: dict[str, str]) -> str:
    return ", ".join(f'{expression} AS "{name}"' for name, expression in columns.items())


def feed_sql(account: str) -> str:
    """The raw feed as a SELECT on the SQL side."""
    return f"SELECT {columns_sql({**SOURCE, **FEEDS[account]})} FROM lineitem"


def master_sql(account: str = "") -> str:
    if account in CROSSREF:
        columns = crossref_columns(account)
        again = {**columns, "master_row": RELISTED["master_row"], "short_brand": "'TINY LOVE'"}
    else:
        columns, again = MASTER, RELISTED
    return (
        f"SELECT {columns_sql(columns)} FROM part "
        f"UNION ALL SELECT {columns_sql(again)} FROM part WHERE {RELISTED_WHERE}"
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS `{name}`" for name, expression in columns.items()])


def raw_feed(spark: SparkSession, sf_dir: str, account: str) -> DataFrame:
    """Sales rows under the account's raw headers."""
    return _select(table(spark, sf_dir, "lineitem"), {**SOURCE, **FEEDS[account]})


def master_rows(spark: SparkSession, sf_dir: str, account: str = "") -> DataFrame:
    """The item master (or the account's cross reference sheet)."""
    part = table(spark, sf_dir, "part")
    if account in CROSSREF:
        columns = crossref_columns(account)
        again = {**columns, "master_row": RELISTED["master_row"], "short_brand": "'TINY LOVE'"}
    else:
        columns, again = MASTER, RELISTED
    return _select(part, columns).unionByName(_select(part.where(RELISTED_WHERE), again))


# One feed of all accounts: the line number stands for the account.
ACCOUNT_KEYS = {
    "amazon": "amazon_id",
    "depot": "depot_id",
    "kmart": "kmart_id",
    "meijer": "meijer_id",
    "target": "target_id",
    "walmart": "walmart_id",
    "sears": "sears_id",
}
COMMON_FEED = {
    **SOURCE,
    "account": "CASE l_linenumber WHEN 1 THEN 'amazon' WHEN 2 THEN 'depot' WHEN 3 THEN 'kmart' "
    "WHEN 4 THEN 'meijer' WHEN 5 THEN 'target' WHEN 6 THEN 'walmart' ELSE 'sears' END",
    "cust_item": f"CASE WHEN l_tax = 0 THEN NULL WHEN l_linenumber = 3 THEN concat('00', {ITEM}) "
    f"WHEN l_linenumber = 5 THEN concat('030', {WIDE}) ELSE {ITEM} END",
    "item": ITEM_OR_NULL,
    "stock_no": STOCK_OR_VENDOR,
    "upc": FULL_UPC,
    "channel": FEEDS["target"]["Channel"],
    "POSAmount": f"CAST({AMOUNT} AS DECIMAL(18,4))",
    "POSQuantity": "CAST(l_quantity AS INT)",
    "sale_date": "CAST(l_shipdate AS DATE)",
}


def common_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "lineitem"), COMMON_FEED)


def common_sql() -> str:
    """The common feed and the master as the head of a SQL statement."""
    return (
        f"WITH feed AS (SELECT {columns_sql(COMMON_FEED)} FROM lineitem), "
        f"master AS ({master_sql()}) "
    )
