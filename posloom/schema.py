"""Names and types shared by every stage.

Feeds, item master and results are DataFrames; this module only fixes their
column names, so that a stage can be read without the one before it.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)

# The published layout of one cleaned sales row, in file order.
CANONICAL = (
    "AccountMajor",
    "Account",
    "BricksClicks",
    "CustItemNumber",
    "CustItemDesc",
    "CustVendStkNo",
    "ItemID",
    "ItemNumber",
    "MainlinePremium",
    "POSAmount",
    "POSQuantity",
    "UPC",
    "WeekEnding",
)

# Short brands sold in the premium tier (case-sensitive).
PREMIUM_BRANDS = (
    "MAXI COSI",
    "QUINNY",
    "Bebe Confort",
    "Baby Art",
    "Hoppop",
    "TINY LOVE",
)

# Item master column -> header of that column in the master sheet.
MASTER_HEADERS = {
    "item_number": "ITEM NBR",
    "upc12": "12 Digit UPC",
    "short_upc": "Short UPC",
    "brand": "Brand",
    "short_brand": "Short Brand",
    "amazon_id": "Amazon ID",
    "depot_id": "Home Depot",
    "kmart_id": "K-mart",
    "meijer_id": "Meijer",
    "target_id": "Target",
    "walmart_id": "Walmart",
    "sears_id": "Sears",
}

# Columns of the older per-account cross reference sheets.
CROSSREF_HEADERS = {
    "vendor": "vendor",
    "item_number": "Item",
    "vendor_item": "vendor_item",
    "upc12": "12 Digit UPC",
    "description": "Description",
    "brand": "Brand",
    "category": "Category",
    "short_brand": "Short Brand",
    "ultra": "Ultra",
    "corp_brand": "Corp Brand",
    "fashion": "Fashion",
}

# Where a feed row came from. Row order has to be carried, Spark keeps none.
SOURCE_ORDER = ("src_file", "src_sheet", "src_row")

# Every matched or failed feed row, one table for all accounts.
OUTCOME = ("outcome", "reason", "match_pass")
FINAL = "final"
EXCEPTION = "exception"

GRID_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("file_mtime", T.TimestampType()),
        T.StructField("sheet_name", T.StringType()),
        T.StructField("sheet_idx", T.IntegerType()),
        T.StructField("row_idx", T.LongType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
    ]
)
