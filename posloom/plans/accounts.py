"""The accounts, one declaration each, and the registry by name.

Everything account-specific is here: raw headers (fixed values of each
retailer's file), row filters, derived columns, keys and constants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posloom.functions import conditions as cond
from posloom.functions import numbers as num
from posloom.functions import text
from posloom.plans.spec import STRICT, AccountSpec, Containing, Layout, Pass


def _nonzero(feed: DataFrame, mode: str) -> DataFrame:
    return feed.filter(cond.nonzero(F.col("POSAmount")))


def _whole_units_and_cents(feed: DataFrame) -> DataFrame:
    return feed.withColumns(
        {
            "POSQuantity": num.whole(F.col("POSQuantity")),
            "POSAmount": num.round_cents(F.col("POSAmount")),
        }
    )


def _bbb(feed: DataFrame, mode: str) -> DataFrame:
    amount = num.extended_amount(F.col("POSQuantity"), F.col("AvgRetail"))
    sold = (
        feed.filter(cond.not_sentinel(F.col("Concept"), "Total"))
        .withColumns({"POSAmount": amount, "UPC": text.pad_upc(F.col("UPC"))})
        .filter(cond.nonzero(F.col("POSAmount")))
    )
    return _whole_units_and_cents(sold).drop("Concept")


def _depot(feed: DataFrame, mode: str) -> DataFrame:
    sku = F.col("Sku")
    number = text.strip(text.part(text.strip(text.part(sku, " ", 0)), "-", 0))
    items = feed.filter(sku.isNotNull()).withColumns(
        {"CustItemNumber": number, "CustItemDesc": text.strip(text.after_first(sku, " "))}
    )
    return _whole_units_and_cents(_nonzero(items, mode)).drop("Sku")


def _kmart(feed: DataFrame, mode: str) -> DataFrame:
    item = F.col("ItemId")
    description = text.part(item, ".", 4)
    items = feed.filter(item.isNotNull()).withColumns(
        {
            "CustVendStkNo": text.strip(F.col("CustVendStkNo")),
            "CustItemNumber": text.with_prefix("00", text.strip(text.part(item, ".", 2))),
            "CustItemDesc": text.strip(description) if mode == STRICT else description,
        }
    )
    return _nonzero(items, mode).drop("ItemId")


def _meijer(feed: DataFrame, mode: str) -> DataFrame:
    sold = feed.filter(F.col("UPC").isNotNull() & cond.known_nonzero(F.col("POSAmount")))
    return _whole_units_and_cents(sold)


def _nordstrom(feed: DataFrame, mode: str) -> DataFrame:
    unit = F.col("BusUnit")
    vendor = F.col("Vpn")
    return (
        _nonzero(feed, mode)
        .filter(unit.isin("FULL LINE", "N.COM", "RACK"))
        .withColumns(
            {
                "BricksClicks": cond.clicks_when(unit, "N.COM"),
                "CustVendStkNo": text.strip(text.part(vendor, ",", 0)),
                "CustItemDesc": text.strip(text.part(vendor, ",", 1)),
            }
        )
        .drop("BusUnit", "Vpn")
    )


def _sears(feed: DataFrame, mode: str) -> DataFrame:
    return _nonzero(feed, mode).na.drop("any", subset=["POSAmount", "CustVendStkNo"])


def _target(feed: DataFrame, mode: str) -> DataFrame:
    return (
        feed.withColumns(
            {
                "POSAmount": num.money_or_dash(F.col("SalesAmount")),
                "POSQuantity": num.whole(num.money_or_dash(F.col("SalesUnits"))),
            }
        )
        .filter(cond.not_sentinel(F.col("Channel"), "DC"))
        .filter(cond.nonzero(F.col("POSAmount")))
        .withColumns(
            {
                "BricksClicks": cond.clicks_when(F.col("Channel"), "ONLINE"),
                "CustItemNumber": text.without(F.col("Item"), "-"),
            }
        )
        .drop("SalesAmount", "SalesUnits", "Item")
    )


def _walmart(feed: DataFrame, mode: str) -> DataFrame:
    stores = feed.filter(cond.not_sentinel(F.col("Department"), "DOTCOM"))
    return _nonzero(stores, mode).drop("Department")


def _wmcom(feed: DataFrame, mode: str) -> DataFrame:
    filled = feed.na.drop("all", subset=[c for c in feed.columns if not c.startswith("src_")])
    keyed = filled.withColumn("ShortUpc", text.from_offset(F.col("UPC"), 2))
    if "Time" in feed.columns:
        keyed = keyed.filter(cond.not_sentinel(F.col("Time"), "YTD")).drop("Time")
    return _nonzero(keyed, mode)


def _legacy_kmart(feed: DataFrame, mode: str) -> DataFrame:
    item = F.col("ItemId")
    return (
        feed.filter(cond.positive(F.col("POSAmount")) & item.isNotNull())
        .withColumns(
            {
                "CustVendStkNo": text.strip(F.col("CustVendStkNo")),
                "CustItemNumber": text.with_prefix("00", text.strip(text.part(item, ".", 2))),
            }
        )
        .drop("ItemId")
    )


def _legacy_meijer(feed: DataFrame, mode: str) -> DataFrame:
    return feed.filter(F.col("UPC").isNotNull() & cond.positive(F.col("POSAmount")))


def _legacy_bbb(feed: DataFrame, mode: str) -> DataFrame:
    amount = num.extended_amount(F.col("POSQuantity"), F.col("AvgRetail"))
    return (
        feed.withColumns(
            {
                "POSAmount": amount,
                "CustVendStkNo": text.strip(F.col("CustVendStkNo")),
                "UPC": text.lstrip_chars(F.col("UPC"), "0"),
            }
        )
        .filter(cond.positive(F.col("POSAmount")))
        .withColumn("CleanedUpc", text.pad_upc(F.col("UPC")))
    )


AMAZON = AccountSpec(
    name="amazon",
    account_major="AMAZON",
    account="AMAZON",
    channel="Clicks",
    tokens=("amazon",),
    layout=Layout(header_row=1),
    columns={
        "CustItemNumber": "ASIN",
        "CustItemDesc": "Product Title",
        "POSAmount": "Ordered Revenue",
        "POSQuantity": "Ordered Units",
    },
    prepare=_nonzero,
    passes=(Pass("CustItemNumber", "amazon_id", "item_number"),),
    dedup="rows",
    dedup_keys=("CustItemNumber", "CustItemDesc", "POSAmount", "POSQuantity"),
    constants={"CustVendStkNo": "", "UPC": ""},
)

BBB = AccountSpec(
    name="bbb",
    account_major="BUY BUY BABY",
    account="BUY BUY BABY",
    channel="Bricks",
    tokens=("bbbmainline", "bbbmaxi"),
    layout=Layout(sheet_name="Total", sheet_idx=None, header_row=5),
    columns={
        "Concept": "Concept",
        "CustItemNumber": "Sku",
        "CustItemDesc": "Unnamed: 7",
        "CustVendStkNo": "VPN",
        "AvgRetail": "Sku Chain Retail",
        "POSQuantity": "Sales Units LW TY",
        "UPC": "UPC",
    },
    money_columns=("AvgRetail", "POSQuantity"),
    prepare=_bbb,
    group_by=("CustItemNumber", "CustItemDesc", "UPC", "AvgRetail", "CustVendStkNo"),
    passes=(Pass("UPC", "upc12", "short_brand"),),
    dedup="amount",
    dedup_keys=("CustItemNumber", "UPC", "AvgRetail", "POSAmount", "POSQuantity", "CustVendStkNo"),
    dedup_order=("src_file", "CustItemNumber", "CustItemDesc", "UPC", "AvgRetail", "CustVendStkNo"),
    constants={"CustVendStkNo": ""},
)

DEPOT = AccountSpec(
    name="depot",
    account_major="HOME DEPOT",
    account="HOME DEPOT",
    channel="Bricks",
    tokens=("depot",),
    layout=Layout(header_row=2),
    columns={"Sku": "SKU", "POSAmount": "Sales $", "POSQuantity": "Sales Units"},
    prepare=_depot,
    passes=(Pass("CustItemNumber", "depot_id", "upc12"),),
    dedup="amount",
    dedup_keys=("CustItemNumber", "POSQuantity", "POSAmount"),
    constants={"CustVendStkNo": "", "UPC": ""},
)

KMART = AccountSpec(
    name="kmart",
    account_major="KMART",
    account="KMART",
    channel="Bricks",
    tokens=("kmart",),
    layout=Layout(
        sheet_name="LW SALES",
        sheet_idx=None,
        header_row=2,
        columns="E:I, K:L, N:Q, R:Y, AA:AD, AF:AI",
    ),
    columns={
        "ItemId": "Item ID",
        "CustVendStkNo": "MODEL #",
        "POSAmount": "Total Sales $ TY",
        "POSQuantity": "Total Sales Units TY",
    },
    prepare=_kmart,
    passes=(Pass("CustItemNumber", "kmart_id", "upc12"),),
    dedup="amount",
    dedup_keys=("CustItemNumber", "CustVendStkNo", "POSAmount", "POSQuantity"),
    constants={"UPC": ""},
)

MARKETPLACE = AccountSpec(
    name="marketplace",
    account_major="MARKETPLACE",
    account=None,
    channel="Clicks",
    tokens=("marketplace",),
    layout=Layout(header_row=0),
    columns={
        "CustItemNumber": "Item_ID",
        "CustItemDesc": "ITEM_DESC",
        "CustVendStkNo": "ITEM_SRCCD",
        "Account": "CustomerName",
        "POSAmount": "SHEXTAMOUNT",
        "POSQuantity": "SHQTYSHIPPED",
    },
    prepare=_nonzero,
    passes=(Pass("CustVendStkNo", "item_number", "short_brand"),),
    dedup="always",
    dedup_keys=(
        "CustItemNumber",
        "CustItemDesc",
        "CustVendStkNo",
        "Account",
        "POSAmount",
        "POSQuantity",
    ),
    constants={"UPC": "marketplace"},
)

MEIJER = AccountSpec(
    name="meijer",
    account_major="MEIJER",
    account="MEIJER",
    channel="Bricks",
    tokens=("meijer",),
    layout=Layout(sheet_idx=1, header_row=4),
    columns={
        "CustItemNumber": "Product ID",
        "CustItemDesc": "Unnamed: 3",
        "CustVendStkNo": "Manufacturer Item Code",
        "UPC": "UPC",
        "POSAmount": "Sales: $",
        "POSQuantity": "Sales: Qty",
    },
    prepare=_meijer,
    passes=(Pass("CustItemNumber", "meijer_id", "upc12"),),
    dedup="always",
    dedup_keys=(
        "CustItemDesc",
        "POSAmount",
        "POSQuantity",
        "CustItemNumber",
        "CustVendStkNo",
        "UPC",
    ),
)

NORDSTROM = AccountSpec(
    name="nordstrom",
    account_major="NORDSTROM",
    account="NORDSTROM",
    channel=None,
    tokens=("nordstrom",),
    layout=Layout(header_row=1),
    columns={
        "BusUnit": "Bus Unit",
        "Group": "Group",
        "Store": "Store",
        "Vpn": "VPN",
        "POSAmount": "Sales $",
        "POSQuantity": "Sales U",
    },
    prepare=_nordstrom,
    passes=(Pass("CustVendStkNo", "item_number", "short_brand"),),
    dedup="always",
    # The item is the master's, so all unmatched rows of a store share NULL.
    dedup_keys=("Group", "Store", "m1.item_number", "POSAmount"),
    constants={"CustItemNumber": "", "UPC": ""},
)

SAMS = AccountSpec(
    name="sams",
    account_major="SAMS",
    account="SAMS",
    channel="Bricks",
    tokens=("sams",),
    layout=Layout(header_row=None),
    columns={
        "CustItemNumber": "Item Nbr",
        "CustItemDesc": "Item Desc 1",
        "CustVendStkNo": "Vendor Stock Nbr",
        "POSAmount": "Total Sell Dollars",
        "POSQuantity": "Total Units Sold",
    },
    prepare=_nonzero,
    passes=(Pass("CustVendStkNo", "item_number", "brand"),),
    prefer_flagged=True,
    constants={"UPC": ""},
)

SEARS = AccountSpec(
    name="sears",
    account_major="SEARS",
    account="Sears",
    channel="Clicks",
    tokens=("sears",),
    layout=Layout(header_row=1),
    columns={
        "CustItemNumber": "Unnamed: 8",
        "CustItemDesc": "Unnamed: 9",
        "CustVendStkNo": "MODEL #",
        "POSAmount": "Sears Total Sales $",
        "POSQuantity": "Sears Total Sales Units",
    },
    prepare=_sears,
    passes=(
        Pass("CustVendStkNo", "item_number", "brand"),
        Pass("CustItemNumber", "sears_id", "brand"),
    ),
    prefer_flagged=True,
    appends_unmatched=True,
    constants={"UPC": ""},
)

TARGET = AccountSpec(
    name="target",
    account_major="TARGET",
    account=None,
    channel=None,
    tokens=("target",),
    layout=Layout(header_row=0),
    columns={
        "Item": "Item",
        "CustItemDesc": "Description",
        "CustVendStkNo": "Model",
        "Channel": "Channel",
        "Account": "Fulfillment Method",
        "SalesAmount": "Sales $",
        "SalesUnits": "Sales U",
    },
    money_columns=(),
    dashed_numbers={"SalesAmount": "bad_amount", "SalesUnits": "bad_quantity"},
    prepare=_target,
    passes=(
        Pass("CustItemNumber", "target_id", "short_brand"),
        Pass("CustVendStkNo", "item_number", "brand"),
    ),
    dedup="rows",
    dedup_keys=(
        "CustItemNumber",
        "CustItemDesc",
        "CustVendStkNo",
        "Account",
        "Channel",
        "POSQuantity",
        "POSAmount",
    ),
    second_pass_blanks=("CustItemNumber",),
    constants={"UPC": ""},
)

WALMART = AccountSpec(
    name="walmart",
    account_major="WALMART",
    account="WALMART",
    channel="Bricks",
    tokens=("walmart",),
    layout=Layout(header_row=None),
    columns={
        "CustItemNumber": "Prime Item Nbr",
        "CustItemDesc": "Item Desc 1",
        "CustVendStkNo": "Vendor Stk Nbr",
        "Department": "Dept Category Description",
        "POSAmount": Containing("POS Sales"),
        "POSQuantity": Containing("POS Qty", unless="POS Sales"),
    },
    prepare=_walmart,
    passes=(Pass("CustItemNumber", "walmart_id", "brand"),),
    prefer_flagged=True,
    dedup="final",
    dedup_keys=("CustItemDesc", "POSAmount", "POSQuantity", "CustItemNumber", "CustVendStkNo"),
    stamps_week=False,
    constants={"UPC": ""},
)

_WMCOM = dict(
    account_major="WALMART.COM",
    account="WALMART.COM",
    channel="Clicks",
    tokens=("wmcom",),
    prepare=_wmcom,
    passes=(Pass("ShortUpc", "short_upc", "brand"),),
    dedup="amount",
    dedup_keys=("CustItemNumber", "ShortUpc", "CustItemDesc", "POSAmount", "POSQuantity"),
    stamps_week=False,
)

WMCOM_RL = AccountSpec(
    name="wmcom_rl",
    layout=Layout(header_row=13, signature="Walmart Item Number"),
    columns={
        "CustItemNumber": "Walmart Item Number",
        "CustItemDesc": "Item Name",
        "CustVendStkNo": "Vendor Stock ID",
        "UPC": "UPC",
        "POSAmount": "Total Net Retail Sales",
        "POSQuantity": "Total Net Unit Sales",
    },
    counted="ItemNumber",
    **_WMCOM,
)

WMCOM_TS = AccountSpec(
    name="wmcom_ts",
    layout=Layout(header_row=0, signature="Item ID"),
    columns={
        "CustItemNumber": "Item ID",
        "CustItemDesc": "Item",
        "CustVendStkNo": "Vendor Stk",
        "UPC": "UPC",
        "Time": "Time",
        "POSAmount": "TY Sales",
        "POSQuantity": "TY Qty",
    },
    **_WMCOM,
)

# Earlier job: same stages against one cross reference sheet per account.
LEGACY_KMART = AccountSpec(
    name="legacy_kmart",
    account_major="KMART",
    account="KMART",
    channel="Bricks",
    tokens=KMART.tokens,
    layout=Layout(
        sheet_name="LW SALES",
        sheet_idx=None,
        header_row=2,
        columns="E:I, K:L, N:Q, R:Y, AA:AD, AF:AI",
    ),
    columns=KMART.columns,
    drops_last_row=True,
    prepare=_legacy_kmart,
    passes=(
        Pass("CustItemNumber", "vendor_item", "upc12"),
        Pass("CustVendStkNo", "item_number", "upc12"),
    ),
    prefer_flagged=True,
    constants={"UPC": ""},
)

LEGACY_MEIJER = AccountSpec(
    name="legacy_meijer",
    account_major="MEIJER",
    account="MEIJER",
    channel="Bricks",
    tokens=MEIJER.tokens,
    layout=Layout(sheet_name="LAST WEEK SALES", sheet_idx=None, header_row=4),
    columns={
        **MEIJER.columns,
        "SalesLastYear": "Sales: $ LY",
        "SalesChange": "Sales: $ % Diff TYLY",
    },
    money_columns=("POSAmount", "SalesLastYear", "SalesChange"),
    prepare=_legacy_meijer,
    passes=(
        Pass("CustItemNumber", "vendor_item", "upc12"),
        Pass("CustVendStkNo", "item_number", "upc12"),
    ),
    dedup="always",
    dedup_keys=(
        "CustItemNumber",
        "CustItemDesc",
        "CustVendStkNo",
        "POSAmount",
        "SalesLastYear",
        "SalesChange",
    ),
    second_pass_blanks=("CustItemNumber",),
)

LEGACY_BBB = AccountSpec(
    name="legacy_bbb",
    account_major="BUY BUY BABY",
    account="BUY BUY BABY",
    channel="Bricks",
    tokens=BBB.tokens,
    layout=Layout(sheet_name="Total", sheet_idx=None, header_row=5),
    columns={**BBB.columns, "Format": "Format"},
    money_columns=("AvgRetail", "POSQuantity"),
    prepare=_legacy_bbb,
    passes=(Pass("UPC", "upc12", "description"),),
    dedup="always",
    dedup_keys=("Concept", "Format", "CustItemNumber", "UPC", "AvgRetail", "POSAmount"),
)

ACCOUNTS = {
    spec.name: spec
    for spec in (
        AMAZON,
        BBB,
        DEPOT,
        KMART,
        MARKETPLACE,
        MEIJER,
        NORDSTROM,
        SAMS,
        SEARS,
        TARGET,
        WALMART,
        WMCOM_RL,
        WMCOM_TS,
    )
}
LEGACY_ACCOUNTS = {s.name: s for s in (LEGACY_KMART, LEGACY_MEIJER, LEGACY_BBB)}
