"""Raw workbooks of every account with the edge rows, and the item master."""

from __future__ import annotations

MASTER_SHEET = "Item Master"
MASTER_HEADER = [
    "", "ITEM NBR", "12 Digit UPC", "Short UPC", "Brand", "Short Brand",
    "Amazon ID", "Home Depot", "K-mart", "Meijer", "Target", "Walmart", "Sears",
]


def item(nbr, upc, brand, short_brand, key):
    """One master row; every account knows the item by ``key``."""
    padded = None if key is None else f"00{key}"
    return ["x", nbr, upc, None if key is None else f"S{key}", brand, short_brand, key, key, padded, key, key, key, key]


MASTER = {
    "Cover": [["not this one"]],
    MASTER_SHEET: [
        *[["title"]] * 6,
        MASTER_HEADER,
        item("IT1", "0190000000001", "Q", "QUINNY", "1"),
        item("IT2", "884392000002", "C", "COSCO", "2"),
        item("IT2B", "884392000002", "M", "MAXI COSI", "2"),
        item("IT3", None, None, None, "3"),
        item("IT9", "884392000009", "C", "COSCO", "9"),
        item(None, None, None, None, None),
    ],
}

AMAZON = {
    "Sales": [
        ["Weekly"],
        ["ASIN", "Product Title", "Ordered Revenue", "Ordered Units", "Other"],
        ["1", "Car Seat", 10.5, 2, "x"],
        ["2", "Stroller", 20, 1],
        ["2", "Stroller", 20, 1],
        ["2", "Return", -5, -1],
        ["1", "Free", 0, 4],
        ["1", "Unknown", None, None],
        ["77", "No such item", 7, 1],
        [None, "No number", 3, 1],
        ["3", "No brand", 2, 1],
    ]
}

BBB_HEADER = ["Concept", "Sku", "VPN", "Sku Chain Retail", "Sales Units LW TY", "UPC", None, None]
BBB = {
    "Other": [["nothing"]],
    "Total": [
        *[["title"]] * 5,
        BBB_HEADER,
        ["BABY", "s1", "v1", 0.125, 1, "190000000001", None, "Seat"],
        ["BABY", "s1", "v1", 0.125, 3, "190000000001", None, "Seat"],
        [None, "s2", None, 2, 5, "884392000002", None, "Stroller"],
        ["Total", None, None, 9, 9, "884392000002", None, "Sum"],
        ["BABY", "s3", "v3", 4, 0, "884392000002", None, "None sold"],
        ["BABY", "s4", "v4", 4, 1, None, None, "No UPC"],
    ],
}

DEPOT = {
    "S": [
        ["a"], ["b"],
        ["SKU", "Sales $", "Sales Units"],
        ["1-001 Car Seat Blue", 0.125, 2.9],
        ["777", 4, 1],
        ["3-2 No UPC", 1, 1],
        [None, 99, 9],
        ["1-001 Zero", 0, 1],
    ]
}

def kmart_row(item_id, model, amount, units):
    row = [None] * 36
    row[4], row[10], row[13], row[17] = item_id, model, amount, units
    row[9], row[35] = "outside", "outside"
    return row


KMART = {
    "LW SALES": [
        ["a"], ["b"],
        kmart_row("Item ID", "MODEL #", "Total Sales $ TY", "Total Sales Units TY"),
        kmart_row("a.b.1.d. Seat ", " IT1 ", 5, 1),
        kmart_row("1.2", "IT2", 6, 1),
        kmart_row(None, None, 11, 2),
    ]
}

MARKETPLACE = {
    "S": [
        ["Item_ID", "ITEM_DESC", "ITEM_SRCCD", "CustomerName", "SHEXTAMOUNT", "SHQTYSHIPPED"],
        ["m1", "Seat", "IT1", "Shop A", 8, 1],
        ["m2", "Strange", "IT0", "Shop B", 9, 1],
    ]
}

MEIJER = {
    "SUMMARY": [["x"]],
    "WEEK": [
        *[["title"]] * 4,
        ["Product ID", "UPC", "Manufacturer Item Code", None, "Sales: $", "Sales: Qty"],
        ["2", "0002", "V2", "Stroller", 3.335, 1.7],
        ["2", "0002", "V2", "Stroller", None, 1],
        ["2", None, "V2", "Subtotal", 50, 1],
    ],
}

NORDSTROM = {
    "S": [
        ["title"],
        ["Bus Unit", "Group", "Store", "VPN", "Sales $", "Sales U"],
        ["N.COM", "g", "1", "IT1, Seat", 4, 1],
        ["RACK", "g", "2", "IT2 , Stroller", 5, 1],
        ["CANADA", "g", "2", "IT2,Stroller", 6, 1],
        ["FULL LINE", "g", "3", "IT7,None", 6, 1],
        ["FULL LINE", "g", "3", "IT8", 6, 1],
    ]
}

SAMS = {
    "S": [
        ["Report"],
        ["Club", None, "x"],
        ["Item Nbr", "Item Desc 1", "Vendor Stock Nbr", "Total Sell Dollars", "Total Units Sold"],
        [11, "Seat", "IT1", 10, 1],
        [12, "Blank", None, 10, 1],
        [13, "Zero", "IT1", 0, 1],
    ]
}

SEARS = {
    "S": [
        ["title"],
        ["MODEL #", "Sears Total Sales $", "Sears Total Sales Units", "c", "d", "e", "f", "g", None, None],
        ["IT1", 3, 1, "", "", "", "", "", "501", "Seat"],
        ["VX", 4, 2, "", "", "", "", "", "2", "Stroller"],
        ["VY", 5, 2, "", "", "", "", "", "502", "None"],
        [None, 6, 2, "", "", "", "", "", "2", "No model"],
    ]
}

TARGET = {
    "S": [
        ["Item", "Description", "Model", "Channel", "Fulfillment Method", "Sales $", "Sales U"],
        ["1-", "Seat", "IT9", "STORE", "Bought in store", "4.50", "2"],
        ["0-30", "Stroller", "IT2", "ONLINE", "Shipped", "6", "--"],
        ["1", "Depot", "IT9", "DC", "x", "9", "1"],
        ["1", "None", "IT9", "STORE", "x", "--", "1"],
        ["0-31", "Nothing", "IT0", None, "x", "7", "1"],
    ]
}

WALMART = {
    "S": [
        ["Report", None],
        ["Prime Item Nbr", "Item Desc 1", "Vendor Stk Nbr", "Dept Category Description",
         "POS Sales 202005", "POS Qty 202005"],
        [1, "Seat", "IT1", "TOYS", 5, 1],
        [1, "Seat", "IT1", "DOTCOM", 5, 1],
        [2, "Stroller", "IT2", "TOYS", 6, 3],
    ]
}

WMCOM_RL = {
    "S": [
        *[["title"]] * 13,
        ["Walmart Item Number", "Item Name", "Vendor Stock ID", "UPC", "Total Net Retail Sales", "Total Net Unit Sales"],
        ["w1", "Seat", "IT1", "00S1", 4, 1],
        [],
    ]
}

WMCOM_TS = {
    "S": [
        ["Item ID", "Item", "Vendor Stk", "UPC", "Time", "TY Sales", "TY Qty"],
        ["w1", "Seat", "IT1", "00S1", "Week", 4, 1],
        ["w1", "Seat", "IT1", "00S1", "YTD", 400, 100],
        ["w2", "None", "IT0", "00S0", None, 3, 1],
    ]
}

FILES = {
    "Amazon W-E 02-22-2020.xlsx": AMAZON,
    "BBB-Mainline W-E 02-22-2020.xlsx": BBB,
    "Home Depot W-E 02-22-2020.xlsx": DEPOT,
    "KMART W-E 02-22-20.xlsx": KMART,
    "marketplace-02-22-2020.xlsx": MARKETPLACE,
    "MEIJER 02-22-20.xlsx": MEIJER,
    "Nordstrom 02-22-20.xlsx": NORDSTROM,
    "sams-02-22-2020.xlsx": SAMS,
    "SEARS POS 02-22-20.xlsx": SEARS,
    "Target W-E 02-22-2020.xlsx": TARGET,
    "Walmart brick W-E 02-22-2020.xlsx": WALMART,
    "wmcom W-E 02-22-2020.xlsx": WMCOM_TS,
}
