"""The account runs once more, in plain SQL for the comparison engine.

Written as the merges themselves: join everything, number the copies, keep the
first. The Spark side avoids those joins, so equal results mean something.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from posloom.catalog import views as v
from posloom.schema import PREMIUM_BRANDS

WEEK = "'2020-02-22'"
SRC = "src_file, src_sheet, src_row"


def trim_sql(c: str) -> str:
    return f"trim({c}, ' ')"


def half_even(c: str) -> str:
    return f"CAST(round_even({c}, 2) AS DECIMAL(18,4))"


def whole(c: str) -> str:
    return f"CAST(trunc({c}) AS INT)"


@dataclass(frozen=True)
class Twin:
    """One account: its feed, its passes, and its final columns where they
    differ from the feed's."""

    major: str
    feed: str
    passes: tuple[tuple[str, str, str], ...]
    account: str | None = None
    channel: str | None = None
    final: dict[str, str] = field(default_factory=dict)
    has: tuple[str, ...] = ("CustItemNumber", "CustItemDesc", "CustVendStkNo")
    dedup: str = "none"
    keys: str = ""
    order: str = SRC
    prefer_flagged: bool = False
    stamps_week: bool = True
    appends_unmatched: bool = False
    second_blanks: tuple[str, ...] = ()
    feed_reference: str | None = None
    # Why a feed row is set aside in strict mode (a column of ``feed``).
    aside: bool = False
    drops_last_row: bool = False


def _feed(columns: str, where: str) -> str:
    return f"SELECT {SRC}, {columns} FROM raw WHERE {where}"


NONZERO = "(POSAmount IS NULL OR POSAmount <> 0)"

_BBB_SOLD = (
    f"SELECT {SRC}, Sku AS CustItemNumber, \"Unnamed: 7\" AS CustItemDesc, VPN AS CustVendStkNo, "
    '"Concept", "Format", CAST("Sku Chain Retail" AS DECIMAL(18,4)) AS AvgRetail, '
    "CASE WHEN UPC[1:2] IN ('19','44','52','65','72','93') THEN '0' || UPC ELSE UPC END AS UPC, "
    'CAST("Sales Units LW TY" * "Sku Chain Retail" AS DECIMAL(18,4)) AS amount, '
    '"Sales Units LW TY" AS units FROM raw'
)


def _bbb_feed(where: str) -> str:
    return (
        f"SELECT src_file, min(src_sheet) AS src_sheet, min(src_row) AS src_row, "
        "CustItemNumber, CustItemDesc, UPC, AvgRetail, CustVendStkNo, "
        f"CAST(sum({half_even('amount')}) AS DECIMAL(18,4)) AS POSAmount, "
        f"CAST(sum({whole('units')}) AS INT) AS POSQuantity FROM ({_BBB_SOLD}) "
        f"WHERE (\"Concept\" IS NULL OR \"Concept\" <> 'Total') AND (amount IS NULL OR amount <> 0) {where} "
        "GROUP BY src_file, CustItemNumber, CustItemDesc, UPC, AvgRetail, CustVendStkNo"
    )


def _kmart_feed(description: str) -> str:
    return (
        f"SELECT {SRC}, '00' || {trim_sql('string_split(item, $$.$$)[3]')} AS CustItemNumber, "
        f"{description} AS CustItemDesc, CustVendStkNo, POSAmount, POSQuantity FROM ("
        f'SELECT {SRC}, "Item ID" AS item, {trim_sql(chr(34) + "MODEL #" + chr(34))} AS CustVendStkNo, '
        'CAST("Total Sales $ TY" AS DECIMAL(18,4)) AS POSAmount, '
        f'{whole(chr(34) + "Total Sales Units TY" + chr(34))} AS POSQuantity FROM raw) '
        "WHERE item IS NOT NULL AND "
    )


_WMCOM = dict(
    major="WALMART.COM",
    account="'WALMART.COM'",
    channel="'Clicks'",
    has=("CustItemNumber", "CustItemDesc", "CustVendStkNo", "UPC"),
    passes=(("ShortUpc", "short_upc", "brand"),),
    dedup="amount",
    keys="CustItemNumber, ShortUpc, CustItemDesc, POSAmount, POSQuantity",
    stamps_week=False,
)

_SAMS = (
    f'SELECT {SRC}, "Item Nbr" AS CustItemNumber, "Item Desc 1" AS CustItemDesc, '
    '"Vendor Stock Nbr" AS CustVendStkNo, CAST("Total Sell Dollars" AS DECIMAL(18,4)) AS POSAmount, '
    'CAST(trunc("Total Units Sold") AS INT) AS POSQuantity, '
    'CASE WHEN "Vendor Stock Nbr" IS NULL OR "Total Sell Dollars" IS NULL THEN \'incomplete_row\' END AS aside FROM raw'
)
_WALMART = (
    f'SELECT {SRC}, CAST("Prime Item Nbr" AS VARCHAR) AS CustItemNumber, "Item Desc 1" AS CustItemDesc, '
    '"Vendor Stk Nbr" AS CustVendStkNo, CAST("POS Sales 202005" AS DECIMAL(18,4)) AS POSAmount, '
    'CAST(trunc("POS Qty 202005") AS INT) AS POSQuantity, '
    'CASE WHEN "POS Sales 202005" IS NULL THEN \'incomplete_row\' END AS aside FROM raw'
)

TWINS: dict[str, Twin] = {
    "amazon": Twin(
        major="AMAZON",
        account="'AMAZON'",
        channel="'Clicks'",
        has=("CustItemNumber", "CustItemDesc"),
        feed=_feed(
            'ASIN AS CustItemNumber, "Product Title" AS CustItemDesc, '
            'CAST("Ordered Revenue" AS DECIMAL(18,4)) AS POSAmount, '
            'CAST(trunc("Ordered Units") AS INT) AS POSQuantity',
            NONZERO,
        ),
        passes=(("CustItemNumber", "amazon_id", "item_number"),),
        final={"CustVendStkNo": "''", "UPC": "''"},
        dedup="rows",
        keys="CustItemNumber, CustItemDesc, POSAmount, POSQuantity",
    ),
    "bbb": Twin(
        major="BUY BUY BABY",
        account="'BUY BUY BABY'",
        channel="'Bricks'",
        has=("CustItemNumber", "CustItemDesc", "CustVendStkNo", "UPC"),
        feed=_bbb_feed(""),
        feed_reference=_bbb_feed("AND CustVendStkNo IS NOT NULL"),
        passes=(("UPC", "upc12", "short_brand"),),
        final={"CustVendStkNo": "''"},
        dedup="amount",
        keys="CustItemNumber, UPC, AvgRetail, POSAmount, POSQuantity, CustVendStkNo",
        order="src_file, CustItemNumber, CustItemDesc, UPC, AvgRetail, CustVendStkNo",
    ),
    "depot": Twin(
        major="HOME DEPOT",
        account="'HOME DEPOT'",
        channel="'Bricks'",
        has=("CustItemNumber", "CustItemDesc"),
        feed=(
            f"SELECT {SRC}, {trim_sql('string_split(string_split(SKU, $$ $$)[1], $$-$$)[1]')} AS CustItemNumber, "
            f"{trim_sql('array_to_string(string_split(SKU, $$ $$)[2:], $$ $$)')} AS CustItemDesc, "
            f'{half_even(chr(34) + "Sales $" + chr(34))} AS POSAmount, '
            f'{whole(chr(34) + "Sales Units" + chr(34))} AS POSQuantity FROM raw '
            'WHERE SKU IS NOT NULL AND ("Sales $" IS NULL OR "Sales $" <> 0)'
        ),
        passes=(("CustItemNumber", "depot_id", "upc12"),),
        final={"CustVendStkNo": "''", "UPC": "''"},
        dedup="amount",
        keys="CustItemNumber, POSQuantity, POSAmount",
    ),
    "kmart": Twin(
        major="KMART",
        account="'KMART'",
        channel="'Bricks'",
        feed=_kmart_feed(trim_sql("string_split(item, $$.$$)[5]")) + NONZERO,
        feed_reference=_kmart_feed("string_split(item, $$.$$)[5]") + NONZERO,
        passes=(("CustItemNumber", "kmart_id", "upc12"),),
        final={"UPC": "''"},
        dedup="amount",
        keys="CustItemNumber, CustVendStkNo, POSAmount, POSQuantity",
    ),
    "marketplace": Twin(
        major="MARKETPLACE",
        channel="'Clicks'",
        feed=_feed(
            "Item_ID AS CustItemNumber, ITEM_DESC AS CustItemDesc, ITEM_SRCCD AS CustVendStkNo, "
            "CustomerName AS Account, CAST(SHEXTAMOUNT AS DECIMAL(18,4)) AS POSAmount, "
            "CAST(trunc(SHQTYSHIPPED) AS INT) AS POSQuantity",
            NONZERO,
        ),
        passes=(("CustVendStkNo", "item_number", "short_brand"),),
        final={"UPC": "'marketplace'"},
        dedup="always",
        keys="CustItemNumber, CustItemDesc, CustVendStkNo, Account, POSAmount, POSQuantity",
    ),
    "meijer": Twin(
        major="MEIJER",
        account="'MEIJER'",
        channel="'Bricks'",
        has=("CustItemNumber", "CustItemDesc", "CustVendStkNo", "UPC"),
        feed=(
            f'SELECT {SRC}, "Product ID" AS CustItemNumber, "Unnamed: 3" AS CustItemDesc, '
            '"Manufacturer Item Code" AS CustVendStkNo, UPC, '
            f'{half_even(chr(34) + "Sales: $" + chr(34))} AS POSAmount, '
            f'{whole(chr(34) + "Sales: Qty" + chr(34))} AS POSQuantity FROM raw '
            'WHERE UPC IS NOT NULL AND "Sales: $" <> 0'
        ),
        passes=(("CustItemNumber", "meijer_id", "upc12"),),
        dedup="always",
        keys="CustItemDesc, POSAmount, POSQuantity, CustItemNumber, CustVendStkNo, UPC",
    ),
    "nordstrom": Twin(
        major="NORDSTROM",
        account="'NORDSTROM'",
        has=("CustItemDesc", "CustVendStkNo"),
        feed=(
            f"SELECT {SRC}, \"Group\", \"Store\", {trim_sql('string_split(VPN, $$,$$)[1]')} AS CustVendStkNo, "
            f"{trim_sql('string_split(VPN, $$,$$)[2]')} AS CustItemDesc, "
            "CASE WHEN \"Bus Unit\" = 'N.COM' THEN 'Clicks' ELSE 'Bricks' END AS BricksClicks, "
            'CAST("Sales $" AS DECIMAL(18,4)) AS POSAmount, CAST(trunc("Sales U") AS INT) AS POSQuantity '
            "FROM raw WHERE \"Bus Unit\" IN ('FULL LINE', 'N.COM', 'RACK') "
            'AND ("Sales $" IS NULL OR "Sales $" <> 0)'
        ),
        passes=(("CustVendStkNo", "item_number", "short_brand"),),
        final={"CustItemNumber": "''", "UPC": "''"},
        dedup="always",
        keys='"Group", "Store", item_number, POSAmount',
    ),
    "sams": Twin(
        major="SAMS",
        account="'SAMS'",
        channel="'Bricks'",
        feed=_SAMS + ' WHERE "Vendor Stock Nbr" IS NULL OR "Total Sell Dollars" IS NULL OR "Total Sell Dollars" <> 0',
        feed_reference=_SAMS + ' WHERE "Vendor Stock Nbr" IS NOT NULL AND "Total Sell Dollars" <> 0',
        aside=True,
        passes=(("CustVendStkNo", "item_number", "brand"),),
        final={"UPC": "''"},
        prefer_flagged=True,
    ),
    "sears": Twin(
        major="SEARS",
        account="'Sears'",
        channel="'Clicks'",
        feed=(
            f'SELECT {SRC}, "Unnamed: 8" AS CustItemNumber, "Unnamed: 9" AS CustItemDesc, '
            '"MODEL #" AS CustVendStkNo, CAST("Sears Total Sales $" AS DECIMAL(18,4)) AS POSAmount, '
            'CAST(trunc("Sears Total Sales Units") AS INT) AS POSQuantity FROM raw '
            'WHERE "Sears Total Sales $" <> 0 AND "MODEL #" IS NOT NULL'
        ),
        passes=(("CustVendStkNo", "item_number", "brand"), ("CustItemNumber", "sears_id", "brand")),
        final={"UPC": "''"},
        prefer_flagged=True,
        appends_unmatched=True,
    ),
    "target": Twin(
        major="TARGET",
        feed=(
            f"SELECT {SRC}, replace(\"Item\", '-', '') AS CustItemNumber, \"Description\" AS CustItemDesc, "
            '"Model" AS CustVendStkNo, "Channel", "Fulfillment Method" AS Account, '
            "CASE WHEN \"Channel\" = 'ONLINE' THEN 'Clicks' ELSE 'Bricks' END AS BricksClicks, "
            "amount AS POSAmount, units AS POSQuantity FROM (SELECT *, "
            "CAST(CASE WHEN \"Sales $\" = '--' THEN '0' ELSE \"Sales $\" END AS DECIMAL(18,4)) AS amount, "
            "CAST(CASE WHEN \"Sales U\" = '--' THEN '0' ELSE \"Sales U\" END AS INT) AS units FROM raw) "
            "WHERE (\"Channel\" IS NULL OR \"Channel\" <> 'DC') AND (amount IS NULL OR amount <> 0)"
        ),
        passes=(("CustItemNumber", "target_id", "short_brand"), ("CustVendStkNo", "item_number", "brand")),
        final={"UPC": "''"},
        dedup="rows",
        keys="CustItemNumber, CustItemDesc, CustVendStkNo, Account, \"Channel\", POSQuantity, POSAmount",
        second_blanks=("CustItemNumber",),
    ),
    "walmart": Twin(
        major="WALMART",
        account="'WALMART'",
        channel="'Bricks'",
        feed=_WALMART + " WHERE \"POS Sales 202005\" IS NULL OR (\"Dept Category Description\" <> 'DOTCOM' "
        'AND "POS Sales 202005" <> 0)',
        feed_reference=_WALMART + " WHERE \"Dept Category Description\" <> 'DOTCOM' AND \"POS Sales 202005\" <> 0",
        aside=True,
        passes=(("CustItemNumber", "walmart_id", "brand"),),
        final={"UPC": "''"},
        prefer_flagged=True,
        dedup="final",
        keys="CustItemDesc, POSAmount, POSQuantity, CustItemNumber, CustVendStkNo",
        stamps_week=False,
    ),
    "wmcom_rl": Twin(
        feed=_feed(
            '"Walmart Item Number" AS CustItemNumber, "Item Name" AS CustItemDesc, '
            '"Vendor Stock ID" AS CustVendStkNo, UPC, UPC[3:] AS ShortUpc, '
            'CAST("Total Net Retail Sales" AS DECIMAL(18,4)) AS POSAmount, '
            'CAST(trunc("Total Net Unit Sales") AS INT) AS POSQuantity',
            NONZERO,
        ),
        **_WMCOM,
    ),
    "wmcom_ts": Twin(
        feed=_feed(
            '"Item ID" AS CustItemNumber, "Item" AS CustItemDesc, "Vendor Stk" AS CustVendStkNo, '
            'UPC, UPC[3:] AS ShortUpc, CAST("TY Sales" AS DECIMAL(18,4)) AS POSAmount, '
            'CAST(trunc("TY Qty") AS INT) AS POSQuantity',
            f"(\"Time\" IS NULL OR \"Time\" <> 'YTD') AND {NONZERO}",
        ),
        **_WMCOM,
    ),
    "legacy_kmart": Twin(
        major="KMART",
        account="'KMART'",
        channel="'Bricks'",
        has=("CustItemNumber", "CustVendStkNo"),
        feed=_kmart_feed("''") + "POSAmount > 0",
        drops_last_row=True,
        passes=(("CustItemNumber", "vendor_item", "upc12"), ("CustVendStkNo", "item_number", "upc12")),
        final={"UPC": "''"},
        prefer_flagged=True,
    ),
    "legacy_meijer": Twin(
        major="MEIJER",
        account="'MEIJER'",
        channel="'Bricks'",
        has=("CustItemNumber", "CustItemDesc", "CustVendStkNo", "UPC"),
        feed=_feed(
            '"Product ID" AS CustItemNumber, "Unnamed: 3" AS CustItemDesc, '
            '"Manufacturer Item Code" AS CustVendStkNo, UPC, CAST("Sales: $" AS DECIMAL(18,4)) AS POSAmount, '
            'CAST(trunc("Sales: Qty") AS INT) AS POSQuantity, "Sales: $ LY" AS ly, '
            '"Sales: $ % Diff TYLY" AS diff',
            'UPC IS NOT NULL AND "Sales: $" > 0',
        ),
        passes=(("CustItemNumber", "vendor_item", "upc12"), ("CustVendStkNo", "item_number", "upc12")),
        dedup="always",
        keys="CustItemNumber, CustItemDesc, CustVendStkNo, POSAmount, ly, diff",
        second_blanks=("CustItemNumber",),
    ),
    "legacy_bbb": Twin(
        major="BUY BUY BABY",
        account="'BUY BUY BABY'",
        channel="'Bricks'",
        has=("CustItemNumber", "CustItemDesc", "CustVendStkNo", "UPC"),
        feed=(
            f'SELECT {SRC}, "Concept", "Format", Sku AS CustItemNumber, "Unnamed: 7" AS CustItemDesc, '
            f"{trim_sql('VPN')} AS CustVendStkNo, ltrim(UPC, '0') AS UPC, "
            '"Sku Chain Retail" AS AvgRetail, '
            'CAST("Sales Units LW TY" * "Sku Chain Retail" AS DECIMAL(18,4)) AS POSAmount, '
            'CAST(trunc("Sales Units LW TY") AS INT) AS POSQuantity FROM raw '
            'WHERE "Sales Units LW TY" * "Sku Chain Retail" > 0'
        ),
        passes=(("UPC", "upc12", "description"),),
        dedup="always",
        keys='"Concept", "Format", CustItemNumber, UPC, AvgRetail, POSAmount',
    ),
}


def _columns(t: Twin, item: str, brand: str, outcome: str, reason: str, passed: str, mode: str, blanks=()) -> str:
    """The outcome columns from expressions over a joined row."""
    is_final = f"({outcome}) = 'final'"
    out = [SRC, f"'{t.major}' AS AccountMajor", f"{t.account or 'Account'} AS Account"]
    out.append(f"{t.channel or 'BricksClicks'} AS BricksClicks")
    for c in ("CustItemNumber", "CustItemDesc", "CustVendStkNo", "UPC"):
        fed = c if c in t.has else "CAST(NULL AS VARCHAR)"
        if c in blanks:
            fed = f"CASE WHEN {is_final} THEN NULL ELSE {fed} END"
        if c in t.final:
            fed = f"CASE WHEN {is_final} THEN {t.final[c]} ELSE {fed} END"
        out.append(f"{fed} AS {c}")
    week = "CAST(NULL AS VARCHAR)" if mode == "reference" and not t.stamps_week else WEEK
    premium = ", ".join(f"'{brand}'" for brand in PREMIUM_BRANDS)
    out += [
        f"CASE WHEN {is_final} THEN '' END AS ItemID",
        f"CASE WHEN {is_final} THEN {item} END AS ItemNumber",
        f"CASE WHEN {is_final} THEN CASE WHEN {brand} IN ({premium}) THEN 'Premium' ELSE 'Mainline' END END "
        "AS MainlinePremium",
        "CAST(POSAmount AS DOUBLE) AS POSAmount",
        "POSQuantity",
        f"{week} AS WeekEnding",
        f"{outcome} AS outcome",
        f"{reason} AS reason",
        f"CAST({passed} AS INT) AS match_pass",
    ]
    return ", ".join(out)


def _base(account: str, mode: str) -> str:
    t = TWINS[account]
    feed = t.feed_reference if mode == "reference" and t.feed_reference else t.feed
    raw = v.feed_sql(account)
    if t.drops_last_row:
        raw = f"SELECT * FROM ({raw}) QUALIFY src_row < max(src_row) OVER (PARTITION BY src_file, src_sheet)"
    return f"WITH raw AS ({raw}), master AS ({v.master_sql(account)}), feed AS ({feed})"


def strict_feed_sql(account: str) -> str:
    return f"{_base(account, 'strict')} SELECT * FROM feed"


def strict_sql(account: str) -> str:
    t = TWINS[account]
    sql = _base(account, "strict")
    joins, hits, found = "", [], []
    for n, (feed_key, key, flag) in enumerate(t.passes, 1):
        order = f"({flag} IS NULL), master_row" if t.prefer_flagged else "master_row"
        sql += (
            f", d{n} AS (SELECT {key} AS k{n}, item_number AS i{n}, short_brand AS b{n}, "
            f"({flag} IS NOT NULL) AS hit{n} FROM master WHERE {key} IS NOT NULL "
            f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"
        )
        joins += f" LEFT JOIN d{n} ON feed.{feed_key} = k{n}"
        hits.append(f"coalesce(hit{n}, FALSE)")
        found.append(f"k{n} IS NOT NULL")
    pick = lambda prefix: "CASE " + " ".join(f"WHEN {h} THEN {prefix}{n}" for n, h in enumerate(hits, 1)) + " END"
    if t.aside:
        hits = [f"(aside IS NULL AND {h})" for h in hits]
    outcome = f"CASE WHEN {' OR '.join(hits)} THEN 'final' ELSE 'exception' END"
    told = "WHEN aside IS NOT NULL THEN aside" if t.aside else ""
    reason = (
        f"CASE {told} WHEN {' OR '.join(hits)} THEN NULL WHEN {' OR '.join(found)} THEN 'null_flag' ELSE 'no_key' END"
    )
    columns = _columns(t, pick("i"), pick("b"), outcome, reason, pick(""), "strict")
    return f"{sql} SELECT {columns} FROM feed{joins}"


def _null_key_once(key: str) -> str:
    return (
        f"(SELECT * FROM master QUALIFY {key} IS NOT NULL "
        f"OR row_number() OVER (PARTITION BY {key} ORDER BY master_row) = 1)"
    )


def reference_sql(account: str) -> str:
    t = TWINS[account]
    sql = _base(account, "reference")
    feed_key, key, flag = t.passes[0]
    sql += (
        f", items AS MATERIALIZED (SELECT * FROM {_null_key_once(key)})"
        ", joined AS MATERIALIZED (SELECT feed.*, item_number, short_brand, master_row AS m1_row, "
        f"({flag} IS NOT NULL) AS hit FROM feed LEFT JOIN items ON feed.{feed_key} IS NOT DISTINCT FROM {key})"
    )
    number = f"row_number() OVER (PARTITION BY {t.keys} ORDER BY {t.order}, m1_row)"
    kept = {
        "none": "SELECT * FROM joined",
        "always": f"SELECT * FROM joined QUALIFY {number} = 1",
        "final": "SELECT unnest(f) FROM (SELECT arg_min(j, {'o': [src_file::VARCHAR, lpad(src_sheet::VARCHAR, 18, '0'), "
        f"lpad(src_row::VARCHAR, 18, '0')], 'm': m1_row}}) AS f FROM joined j WHERE hit GROUP BY {t.keys}) "
        "UNION ALL SELECT * FROM joined WHERE NOT hit",
        "rows": f"SELECT * FROM joined QUALIFY {number} = 1 OR "
        "(SELECT count(*) FROM joined) = (SELECT count(*) FROM feed)",
        "amount": f"SELECT * FROM joined QUALIFY {number} = 1 OR "
        "(SELECT coalesce(sum(POSAmount), 0) FROM joined) = (SELECT coalesce(sum(POSAmount), 0) FROM feed)",
    }[t.dedup]
    sql += f", merged AS ({kept})"
    reason = "CASE WHEN m1_row IS NULL THEN 'no_key' ELSE 'null_flag' END"
    if len(t.passes) == 1:
        outcome = "CASE WHEN hit THEN 'final' ELSE 'exception' END"
        columns = _columns(
            t, "item_number", "short_brand", outcome, f"CASE WHEN NOT hit THEN {reason} END",
            "CASE WHEN hit THEN 1 END", "reference",
        )
        return f"{sql} SELECT {columns} FROM merged"

    feed_key, key, flag = t.passes[1]
    item = "CAST(NULL AS VARCHAR)" if t.appends_unmatched else "item_number"
    first = _columns(t, item, "short_brand", "'final'", "CAST(NULL AS VARCHAR)", "1", "reference")
    sql += (
        ", retried AS (SELECT r.*, m.item_number AS i2, m.short_brand AS b2, m.master_row AS m2_row, "
        f"(m.{flag} IS NOT NULL) AS hit2 FROM (SELECT * FROM merged WHERE NOT hit) r "
        f"LEFT JOIN {_null_key_once(key)} m ON r.{feed_key} IS NOT DISTINCT FROM m.{key})"
    )
    reason = "CASE WHEN m2_row IS NULL THEN 'no_key' ELSE 'null_flag' END"
    second = _columns(
        t, "i2", "b2", "'final'", "CAST(NULL AS VARCHAR)", "CASE WHEN hit2 THEN 2 END", "reference", t.second_blanks
    )
    failed = _columns(t, "i2", "b2", "'exception'", reason, "NULL", "reference")
    where = "" if t.appends_unmatched else " WHERE hit2"
    return (
        f"{sql} SELECT {first} FROM merged WHERE hit UNION ALL SELECT {second} FROM retried{where} "
        f"UNION ALL SELECT {failed} FROM retried WHERE NOT hit2"
    )
