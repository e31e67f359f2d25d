"""The weekly run over workbooks: expected rows worked out by hand."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import fixtures
from books import write_book
from posloom.plans import job
from posloom.plans.accounts import ACCOUNTS
from posloom.plans.publish import Sinks, publish, read_ledger, read_published, vacuum
from posloom.schema import CANONICAL
from posloom.sources.workbook import read_workbooks

RUN_DATE = dt.date(2020, 3, 1)
WEEK = dt.date(2020, 2, 22)


@pytest.fixture(scope="module")
def drop(tmp_path_factory):
    folder = tmp_path_factory.mktemp("drop")
    (folder / "raw").mkdir()
    for name, sheets in fixtures.FILES.items():
        write_book(folder / "raw" / name, sheets)
    write_book(folder / "master.xlsx", fixtures.MASTER)
    return folder


@pytest.fixture(scope="module")
def weekly(spark, drop):
    return job.run(
        spark, str(drop / "raw"), str(drop / "master.xlsx"), fixtures.MASTER_SHEET, str(drop / "out"), RUN_DATE,
        ledger=str(drop / "ledger"),
    )


FINAL = {
    # CustItemNumber, desc, stock no., ItemNumber, tier, amount, quantity, UPC, channel, account
    "AMAZON": [
        ("1", "Car Seat", "", "IT1", "Premium", "10.5", 2, "", "Clicks", "AMAZON"),
        ("1", "Unknown", "", "IT1", "Premium", None, None, "", "Clicks", "AMAZON"),
        ("2", "Return", "", "IT2", "Mainline", "-5", -1, "", "Clicks", "AMAZON"),
        ("2", "Stroller", "", "IT2", "Mainline", "20", 1, "", "Clicks", "AMAZON"),
        ("2", "Stroller", "", "IT2", "Mainline", "20", 1, "", "Clicks", "AMAZON"),
        ("3", "No brand", "", "IT3", "Mainline", "2", 1, "", "Clicks", "AMAZON"),
    ],
    "BUY BUY BABY": [
        # 0.125 rounds to 0.12 and 0.375 to 0.38 before they are added.
        ("s1", "Seat", "", "IT1", "Premium", "0.5", 4, "0190000000001", "Bricks", "BUY BUY BABY"),
        ("s2", "Stroller", "", "IT2", "Mainline", "10", 5, "884392000002", "Bricks", "BUY BUY BABY"),
    ],
    "HOME DEPOT": [("1", "Car Seat Blue", "", "IT1", "Premium", "0.12", 2, "", "Bricks", "HOME DEPOT")],
    "KMART": [("001", "Seat", "IT1", "IT1", "Premium", "5", 1, "", "Bricks", "KMART")],
    "MARKETPLACE": [("m1", "Seat", "IT1", "IT1", "Premium", "8", 1, "marketplace", "Clicks", "Shop A")],
    "MEIJER": [("2", "Stroller", "V2", "IT2", "Mainline", "3.34", 1, "0002", "Bricks", "MEIJER")],
    "NORDSTROM": [
        ("", "Seat", "IT1", "IT1", "Premium", "4", 1, "", "Clicks", "NORDSTROM"),
        ("", "Stroller", "IT2", "IT2", "Mainline", "5", 1, "", "Bricks", "NORDSTROM"),
    ],
    "SAMS": [("11", "Seat", "IT1", "IT1", "Premium", "10", 1, "", "Bricks", "SAMS")],
    "SEARS": [
        ("2", "Stroller", "VX", "IT2", "Mainline", "4", 2, "", "Clicks", "Sears"),
        ("501", "Seat", "IT1", "IT1", "Premium", "3", 1, "", "Clicks", "Sears"),
    ],
    "TARGET": [
        ("030", "Stroller", "IT2", "IT2", "Mainline", "6", 0, "", "Clicks", "Shipped"),
        ("1", "Seat", "IT9", "IT1", "Premium", "4.5", 2, "", "Bricks", "Bought in store"),
    ],
    "WALMART": [
        ("1", "Seat", "IT1", "IT1", "Premium", "5", 1, "", "Bricks", "WALMART"),
        ("2", "Stroller", "IT2", "IT2", "Mainline", "6", 3, "", "Bricks", "WALMART"),
    ],
    "WALMART.COM": [("w1", "Seat", "IT1", "IT1", "Premium", "4", 1, "00S1", "Clicks", "WALMART.COM")],
}
# CustItemNumber or description, amount, reason
EXCEPTIONS = {
    "AMAZON": [("No such item", "7", "no_key"), ("No number", "3", "no_key")],
    "BUY BUY BABY": [("No UPC", "4", "no_key")],
    "HOME DEPOT": [("", "4", "no_key"), ("No UPC", "1", "null_flag")],
    "KMART": [(None, "6", "no_key")],
    "MARKETPLACE": [("Strange", "9", "no_key")],
    "NORDSTROM": [("None", "6", "no_key"), (None, "6", "no_key")],
    "SAMS": [("Blank", "10", "incomplete_row")],
    "SEARS": [("None", "5", "no_key")],
    "TARGET": [("Nothing", "7", "no_key")],
    "WALMART.COM": [("None", "3", "no_key")],
}


def money(text):
    return None if text is None else Decimal(text)


@pytest.mark.parametrize("account", list(FINAL))
def test_outcomes_of_an_account(weekly, account):
    mine = weekly.rows.filter(F.col("AccountMajor") == account)
    final = mine.filter("outcome = 'final'").select(
        "CustItemNumber", "CustItemDesc", "CustVendStkNo", "ItemNumber", "MainlinePremium", "POSAmount",
        "POSQuantity", "UPC", "BricksClicks", "Account", "WeekEnding", "ItemID",
    )
    expected = [(*r[:5], money(r[5]), *r[6:], WEEK, "") for r in FINAL[account]]
    assert sorted((tuple(r) for r in final.collect()), key=str) == sorted(expected, key=str)
    failed = mine.filter("outcome = 'exception'").select("CustItemDesc", "POSAmount", "reason")
    expected = [(d, money(a), why) for d, a, why in EXCEPTIONS.get(account, [])]
    assert sorted((tuple(r) for r in failed.collect()), key=str) == sorted(expected, key=str)


def read(spark, out, sink, commits=None):
    return read_published(spark, Sinks.under(str(out), commits and str(commits)), sink)


def test_only_clean_accounts_are_published(spark, drop, weekly):
    clean = set(FINAL) - set(EXCEPTIONS)
    out, ledger = drop / "out", drop / "ledger"
    tsv = read(spark, out, "tsv", ledger)
    assert tsv.columns == ["for_account", "for_file", "for_week", *CANONICAL]
    assert {r.AccountMajor for r in tsv.collect()} == clean
    assert tsv.count() == sum(len(FINAL[a]) for a in clean) == read(spark, out, "archive_csv", ledger).count()
    failed = read(spark, out, "exceptions", ledger)
    assert {r.AccountMajor for r in failed.select("AccountMajor").collect()} == set(EXCEPTIONS)
    assert {"src_file", "src_row", "reason"} <= set(failed.columns)
    totals = {r.AccountMajor: (r.POSAmount, r.POSQuantity, r.row_count) for r in read(spark, out, "validation", ledger).collect()}
    assert totals == {
        "MEIJER": ("3.3400", "1", "1"),
        "WALMART": ("11.0000", "4", "2"),
    }


def test_rerun_replaces_its_folders(spark, drop, weekly):
    sinks = Sinks.under(str(drop / "out"), str(drop / "ledger"))
    before = read_published(spark, sinks, "tsv").count()
    publish(spark, weekly.rows, sinks)
    assert read_published(spark, sinks, "tsv").count() == before


def outcome(account, name, kind, amount="1"):
    row = dict.fromkeys(CANONICAL)
    row |= {"AccountMajor": account, "POSAmount": Decimal(amount), "POSQuantity": 1, "WeekEnding": WEEK}
    return (name, 0, 1, *row.values(), kind, None if kind == "final" else "no_key", None, 1)


def outcome_frame(spark, rows):
    kinds = {"POSAmount": "decimal(18,4)", "POSQuantity": "int", "WeekEnding": "date"}
    schema = "src_file string, src_sheet int, src_row bigint, " + ", ".join(f"{c} {kinds.get(c, 'string')}" for c in CANONICAL)
    return spark.createDataFrame(rows, schema + ", outcome string, reason string, match_pass int, counted int")


def held(spark, sinks):
    """Account and token of what each sink publishes."""
    return [
        sorted({(r.for_account, r.for_file) for r in read_published(spark, sinks, sink).collect()})
        for sink in ("tsv", "archive_csv", "exceptions", "validation")
    ]


def published(spark, rows, files, out):
    named = spark.createDataFrame(files, "path string, account string, major string")
    sinks = Sinks.under(str(out))
    publish(spark, outcome_frame(spark, rows), sinks, named)
    return sinks, held(spark, sinks)


def test_a_rerun_unpublishes_what_fails_now(spark, tmp_path):
    files = [("f1", "amazon", "AMAZON"), ("f2", "sears", "SEARS")]
    good, bad = [("amazon", "amazon")], [("sears", "sears")]
    rows = [outcome("AMAZON", "f1", "final"), outcome("SEARS", "f2", "final"), outcome("SEARS", "f2", "exception")]
    assert published(spark, rows, files, tmp_path)[1] == [good, good, bad, good]
    rows = [outcome("AMAZON", "f1", "exception"), outcome("SEARS", "f2", "final")]
    sinks, now = published(spark, rows, files, tmp_path)
    assert now == [bad, bad, good, bad]
    assert len(vacuum(spark, sinks)) == 1 and held(spark, sinks) == now and vacuum(spark, sinks) == []


def test_two_files_of_one_account_are_published_by_themselves(spark, tmp_path):
    main, maxi = ("f1", "bbbmainline", "BUY BUY BABY"), ("f2", "bbbmaxi", "BUY BUY BABY")
    first = [("buy buy baby", "bbbmainline")]
    assert read_ledger(spark, Sinks.under(str(tmp_path)).commits).count() == 0
    sinks, now = published(spark, [outcome("BUY BUY BABY", "f1", "final")], [main, ("f3", "sams", "SAMS")], tmp_path)
    assert now == [first, first, [], first]
    # A file without rows is done as well.
    assert sorted(r.account for r in read_ledger(spark, sinks.commits).collect()) == ["bbbmainline", "sams"]
    failed = published(spark, [outcome("BUY BUY BABY", "f2", "exception")], [maxi], tmp_path)[1]
    assert failed == [first, first, [("buy buy baby", "bbbmaxi")], first]
    assert sorted(r.account for r in read_ledger(spark, sinks.commits).collect()) == ["bbbmainline", "sams"]


STEPS = ["write_text:0", "write_text:1", "write_text:3", "processed:0", "rename"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_stops_leaves_the_old_version(spark, tmp_path, monkeypatch, step):
    """Stopped before each write, before the list of done files, and before the one step that commits."""
    from posloom.plans import publish as module

    files = [("f1", "amazon", "AMAZON"), ("f2", "sears", "SEARS")]
    old = [outcome("AMAZON", "f1", "final", "5"), outcome("SEARS", "f2", "exception")]
    sinks, before = published(spark, old, files, tmp_path)
    done = sorted(tuple(r) for r in read_ledger(spark, sinks.commits).collect())
    name, _, nth = step.partition(":")
    calls = []

    def stop_at(original):
        def call(*args, **options):
            calls.append(args)
            if len(calls) > int(nth or 0):
                raise KeyboardInterrupt
            return original(*args, **options)

        return call

    with monkeypatch.context() as patch:
        if name == "rename":
            patch.setattr(module.log, "commit", stop_at(module.log.commit))
        else:
            patch.setattr(module, name, stop_at(getattr(module, name)))
        new = [outcome("AMAZON", "f1", "exception"), outcome("SEARS", "f2", "final")]
        with pytest.raises(KeyboardInterrupt):
            published(spark, new, files, tmp_path)
    assert held(spark, sinks) == before
    assert sorted(tuple(r) for r in read_ledger(spark, sinks.commits).collect()) == done == [("f1", "amazon")]
    after = published(spark, new, files, tmp_path)[1]  # the same run again
    good, bad = [("sears", "sears")], [("amazon", "amazon")]
    assert after == [good, good, bad, good]
    vacuum(spark, sinks)
    assert held(spark, sinks) == after


def test_few_groups_are_published_without_a_shuffle(spark, tmp_path, monkeypatch):
    from posloom.plans import publish as module

    rows = [outcome(a, None, kind) for a in ("AMAZON", "SEARS", "KMART") for kind in ("final", "final")]
    frame = outcome_frame(spark, [*rows, outcome("KMART", None, "exception")])
    hints = []
    plain = type(frame).hint
    monkeypatch.setattr(type(frame), "hint", lambda df, name, *args: hints.append(name) or plain(df, name, *args))
    tables = []
    for limit in (64, 2):
        monkeypatch.setattr(module, "FEW_GROUPS", limit)
        sinks = Sinks.under(str(tmp_path / str(limit)))
        publish(spark, frame, sinks)
        tables.append([sorted(map(str, read_published(spark, sinks, s).collect())) for s in module.SINKS])
        assert hints == (["rebalance"] * 4 if limit == 2 else [])
        assert all(f.suffix == ".gz" for f in (tmp_path / str(limit) / "archive_csv").rglob("part-*"))
        assert all(f.suffix == ".csv" for f in (tmp_path / str(limit) / "processed_tsv").rglob("part-*"))
    assert tables[0] == tables[1] and [len(t) for t in tables[0]] == [4, 4, 1, 2]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_staged_outcomes_are_published_again_without_a_copy(spark, tmp_path, monkeypatch):
    from posloom.plans import publish as module

    rows = [outcome(a, None, kind) for a in ("AMAZON", "SEARS") for kind in ("final", "exception")]
    kept = module.stage_outcomes(spark, outcome_frame(spark, rows))
    monkeypatch.setattr(module, "stage", lambda *args: pytest.fail("staged twice"))
    sinks = Sinks.under(str(tmp_path))
    for failed, good in (("AMAZON", "sears"), ("SEARS", "amazon")):
        publish(spark, kept.filter((F.col("outcome") == "final") | (F.col("AccountMajor") == failed)), sinks, staged=True)
        assert held(spark, sinks) == [[(good, good)], [(good, good)], [(failed.lower(), failed.lower())], [(good, good)]]


def test_a_commit_is_not_overwritten(spark, tmp_path):
    from posloom.sources import commits as log

    folder = str(tmp_path / "log")
    assert log.commit(spark, folder, {"version": "a"}) == 1 and log.commit(spark, folder, {"version": "b"}) == 2
    with pytest.raises(FileExistsError):
        log.commit(spark, folder, {"version": "c"}, 2)
    assert sorted(tuple(r) for r in log.read_commits(spark, folder, "version string").collect()) == [(1, "a"), (2, "b")]


def test_a_file_of_two_accounts_reaches_both(spark, drop, tmp_path):
    write_book(tmp_path / "Sears Kmart.xlsx", next(iter(fixtures.FILES.values())))
    files = job.select_files(spark, str(tmp_path), job.account_tokens())
    grid, tokens = job.load_grid(spark, files)
    assert tokens == ["kmart", "sears"]
    assert {r.token: r["count"] for r in grid.groupBy("token").count().collect()}.keys() == {"kmart", "sears"}


def test_published_files_do_not_come_up_again(spark, drop, weekly):
    again = job.select_files(spark, str(drop / "raw"), job.account_tokens(), str(drop / "ledger"))
    assert {r.account for r in again.collect()} == {
        "amazon", "bbbmainline", "depot", "kmart", "marketplace", "nordstrom", "sams", "sears", "target", "wmcom",
    }


def test_missing_accounts_are_named(weekly):
    assert weekly.missing == ("bbbmaxi",)


def test_wmcom_layouts(spark, tmp_path):
    write_book(tmp_path / "rl.xlsx", fixtures.WMCOM_RL)
    write_book(tmp_path / "ts.xlsx", fixtures.WMCOM_TS)
    write_book(tmp_path / "m.xlsx", fixtures.MASTER)
    grid = read_workbooks(spark, str(tmp_path), "[rt]*.xlsx").withColumn("token", F.lit("wmcom"))
    master = job.load_master(spark, str(tmp_path / "m.xlsx"), fixtures.MASTER_SHEET)
    rows = job.run_grid(grid, ["wmcom"], master, RUN_DATE)
    found = rows.groupBy(F.regexp_extract("src_file", "([a-z]+).xlsx", 1), "outcome").count().collect()
    assert {tuple(r) for r in found} == {("rl", "final", 1), ("ts", "final", 1), ("ts", "exception", 1)}


def test_master_is_validated_against_the_warehouse(spark, drop):
    master = job.load_master(spark, str(drop / "master.xlsx"), fixtures.MASTER_SHEET)
    known = spark.createDataFrame([("1", "IT1"), ("2", "IT2")], "ItemID string, ItemNumber string")
    invalid = job.validate_master(master, known)
    assert sorted(r.item_number for r in invalid.collect()) == ["IT2B", "IT3", "IT9"]


def test_metrics_and_reconciliation(weekly):
    assert weekly.metrics["AMAZON"]["rows"] == len(FINAL["AMAZON"]) + len(EXCEPTIONS["AMAZON"])
    found = {r.AccountMajor: r for r in weekly.reconciliation().collect()}
    assert set(found) == set(FINAL) and all(r.balanced for r in found.values())
    assert weekly.invalid_items is None and weekly.not_run is None


def test_staged_folders_go_with_the_run(spark, drop, tmp_path):
    from pathlib import Path

    from posloom.session import shared_dir

    shared = Path(shared_dir(spark))
    before = set(shared.iterdir())
    (tmp_path / "raw").mkdir()
    first = next(n for n in fixtures.FILES if "mazon" in n)
    write_book(tmp_path / "raw" / first, fixtures.FILES[first])
    run = job.run(spark, str(tmp_path / "raw"), str(drop / "master.xlsx"), fixtures.MASTER_SHEET, str(tmp_path / "out"), RUN_DATE)
    assert [p.name.partition("-")[0] for p in set(shared.iterdir()) - before] == ["outcomes"]
    run.close()
    assert set(shared.iterdir()) == before


def test_accounts_not_run(spark):
    table = spark.createDataFrame([("Amazon",), ("SEARS",), (None,)], "AccountMajor string")
    left = {r.AccountMajor for r in job.accounts_not_run(table).collect()}
    assert "target" in left and not left & {"amazon", "sears"}


def run_amazon(spark, tmp_path, sheets):
    (tmp_path / "raw").mkdir()
    write_book(tmp_path / "raw" / "amazon.xlsx", sheets)
    write_book(tmp_path / "m.xlsx", fixtures.MASTER)
    return job.run(spark, str(tmp_path / "raw"), str(tmp_path / "m.xlsx"), fixtures.MASTER_SHEET, str(tmp_path / "out"), RUN_DATE)


def test_a_missing_column_stops_the_run(spark, tmp_path):
    first = fixtures.FILES[next(n for n in fixtures.FILES if "mazon" in n)]
    name, rows = next(iter(first.items()))
    changed = [["Ordered Revenue ($)" if c == "Ordered Revenue" else c for c in row] for row in rows]
    with pytest.raises(job.LayoutError, match="amazon.*no column Ordered Revenue"):
        run_amazon(spark, tmp_path, {name: changed})


def test_unreadable_cells_are_exceptions(spark, tmp_path):
    first = fixtures.FILES[next(n for n in fixtures.FILES if "mazon" in n)]
    name, rows = next(iter(first.items()))
    at = next(k for k, row in enumerate(rows) if "Ordered Revenue" in row)
    header = rows[at]

    def row(asin, amount, units):
        cells = {"ASIN": asin, "Product Title": "t", "Ordered Revenue": amount, "Ordered Units": units}
        return [cells.get(c) for c in header]

    body = [row("1", "$1,234.50", 1), row("1", 5, "1,000"), row("1", 6, 2), row("1", 7, "99999999999"), row("1", " ", 1)]
    run = run_amazon(spark, tmp_path, {name: [*rows[: at + 1], *body]})
    got = sorted((r.outcome, str(r.reason), str(r.POSAmount)) for r in run.rows.collect())
    assert got == [
        ("exception", "bad_amount", "None"), ("exception", "bad_quantity", "5.0000"),
        ("exception", "bad_quantity", "7.0000"), ("final", "None", "6.0000"), ("final", "None", "None"),
    ]


def test_every_account_has_a_token():
    assert all(spec.tokens for spec in ACCOUNTS.values())


def test_delimited_exports_run_like_workbooks(spark, drop, weekly, tmp_path):
    """The sheets of two accounts and the master as text files, read in splits."""
    import csv

    (tmp_path / "raw").mkdir()
    sheets = {name: list(sheets.values())[-1] for name, sheets in fixtures.FILES.items() if "amazon" in name.lower() or "meijer" in name.lower()}
    assert len(sheets) == 2
    for k, (name, rows) in enumerate(sheets.items()):
        with open(tmp_path / "raw" / name.replace(".xlsx", [".csv", ".tsv"][k]), "w", newline="") as out:
            csv.writer(out, delimiter=",\t"[k]).writerows(["" if c is None else c for c in row] for row in rows)
    with open(tmp_path / "master.csv", "w", newline="") as out:
        csv.writer(out).writerows(["" if c is None else c for c in row] for row in fixtures.MASTER[fixtures.MASTER_SHEET])
    run = job.run(spark, str(tmp_path / "raw"), str(tmp_path / "master.csv"), fixtures.MASTER_SHEET, str(tmp_path / "out"), RUN_DATE)

    def found(rows):
        mine = rows.filter(F.col("AccountMajor").isin("AMAZON", "MEIJER"))
        return sorted((tuple(r) for r in mine.select(*CANONICAL, "outcome", "reason", "src_row").collect()), key=str)

    assert found(run.rows) == found(weekly.rows) and len(found(run.rows)) > 5
    assert [r.for_account for r in read(spark, tmp_path / "out", "tsv").collect()] == ["meijer"]


def test_legacy_accounts_run_from_cross_references(spark, tmp_path):
    """The older job: each account's export against its own cross reference sheet."""
    import csv

    from posloom.plans.accounts import LEGACY_ACCOUNTS
    from posloom.schema import CROSSREF_HEADERS

    def export(name, rows):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        with open(path, "w", newline="") as out:
            csv.writer(out).writerows(["" if c is None else c for c in row] for row in rows)
        return str(path)

    meijer = [list(r) for r in fixtures.FILES["MEIJER 02-22-20.xlsx"]["WEEK"]]
    for row, more in zip(meijer[4:], (["Sales: $ LY", "Sales: $ % Diff TYLY"], [2, 0.5], [2, 0.5], [2, 0.5])):
        row += more
    bbb = [list(r) for r in fixtures.FILES["BBB-Mainline W-E 02-22-2020.xlsx"]["Total"]]
    for row in bbb[5:]:
        row.append("Format" if row[0] == "Concept" else "F1")
    export("raw/KMART W-E 02-22-20.csv", fixtures.FILES["KMART W-E 02-22-20.xlsx"]["LW SALES"])
    export("raw/MEIJER 02-22-20.csv", meijer)
    export("raw/BBB-Mainline W-E 02-22-2020.csv", bbb)
    head = list(CROSSREF_HEADERS.values())

    def known(name, **cells):
        return export(name, [head, [cells.get(column) for column in CROSSREF_HEADERS]])

    where = {
        "legacy_kmart": (known("kmart.csv", item_number="XK", vendor_item="001", upc12="1", short_brand="QUINNY"), "any"),
        "legacy_meijer": (known("meijer.csv", item_number="XM", vendor_item="2", upc12="1"), "any"),
        "legacy_bbb": (known("bbb.csv", item_number="XB", upc12="190000000001", description="Seat"), "any"),
    }
    run = job.run(spark, str(tmp_path / "raw"), None, None, str(tmp_path / "out"), RUN_DATE, LEGACY_ACCOUNTS, crossrefs=where)
    found = {(r.AccountMajor, r.ItemNumber, r.outcome) for r in run.rows.collect()}
    assert {("KMART", "XK", "final"), ("MEIJER", "XM", "final"), ("BUY BUY BABY", "XB", "final")} <= found
    assert ("KMART", None, "exception") in found and ("BUY BUY BABY", None, "exception") in found
    assert [r.for_account for r in read(spark, tmp_path / "out", "tsv").collect()] == ["meijer"]
    with pytest.raises(ValueError, match="legacy_bbb"):
        job.run(spark, str(tmp_path / "raw"), None, None, str(tmp_path / "out"), RUN_DATE, LEGACY_ACCOUNTS, crossrefs={k: v for k, v in where.items() if k != "legacy_bbb"})
