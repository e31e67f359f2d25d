from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from books import write_book
from posloom.sources import files, grid as g
from posloom.sources.workbook import column_index, read_workbooks


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("books")


def rows_of(grid, sheet):
    found = grid.filter(F.col("sheet_name") == sheet).orderBy("row_idx").collect()
    return [(r.row_idx, r.cells) for r in found]


def test_cells_become_text(spark, folder):
    write_book(
        folder / "kinds.xlsx",
        {
            "First": [
                ["00123", 123, 12.5, 1e21, None, True, "", "a & b"],
                [],
                [(43831, 1), (43831.5, 1), (43831, 2), (43831, 3)],
            ],
            "Second": [["x"]],
        },
    )
    grid = read_workbooks(spark, str(folder / "kinds.xlsx"))
    assert rows_of(grid, "First") == [
        (0, ["00123", "123", "12.5", "1000000000000000000000", None, "True", None, "a & b"]),
        (1, []),
        (2, ["2020-01-01", "2020-01-01 12:00:00", "2020-01-01", "43831"]),
    ]
    assert rows_of(g.sheet_at(grid, 1), "Second") == [(0, ["x"])]


def test_inline_strings_and_several_books(spark, tmp_path):
    for name in ("a", "b"):
        write_book(tmp_path / f"{name}.xlsx", {"S": [[name, 1]]}, inline=True)
    (tmp_path / "notes.txt").write_text("no workbook")
    grid = read_workbooks(spark, str(tmp_path))
    assert sorted(r.cells for r in grid.collect()) == [["a", "1"], ["b", "1"]]


def test_long_sheet_crosses_batches(spark, tmp_path):
    write_book(tmp_path / "long.xlsx", {"S": [[i] for i in range(10_001)]})
    grid = read_workbooks(spark, str(tmp_path))
    total = grid.select(F.sum(grid.cells[0].cast("long")), F.count("*"), F.max("row_idx")).first()
    assert tuple(total) == (50_005_000, 10_001, 10_000)


def grid_of(spark, sheets):
    rows = [
        (path, "S", 0, i, cells) for path, lines in sheets.items() for i, cells in enumerate(lines)
    ]
    return spark.createDataFrame(
        rows, "path string, sheet_name string, sheet_idx int, row_idx bigint, cells array<string>"
    )


def test_header_names(spark):
    grid = grid_of(spark, {"p": [["title"], ["A", "", "A", None, "A"], ["1", "2", "3"]]})
    row = g.named_rows(grid, 1).first()
    assert row.header == ["A", "Unnamed: 1", "A.1", "Unnamed: 3", "A.2"]
    assert row.row == {"A": "1", "Unnamed: 1": "2", "A.1": "3", "Unnamed: 3": None, "A.2": None}


def test_cells_beyond_the_header_are_unnamed(spark):
    grid = grid_of(spark, {"p": [["A"], ["1", "2", "3"], []]})
    rows = [r.row for r in g.named_rows(grid, 0).orderBy("row_idx").collect()]
    assert rows == [{"A": "1", "Unnamed: 1": "2", "Unnamed: 2": "3"}, {"A": None}]


def test_promoted_header_skips_preamble_and_incomplete_rows(spark):
    grid = grid_of(
        spark,
        {
            "p": [["Report"], [None, None, "x"], ["Item", "Sales", "Qty"], ["1", "2", "3"], ["1", None, "3"], ["4", "5"]],
            "q": [["Only", None]],
        },
    )
    rows = g.named_rows(grid, None).collect()
    assert [r.row for r in rows] == [{"Item": "1", "Sales": "2", "Qty": "3"}]


def test_header_search_hashes_numbers_and_sorts_no_cells(spark):
    """Sheets without an index, a header that comes twice, a complete row too narrow to be one."""
    grid = spark.createDataFrame(
        [("a", None, 0, ["t"]), ("a", None, 1, ["n", None]), ("a", None, 2, ["y", "z"]), ("a", None, 2, ["x", "z"]), ("a", None, 3, ["1", "2"]),
         ("b", 0, 0, ["p", None]), ("c", 1, 5, ["k"])],
        "path string, sheet_idx int, row_idx bigint, cells array<string>",
    )
    header = g.promoted_header(grid)
    found = sorted((tuple(r) for r in header.select("path", "sheet_idx", "_header_row", "header", "_width").collect()), key=str)
    assert found == [("a", None, 2, ["x", "z"], 2), ("c", 1, 5, ["k"], 1)]
    plan = header._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and all("(cells" in line for line in plan.splitlines() if "SortAggregate" in line)
    assert "SortMergeJoin" not in plan


def test_last_column_with_token_wins(spark):
    grid = grid_of(spark, {"p": [["POS Sales 1", "POS Qty POS Sales", "POS Qty 1"], ["1", "2", "3"]]})
    picked = g.named_rows(grid, 0).select(
        g.cell_with("POS Sales"), g.cell_with("POS Qty", unless="POS Sales"), g.cell_with("nothing")
    )
    assert tuple(picked.first()) == ("2", "3", None)


def test_positions():
    assert g.positions("A, C:D, AA:AB") == [0, 2, 3, 26, 27]
    assert column_index("AI") == 34


def test_unknown_layout_fails(spark):
    grid = grid_of(spark, {"p": [["Other"]], "q": [["Item ID"]]})
    signatures = {"rl": (13, "Walmart Item Number"), "ts": (0, "Item ID")}
    with pytest.raises(Exception, match="unknown layout: p 0"):
        g.layout_of(grid, signatures).collect()
    known = g.layout_of(grid.filter("path = 'q'"), signatures).first()
    assert known.layout == "ts"


def test_rl_layout_is_tried_first(spark):
    lines = [["Item ID"], *[["-"]] * 12, ["Walmart Item Number"]]
    signatures = {"rl": (13, "Walmart Item Number"), "ts": (0, "Item ID")}
    assert g.layout_of(grid_of(spark, {"p": lines}), signatures).first().layout == "rl"


def test_file_discovery(spark, tmp_path):
    for name in ("Amazon W-E 1.xlsx", "BBB-Mainline.xlsx", "other.xlsx"):
        write_book(tmp_path / name, {"S": [["x"]]})
    listed = files.list_files(spark, str(tmp_path))
    found = files.files_of_accounts(listed, {"amazon": "amazon", "bbb": "bbb-mainline"})
    assert {(r.account, r.file_name) for r in found.collect()} == {
        ("amazon", "Amazon W-E 1.xlsx"),
        ("bbb", "BBB-Mainline.xlsx"),
    }
    # Contents are not part of the scan.
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    ledger = listed.filter("file_name = 'other.xlsx'").select("path")
    assert files.not_processed(listed, ledger).count() == 2
