"""OOXML workbooks as rows of cells.

Spark lists and ships the files (``binaryFile``), one task decodes a workbook
at a time and hands Arrow batches back. A workbook sheet has at most 1,048,576
rows, so a task's work is bounded whatever the number of files. All further
work on the cells is plain DataFrame code in ``grid``.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from posloom.schema import GRID_SCHEMA

BATCH_ROWS = 4096

# Number formats that the workbook standard defines as dates.
DATE_FORMAT_IDS = frozenset([14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47])

_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("file_mtime", pa.timestamp("us", tz="UTC")),
        ("sheet_name", pa.string()),
        ("sheet_idx", pa.int32()),
        ("row_idx", pa.int64()),
        ("cells", pa.list_(pa.string())),
    ]
)


def read_workbooks(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """Every cell row of every sheet of every workbook under ``path``."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return decode(files)


def decode(files: DataFrame) -> DataFrame:
    """``binaryFile`` rows (batch or stream) to grid rows."""
    return files.select("path", "modificationTime", "content").mapInArrow(
        _decode_batches, GRID_SCHEMA
    )


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, mtime, content in zip(*batch.columns):
            head = (path.as_py(), mtime.as_py())
            rows = []
            for row in _workbook_rows(content.as_buffer()):
                rows.append((*head, *row))
                if len(rows) == BATCH_ROWS:
                    yield _to_batch(rows)
                    rows = []
            if rows:
                yield _to_batch(rows)


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _workbook_rows(content) -> Iterator[tuple[str, int, int, list[str | None]]]:
    """(sheet name, sheet number, row number, cells), in sheet order."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_strings(book)
        dates = _date_styles(book)
        for index, (name, part) in enumerate(_sheets(book)):
            for row, cells in _sheet_rows(book, part, shared, dates):
                yield name, index, row, cells


def _elements(book: zipfile.ZipFile, part: str, tag: str):
    """Elements of one kind, freed as soon as they have been used."""
    with book.open(part) as stream:
        for _, element in ElementTree.iterparse(stream):
            if _local(element) == tag:
                yield element
                element.clear()


def _local(element) -> str:
    return element.tag.rpartition("}")[2]


def _text(element) -> str:
    return "".join(t.text or "" for t in element.iter() if _local(t) == "t")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    return [_text(item) for item in _elements(book, "xl/sharedStrings.xml", "si")]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    date_ids = set(DATE_FORMAT_IDS)
    for fmt in root.iter():
        if _local(fmt) == "numFmt":
            shown = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", fmt.get("formatCode", "")).lower()
            if re.search(r"[ymd]", shown):
                date_ids.add(int(fmt.get("numFmtId")))
    styles = next((e for e in root if _local(e) == "cellXfs"), ())
    return {i for i, xf in enumerate(styles) if int(xf.get("numFmtId", 0)) in date_ids}


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Sheet names with the archive member of each, in workbook order."""
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {link.get("Id"): link.get("Target") for link in links}
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    found = []
    for sheet in root.iter():
        if _local(sheet) == "sheet":
            link = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
            target = targets[link]
            found.append((sheet.get("name"), target[1:] if target[0] == "/" else f"xl/{target}"))
    return found


def _sheet_rows(book, part, shared, dates) -> Iterator[tuple[int, list[str | None]]]:
    position = 0
    for row in _elements(book, part, "row"):
        number = int(row.get("r", position + 1)) - 1
        for blank in range(position, number):
            yield blank, []
        cells: list[str | None] = []
        for cell in row:
            place = column_index(re.match("[A-Z]+", cell.get("r")).group()) if cell.get("r") else len(cells)
            cells.extend([None] * (place - len(cells)))
            cells.append(_cell(cell, shared, dates))
        yield number, cells
        position = number + 1


def column_index(letters: str) -> int:
    """0-based column of its letters: A is 0, AA is 26."""
    index = 0
    for letter in letters:
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _cell(cell, shared: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _text(cell) or None
    raw = next((v.text for v in cell if _local(v) == "v"), None)
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(raw)] or None
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind == "n":
        return _date(raw) if int(cell.get("s", 0)) in dates else _number(raw)
    return raw or None


def _number(raw: str) -> str:
    """Digits without exponent, and without ``.0`` for a whole number."""
    try:
        shown = format(Decimal(raw), "f")
    except InvalidOperation:
        return raw
    return shown.rstrip("0").rstrip(".") if "." in shown else shown


def _date(raw: str) -> str:
    """Day number (day 1 is 1900-01-01, with its leap day that never was)."""
    moment = dt.datetime(1899, 12, 30) + dt.timedelta(days=float(raw))
    return moment.date().isoformat() if float(raw).is_integer() else moment.isoformat(" ", "seconds")
