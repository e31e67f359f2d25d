"""Tiny OOXML workbooks for tests, written with the standard library."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def letters(index: int) -> str:
    text = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        text = chr(65 + rest) + text
    return text


def cell_xml(reference: str, value, shared: list[str], inline: bool) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{reference}"><v>{value!r}</v></c>'
    if isinstance(value, tuple):
        return f'<c r="{reference}" s="{value[1]}"><v>{value[0]}</v></c>'
    if inline:
        return f'<c r="{reference}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
    if value not in shared:
        shared.append(value)
    return f'<c r="{reference}" t="s"><v>{shared.index(value)}</v></c>'


def write_book(path, sheets: dict[str, list[list]], inline: bool = False) -> None:
    """``sheets``: name -> rows of cells; a tuple is (serial, style number)."""
    shared: list[str] = []
    parts = []
    for rows in sheets.values():
        body = ""
        for i, row in enumerate(rows, 1):
            cells = "".join(
                cell_xml(f"{letters(j)}{i}", value, shared, inline) for j, value in enumerate(row)
            )
            body += f'<row r="{i}">{cells}</row>' if cells else ""
        parts.append(f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>')
    listing = "".join(
        f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1)
    )
    links = "".join(
        f'<Relationship Id="rId{i}" Type="{REL}/worksheet" Target="worksheets/sheet{i}.xml"/>'
        for i in range(1, len(sheets) + 1)
    )
    strings = "".join(f"<si><t>{escape(s)}</t></si>" for s in shared)
    styles = (
        f'<styleSheet xmlns="{MAIN}"><numFmts count="1"><numFmt numFmtId="170" formatCode="yyyy\\-mm"/>'
        '</numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/>'
        '<xf numFmtId="2"/></cellXfs></styleSheet>'
    )
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{listing}</sheets></workbook>')
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>',
        )
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{strings}</sst>')
        book.writestr("xl/styles.xml", styles)
        for i, part in enumerate(parts, 1):
            book.writestr(f"xl/worksheets/sheet{i}.xml", part)
