"""One sheet of an .xlsx file, by the standard library: values as text, sheet row numbers kept."""

from __future__ import annotations

import io
import re
import zipfile
from datetime import datetime, time, timedelta
from xml.etree import ElementTree

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Cell styles that show a number as a date."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    codes = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iterfind(".//m:numFmts/m:numFmt", _NS)}
    shown = lambda n: 14 <= n <= 22 or bool(re.search("[dy]", re.sub(r'"[^"]*"|\[[^]]*\]|\\.', "", codes.get(n, "").lower())))
    return {i for i, x in enumerate(root.iterfind(".//m:cellXfs/m:xf", _NS)) if shown(int(x.get("numFmtId", 0)))}


def _date(serial: str) -> str:
    """The day that a serial number stands for (1900 system), with its time if it has one, as ISO text."""
    try:
        stamp = datetime(1899, 12, 30) + timedelta(seconds=round(float(serial) * 86400))
    except (ValueError, OverflowError):
        return serial
    return stamp.date().isoformat() if stamp.time() == time() else stamp.isoformat()


def read_sheet(data: bytes, sheet: str, expected: list[str]) -> list[dict]:
    """Rows below the header as dicts with _source_row_number; blank rows go; missing, unexpected or repeated headers raise."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = next((rels[s.get(_REL)] for s in book.iterfind(".//m:sheet", _NS) if s.get("name") == sheet), None)
        if target is None:
            raise ValueError(f"no sheet {sheet}")
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iterfind(".//m:t", _NS)) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", _NS)]
        day_styles = _date_styles(z)
        root = ElementTree.fromstring(z.read("xl/" + target.lstrip("/").removeprefix("xl/")))
    table: dict[int, dict[int, str]] = {}
    for row in root.iterfind(".//m:row", _NS):
        cells = table.setdefault(int(row.get("r")), {})
        for c in row.iterfind("m:c", _NS):
            v = c.find("m:v", _NS)
            value = "".join(t.text or "" for t in c.iterfind(".//m:t", _NS)) if c.get("t") == "inlineStr" else None if v is None else shared[int(v.text)] if c.get("t") == "s" else v.text
            if value is not None and c.get("t", "n") == "n" and int(c.get("s", 0)) in day_styles:
                value = _date(value)
            if value is not None and value.strip():
                cells[_column(c.get("r"))] = value
    header = {i: v.strip() for i, v in table.pop(1, {}).items()}
    if len(set(header.values())) != len(header) or set(header.values()) != set(expected):
        raise ValueError(f"headers {sorted(header.values())}, expected {sorted(expected)}")
    out = []
    for number, cells in sorted(table.items()):
        if cells:
            extra = {f"unnamed_column_{i + 1}": v for i, v in cells.items() if i not in header}
            out.append({name: cells.get(i) for i, name in header.items()} | extra | {"_source_row_number": number})
    return out
