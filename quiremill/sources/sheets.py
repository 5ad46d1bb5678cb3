"""Workbooks without a library: XLSX is a ZIP of XML, strict or transitional; old XLS needs xlrd and is unsupported without it."""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

from quiremill.limits import DEFAULT, Limits

ROWS = "source_file string, sheet string, row_no int, cells array<string>, n_rows_total int, truncated boolean, status string"
# The built-in number formats that show dates or times.
DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))
_EPOCH = datetime.datetime(1899, 12, 30)


def _local(tag: str) -> str:
    """SC8. A name without its namespace, so that strict and transitional files read alike."""
    return tag.rpartition("}")[2]


def _root(z: zipfile.ZipFile, name: str):
    return ElementTree.fromstring(z.read(name)) if name in z.namelist() else None


def _text(element) -> str:
    return "".join(x.text or "" for x in element.iter() if _local(x.tag) == "t")


def _shared(z: zipfile.ZipFile) -> list[str]:
    root = _root(z, "xl/sharedStrings.xml")
    return [_text(x) for x in root if _local(x.tag) == "si"] if root is not None else []


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    root, custom, out = _root(z, "xl/styles.xml"), {}, set()
    if root is None:
        return out
    for part in root:
        if _local(part.tag) == "numFmts":
            custom = {int(x.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]', "", x.get("formatCode") or "") for x in part}
        elif _local(part.tag) == "cellXfs":
            for i, x in enumerate(part):
                n = int(x.get("numFmtId") or 0)
                if n in DATE_FORMATS or re.search("[ymdhs]", custom.get(n, ""), re.I):
                    out.add(i)
    return out


def _sheets(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, member) of the sheets in order."""
    rels = {x.get("Id"): x.get("Target") for x in _root(z, "xl/_rels/workbook.xml.rels")}
    out = []
    for x in _root(z, "xl/workbook.xml").iter():
        if _local(x.tag) == "sheet":
            rid = next(v for k, v in x.attrib.items() if _local(k) == "id")
            target = rels[rid]
            out.append((x.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return out


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _value(cell, shared: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return _text(cell) or None
    v = next((x.text for x in cell if _local(x.tag) == "v"), None)
    if v is None:
        return None
    if kind == "s":
        return shared[int(v)]
    if kind == "b":
        return "True" if v == "1" else "False"
    if kind is None and int(cell.get("s") or 0) in dates:
        at = _EPOCH + datetime.timedelta(days=float(v))
        return (at + datetime.timedelta(microseconds=500)).replace(microsecond=0).isoformat()
    return re.sub(r"\.0+$", "", v) if kind is None else v


def sheet_rows(content: bytes, limits: Limits = DEFAULT) -> Iterator[tuple[str, list[list[str | None]], int, bool, str]]:
    """(sheet, rows, rows with a value, truncated, status) of each sheet; rows beyond ``max_scan_rows`` are counted only, and a sheet that can't be read is told and not fatal."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared, dates = _shared(z), _date_styles(z)
        for name, member in _sheets(z)[: limits.max_sheets]:
            kept: list[list[str | None]] = []
            total = full = 0
            try:
                with z.open(member) as f:
                    for _, e in ElementTree.iterparse(f):
                        if _local(e.tag) != "row":
                            continue
                        at = int(e.get("r") or len(kept) + 1) - 1
                        cells: list[str | None] = []
                        for i, c in enumerate(x for x in e if _local(x.tag) == "c"):
                            k = _column(c.get("r")) if c.get("r") else i
                            if k < limits.max_columns + 50:
                                cells += [None] * (k + 1 - len(cells))
                                cells[k] = _value(c, shared, dates)
                        has = any(x is not None and x.strip() for x in cells)
                        total += has
                        if at < limits.max_scan_rows:
                            kept += [[] for _ in range(at - len(kept))]
                            kept.append(cells)
                            full += has
                        e.clear()
                yield name, kept, total, total > full, "ok"
            except (ElementTree.ParseError, KeyError, ValueError, IndexError):
                yield name, [], 0, False, "parser_error"


def xlsx_rows(files: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """SC7, SC8, SC10. files: (path, content). Rows of all sheets; a file or sheet without rows gives one with its status (ok, parser_error, unreadable, unsupported_format for an old XLS without xlrd, SC9)."""

    def read(frames):
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                raw = bytes(content or b"")
                try:
                    if raw[:4] == b"\xd0\xcf\x11\xe0":
                        found = list(_xls(raw, limits))
                    else:
                        found = list(sheet_rows(raw, limits))
                except (zipfile.BadZipFile, KeyError, TypeError, AttributeError, ElementTree.ParseError, StopIteration):
                    found = [(None, [], 0, False, "unreadable")]
                for name, kept, total, cut, status in found:
                    n = max(1, len(kept))
                    yield pd.DataFrame({"source_file": [path] * n, "sheet": [name] * n, "row_no": list(range(n)) if kept else [None], "cells": kept or [None], "n_rows_total": [total] * n, "truncated": [cut] * n, "status": [status] * n})

    return files.select("path", "content").mapInPandas(read, ROWS)


def _xls(content: bytes, limits: Limits):
    """SC9."""
    try:
        import xlrd
    except ImportError:
        yield None, [], 0, False, "unsupported_format"
        return
    book = xlrd.open_workbook(file_contents=content)
    for sheet in book.sheets()[: limits.max_sheets]:
        rows = [[str(v) if v != "" else None for v in sheet.row_values(i)] for i in range(min(sheet.nrows, limits.max_scan_rows))]
        yield sheet.name, rows, sum(any(x is not None for x in r) for r in rows), sheet.nrows > limits.max_scan_rows, "ok"
