"""Workbooks built here, strict and transitional, and files of all kinds dispatched to their parsers."""

import io
import zipfile

import pytest

from quiremill.limits import Limits
from quiremill.operators import cards, corpus
from quiremill.sources import dispatch, sheets

MAIN = {False: "http://schemas.openxmlformats.org/spreadsheetml/2006/main", True: "http://purl.oclc.org/ooxml/spreadsheetml/main"}


def workbook(tables, strict=False):
    """A workbook of {name: rows}; strings are shared, numbers plain, a date has style 1."""
    shared, out = [], io.BytesIO()

    def cell(ref, v):
        if v is None:
            return ""
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, tuple):
            return f'<c r="{ref}" s="1"><v>{v[0]}</v></c>'
        if isinstance(v, str):
            shared.append(v)
            return f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>'
        return f'<c r="{ref}"><v>{v}</v></c>'

    ns = MAIN[strict]
    parts = {}
    for i, rows in enumerate(tables.values()):
        body = "".join(f'<row r="{n + 1}">' + "".join(cell(f"{chr(65 + k)}{n + 1}", v) for k, v in enumerate(r)) + "</row>" for n, r in enumerate(rows) if r)
        parts[f"xl/worksheets/sheet{i + 1}.xml"] = f'<worksheet xmlns="{ns}"><sheetData>{body}</sheetData></worksheet>'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts["xl/workbook.xml"] = f'<workbook xmlns="{ns}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(tables)) + "</sheets></workbook>"
    parts["xl/_rels/workbook.xml.rels"] = '<Relationships xmlns="x">' + "".join(f'<Relationship Id="rId{i + 1}" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(tables))) + "</Relationships>"
    parts["xl/sharedStrings.xml"] = f'<sst xmlns="{ns}">' + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>"
    parts["xl/styles.xml"] = f'<styleSheet xmlns="{ns}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


BOOK = {"Data": [["Table 1"], ["Gene", "Score", "Day", "Good"], ["a", 1.5, (44927,), True], ["b", 2.0, (44928,), False], ["a", None, None, True]], "Two": [["A", "B"], ["x", 1], ["y", 2], None, ["A", "B"], ["z", 3]], "Empty": []}


@pytest.mark.parametrize("strict", [False, True])
def test_xlsx(spark, strict):
    files = spark.createDataFrame([("f.xlsx", bytearray(workbook(BOOK, strict))), ("bad.xlsx", bytearray(b"PK\x03\x04no"))], "path string, content binary")
    rows = sheets.xlsx_rows(files)
    got = {(r.sheet, r.row_no): r.cells for r in rows.where("source_file = 'f.xlsx' and cells is not null").collect()}
    assert got[("Data", 2)] == ["a", "1.5", "2023-01-01T00:00:00", "True"] and got[("Data", 3)][1] == "2" and got[("Two", 3)] == []
    assert [r.status for r in rows.where("source_file = 'bad.xlsx'").collect()] == ["unreadable"]
    capped = sheets.xlsx_rows(files, Limits(max_scan_rows=2)).where("sheet = 'Data'").collect()
    assert len(capped) == 2 and capped[0].truncated and capped[0].n_rows_total == 5
    c = {(r.sheet, r.part): r for r in cards.cards(rows.where("cells is not null")).collect()}
    assert set(c) == {("Data", 0), ("Two", 0), ("Two", 1)}
    d = c[("Data", 0)]
    assert (d.caption, d.header, d.header_row, d.header_confidence, d.n_rows) == ("Table 1", ["Gene", "Score", "Day", "Good"], 1, "high", 3)
    assert d["columns"][0]["values"] == ["a", "b"] and d["columns"][1]["max"] == 2.0 and d["columns"][2]["dtype"] == "date" and d.data_ref.first_data_row == 3
    t = c[("Two", 1)]
    assert (t.n_rows, t.data_ref.header_row, t.data_ref.first_data_row) == (1, 5, 6)
    forced = spark.createDataFrame([("f.xlsx", "Data", 0, None)], "source_file string, sheet string, part int, header_row int")
    f = cards.cards(rows.where("cells is not null"), forced=forced).where("sheet = 'Data'").first()
    assert f.header_confidence == "confirmed" and f.header == ["column_1", "column_2", "column_3", "column_4"] and f.n_rows == 5
    behind = cards.rows_behind(cards.cards(rows.where("cells is not null")), rows).where("sheet = 'Two' and part = 1").collect()
    assert sorted((r.row, r.cells[0], r.is_header) for r in behind) == [(5, "A", True), (6, "z", False)]


def test_dispatch(spark):
    inner, outer, deep = io.BytesIO(), io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("n.txt", "In the archive.\n\nSecond paragraph.")
    with zipfile.ZipFile(deep, "w") as z:
        z.writestr("inner.zip", inner.getvalue())
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("a.csv", "g,v\nx,1\ny,2\n")
        z.writestr("deep.zip", deep.getvalue())
        z.writestr("../evil.txt", "x")
    page = "<head><meta name='citation_title' content='T'></head><nav>Menu " + "m" * 90 + "</nav><p>" + "words " * 30 + "</p>"
    jats = "<article><body><sec sec-type='methods'><title>Methods</title><p>We did.</p></sec></body></article>"
    files = spark.createDataFrame([("w.xlsx", bytearray(workbook(BOOK))), ("z.zip", bytearray(outer.getvalue())), ("p.html", bytearray(page.encode())), ("x.xml", bytearray(jats.encode())), ("x2.xml", bytearray(b"<article><p>")), ("i.png", bytearray(b"\x89PNG....")), ("d.pdf", bytearray(b"%PDF-1.7")), ("old.xls", bytearray(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"))], "path string, content binary")
    flat, skipped = dispatch.unpacked(files)
    assert {(r.path, r.skip_reason) for r in skipped.collect()} == {("z.zip/../evil.txt", "unsafe"), ("z.zip/deep.zip/inner.zip", "too_deep")}
    blocks, statuses = dispatch.extracted(flat)
    got = {r.path: (r.ext, r.status, r.blocks) for r in statuses.collect()}
    assert got["w.xlsx"] == ("xlsx", "ok", 3) and got["z.zip/a.csv"] == ("csv", "ok", 1) and got["x.xml"] == ("xml", "ok", 2) and got["x2.xml"][1] == "parser_error"
    assert got["i.png"][1] == "image_no_text" and got["d.pdf"][1] == "unsupported_format" and got["old.xls"][1] in ("unsupported_format", "unreadable", "ok")
    assert got["p.html"] == ("html", "ok", 2)
    texts = {r.path: [] for r in blocks.collect()}
    for r in blocks.orderBy("path", "index").collect():
        texts[r.path].append(r.text)
    assert texts["p.html"][0] == "citation_title: T" and "Menu" not in "".join(texts["p.html"]) and texts["x.xml"] == ["Methods", "We did."]


def test_records_of_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    (tmp_path / "a/manifest.json").write_text('{"doi": "10.1/x", "slug": "a", "status": "complete",\n "supplementary": [{"path": "s1"}]}')
    (tmp_path / "b/manifest.json").write_text("{broken")
    got = {r.path.split("/")[-2]: (r.slug, r.status) for r in corpus.manifests(spark, str(tmp_path / "*/manifest.json")).collect()}
    assert got == {"a": ("a", "complete"), "b": (None, None)}
    (tmp_path / "paper one.json").write_text('{"complete": true, "accessions": []}')
    assert [r.slug for r in corpus.labels(spark, str(tmp_path / "*.json")).collect()][0].replace("%20", " ") == "paper one"
