"""Parsers that Spark has no reader for, over columns of bytes or text: HTML, JATS, DOCX, CSV, ZIP, plain text."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections import Counter
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from quiremill.functions import text as T
from quiremill.limits import DEFAULT, Limits

TEXT = StringType()
BLOCK = ArrayType(StructType().add("kind", TEXT).add("text", TEXT).add("section", TEXT).add("label", TEXT).add("locator", TEXT))
# Elements whose text is no run, those that end a run, and the beginnings of the names of wanted meta tags.
_SKIP = frozenset("script style noscript svg template head nav footer form select button iframe".split())
_BREAK = frozenset("p div section article li td th tr h1 h2 h3 h4 h5 h6 blockquote dd dt figcaption br table ul ol main span".split())
_META = ("citation_", "dc.", "og:", "prism.", "twitter:description")
#: The start of a run by which repeats are known.
SAME_START = 200


class _Runs(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.named, self.runs, self.now, self.skip = {}, [], [], 0

    def _end(self):
        line = " ".join("".join(self.now).split())
        if line:
            self.runs.append(line)
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag == "meta":
            a = {k: (v or "").strip() for k, v in attrs}
            name = a.get("name") or a.get("property") or ""
            if name.lower().startswith(_META) and a.get("content"):
                self.named.setdefault(name, {})[a["content"]] = None
        elif tag in _SKIP or tag in _BREAK:
            self._end()
            self.skip += tag in _SKIP

    def handle_endtag(self, tag):
        if tag in _SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag in _BREAK:
            self._end()

    def handle_data(self, data):
        if not self.skip:
            self.now.append(data)

    @property
    def metas(self):
        """A line for each name in order; its values once each, in theirs."""
        return [f"{name}: {'; '.join(self.named[name])}" for name in sorted(self.named)]


@F.pandas_udf(StructType().add("metas", ArrayType(TEXT)).add("runs", ArrayType(TEXT)))
def html_runs(pages: pd.Series) -> pd.DataFrame:
    """SC14. Wanted meta tags and text runs of pages, menus, footers, forms and heads left out."""
    out = []
    for page in pages:
        p = _Runs()
        p.feed(page or "")
        p.close()
        p._end()
        out.append((p.metas, p.runs))
    return pd.DataFrame(out, columns=["metas", "runs"])


def html_blocks(pages: DataFrame, key: str, html: str, limits: Limits = DEFAULT) -> DataFrame:
    """SC14, FL18. Blocks (slug, index, kind, text, chars, status): one of metadata, then runs of ``min_html_block_chars`` or more, the first of those that begin alike.

    A page without metadata and with less than ``min_landing_chars`` of text has status no_text: it is but a passing page.
    """
    p = pages.select(F.col(key).alias("slug"), html_runs(html).alias("h"))
    meta = F.when(F.size("h.metas") > 0, F.array(F.struct(F.lit("metadata").alias("kind"), F.array_join("h.metas", "\n").alias("text")))).otherwise(F.array().cast("array<struct<kind: string, text: string>>"))
    runs = F.transform("h.runs", lambda r: F.struct(F.lit("paragraph").alias("kind"), r.alias("text")))
    b = p.select("slug", (F.size("h.metas") > 0).alias("has_meta"), F.posexplode(F.concat(meta, runs)).alias("index", "b")).select("slug", "has_meta", "index", "b.*").withColumn("chars", F.length("text"))
    b = b.where((F.col("kind") == "metadata") | (F.col("chars") >= limits.min_html_block_chars))
    same = Window.partitionBy("slug", "kind", F.left("text", F.lit(SAME_START))).orderBy("index")
    b = b.withColumn("_n", F.row_number().over(same)).where("_n = 1").drop("_n")
    total = F.sum(F.when(F.col("kind") == "paragraph", F.col("chars")).otherwise(0)).over(Window.partitionBy("slug"))
    return b.withColumn("status", F.when(~F.col("has_meta") & (total < limits.min_landing_chars), "no_text").otherwise("ok")).drop("has_meta")


def sniffed(content: Column, content_type: Column) -> Column:
    """SC18. An extension by magic bytes, then declared type, then share of printable characters; of a ZIP, see ``zip_kind``."""
    head = F.substring(content, 1, 8)
    starts = lambda b: F.hex(head).startswith(b.hex().upper())
    printable = F.length(F.regexp_replace(F.decode(F.substring(content, 1, 2048), "ISO-8859-1"), r"[^\x09\x0A\x0D\x20-\x7E\x80-\xFF]", "")) / F.greatest(F.length(F.substring(content, 1, 2048)), F.lit(1))
    magic = (
        F.when(starts(b"%PDF"), "pdf").when(starts(b"PK\x03\x04"), "zip").when(starts(b"\xd0\xcf\x11\xe0"), "xls").when(starts(b"\x89PNG"), "png").when(starts(b"\xff\xd8\xff"), "jpg").when(starts(b"GIF8"), "gif").when(starts(b"\x1f\x8b"), "gz")
    )
    types = {"application/pdf": "pdf", "text/csv": "csv", "text/tab-separated-values": "tsv", "text/html": "html", "application/xml": "xml", "text/xml": "xml", "text/plain": "txt"}
    declared = F.try_element_at(F.create_map(*(F.lit(x) for kv in types.items() for x in kv)), F.lower(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1)))))
    return F.coalesce(magic, declared, F.when(printable > 0.9, "txt"), F.lit("bin"))


@F.pandas_udf(TEXT)
def zip_kind(contents: pd.Series) -> pd.Series:
    """SC18. xlsx, docx or zip by a ZIP's members; null if it can't be read."""

    def one(b):
        try:
            names = zipfile.ZipFile(io.BytesIO(b)).namelist()
        except (zipfile.BadZipFile, TypeError, OSError):
            return None
        return "xlsx" if any(n.startswith("xl/") for n in names) else "docx" if any(n.startswith("word/") for n in names) else "zip"

    return contents.map(one)


def zip_members(files: DataFrame, limits: Limits = DEFAULT, allowed: tuple[str, ...] = ("pdf", "csv", "tsv", "xlsx", "xls", "docx", "txt", "html", "xml", "zip")) -> DataFrame:
    """SC16, SC17, SC25. files: (path, content). One row per member: path, member, size, content or skip_reason (unsafe, extension, too_large, over_cap, unreadable). Nested archives are rows for another round, ``max_archive_depth`` of them at most."""

    def read(frames):
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    z = zipfile.ZipFile(io.BytesIO(content))
                    infos = [i for i in z.infolist() if not i.is_dir()]
                except (zipfile.BadZipFile, TypeError, OSError):
                    out.append((path, None, None, None, "unreadable"))
                    continue
                taken = 0
                for i in infos:
                    name, ext = i.filename.replace("\\", "/"), i.filename.rpartition(".")[2].lower()
                    bad = name.startswith("/") or ".." in name.split("/") or any(p.startswith(".") or p == "__MACOSX" for p in name.split("/"))
                    why = "unsafe" if bad else "extension" if ext not in allowed else "too_large" if i.file_size > limits.max_member_mb << 20 else "over_cap" if taken >= limits.max_archive_members else None
                    body = None
                    if why is None:
                        try:
                            body = z.read(i)
                            taken += 1
                        except (zipfile.BadZipFile, RuntimeError, OSError):
                            why = "unreadable"
                    out.append((path, name, i.file_size, body, why))
            yield pd.DataFrame(out, columns=["path", "member", "size", "content", "skip_reason"])

    return files.select("path", "content").mapInPandas(read, "path string, member string, size long, content binary, skip_reason string")


def csv_rows(files: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """SC6. files: (path, content). Rows (source_file, sheet, row_no, cells, n_rows_total, truncated) of delimited text: the delimiter is sniffed over the first 8192 characters, rows are capped, the count of non-blank rows is exact."""

    def read(frames):
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                text = bytes(content or b"").decode("utf-8-sig", "replace")
                try:
                    delimiter = csv.Sniffer().sniff(text[:8192], ",\t;|").delimiter
                except csv.Error:
                    delimiter = "\t" if "\t" in text[:8192] else ","
                kept, total = [], 0
                for row in csv.reader(io.StringIO(text), delimiter=delimiter):
                    total += any(c.strip() for c in row)
                    if len(kept) < limits.max_scan_rows:
                        kept.append([c if c.strip() else None for c in row[: limits.max_columns]])
                if kept:
                    yield pd.DataFrame({"source_file": path, "sheet": "csv", "row_no": range(len(kept)), "cells": kept, "n_rows_total": total, "truncated": total > sum(any(r) for r in kept)})

    return files.select("path", "content").mapInPandas(read, "source_file string, sheet string, row_no int, cells array<string>, n_rows_total int, truncated boolean")


def plain_text_shape(files: DataFrame) -> DataFrame:
    """SC15, A17. files: (path, text). Is a text a table? Of its first 50 non-blank lines 70 % or more hold the same number (one at least) of tabs, commas or semicolons, tried in this order."""

    @F.pandas_udf(TEXT)
    def delimiter(texts: pd.Series) -> pd.Series:
        def one(t):
            lines = [x for x in (t or "").splitlines() if x.strip()][:50]
            for d in "\t,;":
                counts = Counter(x.count(d) for x in lines)
                if len(lines) >= 2 and (top := counts.most_common(1)[0])[0] >= 1 and top[1] >= 0.7 * len(lines):
                    return d
            return None

        return texts.map(one)

    return files.withColumn("delimiter", delimiter("text")).withColumn("is_table", F.col("delimiter").isNotNull())


def paragraphs(files: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """SC15. files: (path, text). Paragraphs between blank lines, cut at ``max_paragraph_chars`` with the number of characters cut."""
    p = files.select("path", F.posexplode(F.split("text", r"\n\s*\n")).alias("index", "text")).withColumn("text", T.collapsed(F.col("text"))).where(F.length("text") >= limits.min_paragraph_chars)
    return p.withColumn("chars_cut", F.greatest(F.length("text") - limits.max_paragraph_chars, F.lit(0))).withColumn("text", F.left("text", F.lit(limits.max_paragraph_chars)))


def _name(element) -> str:
    return element.tag.rpartition("}")[2] if isinstance(element.tag, str) else ""


def _inline(element, cells: bool = False) -> str:
    """Text of an element; citations are left out of prose, block children of a cell are parted by semicolons."""
    parts = [element.text or ""]
    for x in element:
        if not (_name(x) == "xref" and x.get("ref-type") == "bibr" and not cells):
            inner = _inline(x, cells)
            parts.append(f"; {inner}" if cells and _name(x) in ("p", "list", "list-item", "break") and "".join(parts).strip() else inner)
        parts.append(x.tail or "")
    return "".join(parts)


@F.pandas_udf(BLOCK)
def jats_blocks(contents: pd.Series) -> pd.Series:
    """SC12. Blocks of JATS XML in document order: headings, paragraphs, captions and tables, with sec-type or heading and an XPath; reference lists are left out. Null if it is no XML."""

    def one(content):
        text = bytes(content).decode("utf-8", "replace") if isinstance(content, (bytes, bytearray, memoryview)) else content or ""
        text = re.sub(r"<!DOCTYPE[^>\[]*(\[.*?\])?\s*>", "", text, flags=re.S)
        text = re.sub(r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#x[0-9A-Fa-f]+);)(\w+);", lambda m: __import__("html").unescape(m.group()).replace("&", "&amp;"), text)
        try:
            root = ElementTree.fromstring(text.encode())
        except ElementTree.ParseError:
            return None
        out, stack = [], [(root, f"/{_name(root)}", None)]
        while stack:
            e, path, section = stack.pop()
            name, line = _name(e), " ".join(_inline(e).split()) if _name(e) in ("title", "p", "article-title") else ""
            if name in ("ref-list", "xref"):
                continue
            if name == "sec":
                section = e.get("sec-type") or " ".join("".join(_inline(t)) for t in e if _name(t) == "title").strip() or section
            elif name == "abstract":
                section = "abstract"
            if line:
                out.append({"kind": "heading" if name == "title" else "metadata" if name == "article-title" else "paragraph", "text": line, "section": section, "label": None, "locator": path})
                continue
            if name in ("table-wrap", "fig", "supplementary-material"):
                label = next((" ".join(_inline(x).split()) for x in e.iter() if _name(x) == "label"), None)
                caption = " ".join(" ".join(_inline(x).split()) for x in e.iter() if _name(x) == "caption")
                if caption:
                    out.append({"kind": "caption", "text": caption, "section": section, "label": label, "locator": path})
                rows = [" | ".join(" ".join(_inline(c, True).split()) for c in r if _name(c) in ("td", "th")) for r in e.iter() if _name(r) == "tr"]
                if rows:
                    out.append({"kind": "table", "text": "\n".join(rows), "section": section, "label": label, "locator": path})
                continue
            seen, below = Counter(), []
            for x in e:
                seen[_name(x)] += 1
                below.append((x, f"{path}/{_name(x)}[{seen[_name(x)]}]", section))
            stack += reversed(below)
        return out

    return contents.map(one)


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


@F.pandas_udf(BLOCK)
def docx_blocks(contents: pd.Series) -> pd.Series:
    """SC11. Paragraphs, headings and tables of a DOCX in body order; deleted text and field codes are left out. Null if it can't be read."""

    def line(p):
        return " ".join("".join((x.text or "") if x.tag == f"{_W}t" else "\t" if x.tag == f"{_W}tab" else "" for x in p.iter()).split())

    def one(content):
        try:
            root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml"))
        except (zipfile.BadZipFile, KeyError, TypeError, OSError, ElementTree.ParseError):
            return None
        out = []
        for i, e in enumerate(root.find(f"{_W}body") if root.find(f"{_W}body") is not None else []):
            if e.tag == f"{_W}p" and (text := line(e)):
                style = e.find(f"{_W}pPr/{_W}pStyle")
                head = style is not None and re.match(r"(?i)heading|title", style.get(f"{_W}val") or "")
                out.append({"kind": "heading" if head else "paragraph", "text": text, "section": None, "label": None, "locator": f"body {i}"})
            elif e.tag == f"{_W}tbl":
                rows = [" | ".join(" ".join(line(p) for p in c.iter(f"{_W}p")).strip() for c in r.iter(f"{_W}tc")) for r in e.iter(f"{_W}tr")]
                out.append({"kind": "table", "text": "\n".join(rows), "section": None, "label": None, "locator": f"body {i}"})
        return out

    return contents.map(one)
