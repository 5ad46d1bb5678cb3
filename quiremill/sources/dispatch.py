"""Files to blocks by what they are: sniffed, unpacked to a bounded depth, parsed; whatever fails has a status and is not fatal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiremill.limits import DEFAULT, Limits
from quiremill.operators import cards
from quiremill.sources import parsers, sheets

# What needs no parsing, by extension.
IMAGES = ("png", "jpg", "jpeg", "gif", "tif", "tiff", "svg", "bmp")
MEDIA = ("mp4", "mov", "avi", "mp3", "wav", "webm")
DATA = ("h5", "h5ad", "rds", "bam", "fastq", "gz", "npz")


def unpacked(files: DataFrame, limits: Limits = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """SC16, SC17, SC25. (files, skipped): archives are opened ``max_archive_depth`` times, their members are files named archive/member; an archive below that is skipped as too_deep. A bounded loop, whatever the files."""
    rest = files.select("path", "content")
    is_zip = lambda c: F.coalesce(F.hex(F.substring(c, 1, 4)) == "504B0304", F.lit(False)) & F.coalesce(parsers.zip_kind(c) == "zip", F.lit(False))
    out, skipped = [], []
    for _ in range(limits.max_archive_depth):
        marked = rest.withColumn("_zip", is_zip(F.col("content")))
        out.append(marked.where("not _zip").drop("_zip"))
        members = parsers.zip_members(marked.where("_zip"), limits)
        skipped.append(members.where("skip_reason is not null").select(F.concat_ws("/", "path", "member").alias("path"), "skip_reason"))
        rest = members.where("skip_reason is null").select(F.concat("path", F.lit("/"), "member").alias("path"), "content")
    marked = rest.withColumn("_zip", is_zip(F.col("content")))
    out.append(marked.where("not _zip").drop("_zip"))
    skipped.append(marked.where("_zip").select("path", F.lit("too_deep").alias("skip_reason")))
    both = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(both(frames[1:]))
    return both(out), both(skipped)


def kind_of(files: DataFrame) -> DataFrame:
    """SC18, SC19. Adds ext: by magic bytes and a ZIP's members first, then by the path's extension, then by how the bytes read."""
    named = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]{1,5})$", 1))
    sniffed = parsers.sniffed(F.col("content"), F.lit(None).cast("string"))
    magic = F.when(sniffed == "zip", F.coalesce(parsers.zip_kind("content"), F.lit("zip"))).when(~sniffed.isin("txt", "bin"), sniffed)
    return files.withColumn("ext", F.coalesce(magic, F.nullif(named, F.lit("")), sniffed))


def extracted(files: DataFrame, limits: Limits = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """SC19. (blocks, statuses) of files (path, content). blocks: path, index, kind, text, section, label, locator; statuses: path, ext, status, blocks.

    Each format has a branch of its own over the files of that kind. A file above ``max_file_mb`` is too_large, images, media and data have their own statuses, formats without a parser here (PDF among them) are unsupported_format, and
    what a parser can't read is parser_error.
    """
    f = kind_of(files).withColumn("_large", F.octet_length("content") > limits.max_file_mb << 20)
    ok, text = f.where("not _large"), F.decode("content", "UTF-8")
    item = lambda kind, t, section, label, locator: F.struct(F.lit(kind).alias("kind"), t.alias("text"), section.alias("section"), label.alias("label"), locator.alias("locator"))
    null = F.lit(None).cast("string")
    parsed = [ok.where(F.col("ext") == e).select("path", "ext", use("content").alias("b")) for e, use in (("xml", parsers.jats_blocks), ("docx", parsers.docx_blocks))]
    html = ok.where(F.col("ext").isin("html", "htm"))
    runs = parsers.html_blocks(html.select("path", text.alias("html")), "path", "html", limits).where("status = 'ok'")
    runs = runs.groupBy(F.col("slug").alias("path")).agg(F.transform(F.array_sort(F.collect_list(F.struct("index", "kind", "text"))), lambda x: F.struct(x["kind"].alias("kind"), x["text"].alias("text"), null.alias("section"), null.alias("label"), F.concat(F.lit("text "), x["index"].cast("string")).alias("locator"))).alias("b"))
    parsed.append(html.select("path", "ext").join(runs, "path", "left").withColumn("b", F.coalesce("b", F.array().cast(parsed[0].schema["b"].dataType))))
    plain = ok.where(F.col("ext") == "txt")
    paragraphs = parsers.paragraphs(plain.select("path", text.alias("text")), limits).groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("index", "text"))), lambda x: item("paragraph", x["text"], null, null, F.concat(F.lit("paragraph "), x["index"].cast("string")))).alias("b"))
    parsed.append(plain.select("path", "ext").join(paragraphs, "path", "left").withColumn("b", F.coalesce("b", F.array().cast(parsed[0].schema["b"].dataType))))
    book = ok.where(F.col("ext").isin("xlsx", "xls"))
    cells = sheets.xlsx_rows(book, limits)
    table = ok.where(F.col("ext").isin("csv", "tsv"))
    rows = cells.where("status = 'ok' and cells is not null").drop("status").unionByName(parsers.csv_rows(table, limits))
    found = cards.as_blocks(cards.cards(rows.select("source_file", "sheet", "row_no", "cells", "truncated"), limits))
    carded = found.groupBy(F.col("source_file").alias("path")).agg(F.array_sort(F.collect_list(item("table", F.col("text"), null, F.col("label"), F.col("locator")))).alias("b"))
    bad = cells.where("status <> 'ok'").groupBy(F.col("source_file").alias("path")).agg(F.min("status").alias("bad"))
    sheeted = book.unionByName(table).select("path", "ext").join(carded, "path", "left").join(bad, "path", "left")
    every = parsed[0].unionByName(parsed[1]).unionByName(parsed[2]).unionByName(parsed[3]).withColumn("bad", null).unionByName(sheeted.withColumn("b", F.when(F.col("bad").isNull(), F.coalesce("b", F.array().cast(parsed[0].schema["b"].dataType))).otherwise(F.col("b"))))
    blocks = every.select("path", F.posexplode("b").alias("index", "x")).select("path", "index", "x.*")
    status = F.when(F.col("b").isNull(), F.coalesce("bad", F.lit("parser_error"))).when(F.size("b") == 0, "no_text").otherwise("ok")
    read = every.select("path", "ext", status.alias("status"), F.coalesce(F.size("b"), F.lit(0)).alias("blocks"))
    seen = ("xml", "docx", "html", "htm", "txt", "xlsx", "xls", "csv", "tsv")
    other = f.where(F.col("_large") | ~F.col("ext").isin(*seen)).select(
        "path", "ext", F.when(F.col("_large"), "too_large").when(F.col("ext").isin(*IMAGES), "image_no_text").when(F.col("ext").isin(*MEDIA), "media_no_text").when(F.col("ext").isin(*DATA), "data_file_skipped").otherwise("unsupported_format").alias("status"), F.lit(0).alias("blocks")
    )
    return blocks, read.unionByName(other)
