"""The corpus as a whole: articles and their records, files, links, rollups over extractions, checks against a reference set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiremill import schemas
from quiremill.functions import text as T
from quiremill.vocab import TRUSTWORTHY

# Sections of a body, those that every body must have, marks of an author's manuscript, relations by which a record is a notice, open licences of addresses.
BODY_SECTIONS = ("abstract", "introduction", "results", "methods", "discussion")
REQUIRED_SECTIONS = ("methods", "results")
MANUSCRIPT_MARKS = ("published in final edited form as", "hhs public access", "europe pmc funders author manuscripts")
NOTICE_RELATIONS = ("erratum for", "retraction of", "correction of", "expression of concern for")
OPEN_CODES = ("OA", "F")
#: Share of labelled characters below which a body's labels are not trusted.
TRUSTED_COVERAGE = 0.75


def read_records(spark: SparkSession, paths, schema: str) -> DataFrame:
    """SC3, SC5, C11. One row per JSON file (path, and the fields of ``schema``); all fields are null where a file holds no such object, so that a broken record is seen and not fatal."""
    files = spark.read.text(paths, wholetext=True).withColumn("path", F.input_file_name())
    return files.select("path", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r")).select("path", "r.*")


def manifests(spark: SparkSession, paths) -> DataFrame:
    return read_records(spark, paths, schemas.MANIFEST)


def extractions(spark: SparkSession, paths) -> DataFrame:
    return read_records(spark, paths, schemas.EXTRACTION)


def labels(spark: SparkSession, paths) -> DataFrame:
    """C11. Label records; one without a slug is known by its file's stem."""
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return read_records(spark, paths, schemas.LABEL).withColumn("slug", F.coalesce("slug", stem))


def article_dirs(files: DataFrame, path: str = "path") -> DataFrame:
    """SC1. (directory, slug) of folders that hold a manifest."""
    found = files.where(F.element_at(F.split(path, "/"), -1) == "manifest.json").select(F.regexp_replace(path, "/[^/]*$", "").alias("directory")).distinct()
    return found.withColumn("slug", F.element_at(F.split("directory", "/"), -1))


def resolved(wanted: DataFrame, articles: DataFrame, column: str = "wanted") -> DataFrame:
    """SC2. Adds slug to each wanted DOI, slug or path; null if no article has it. articles: (slug, doi). A DOI wins over a slug."""
    doi = T.normalized_doi(F.col(column))
    name = F.element_at(F.split(F.regexp_replace(column, "/+$", ""), "/"), -1)
    asked = wanted.withColumn("_doi", doi).withColumn("_name", name)
    by_doi = articles.where("doi is not null").groupBy(F.col("doi").alias("_doi")).agg(F.min("slug").alias("_a"))
    by_slug = articles.select(F.col("slug").alias("_name"), F.col("slug").alias("_b")).distinct()
    return asked.join(by_doi, "_doi", "left").join(by_slug, "_name", "left").withColumn("slug", F.coalesce("_a", "_b")).select(*wanted.columns, "slug")


def doi_lines(lines: DataFrame, order: str, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """SC26. (dois, rejected): distinct DOIs with first place and mentions; lines that hold none, comments and blanks left out."""
    bare = lines.withColumn("_bare", F.trim(F.split_part(line, F.lit("#"), F.lit(1)))).where("_bare <> ''").withColumn("doi", T.normalized_doi(F.col("_bare")))
    good = bare.where("doi is not null").groupBy("doi").agg(F.min(order).alias("first_at"), F.count(F.lit(1)).alias("mentions"))
    return good, bare.where("doi is null").select(order, F.col("_bare").alias(line))


def fetch_complete(record_status: Column, paths: Column, existing: Column) -> Column:
    """FL9. Needs this article no further fetching? An evicted one does not; a complete one does if a file it names is gone."""
    there = F.forall(F.filter(F.coalesce(paths, F.array().cast("array<string>")), lambda p: p.isNotNull()), lambda p: F.array_contains(F.coalesce(existing, F.array().cast("array<string>")), p))
    return F.when(record_status == "evicted", True).when(record_status == "complete", there).otherwise(F.lit(False))


def worth_labelling(articles: DataFrame, readiness: DataFrame) -> DataFrame:
    """FL20. Articles whose readiness can be trusted."""
    return articles.join(readiness.where(F.col("state").isin(*TRUSTWORTHY)).select("slug").distinct(), "slug", "left_semi")


def section_coverage(blocks: DataFrame, declared: Column | None = None) -> DataFrame:
    """A8. Per article the share of labelled characters, body sections found and missing, and how far the labels can be trusted. declared: do they come from markup?"""
    n = F.length("text")
    b = blocks.withColumn("_n", n).withColumn("_declared", declared if declared is not None else F.lit(False))
    a = b.groupBy("slug").agg(
        F.count(F.lit(1)).alias("total_blocks"), F.count("section").alias("labelled_blocks"), F.sum("_n").alias("total_chars"), F.sum(F.when(F.col("section").isNotNull(), F.col("_n")).otherwise(0)).alias("labelled_chars"),
        F.collect_set("section").alias("_present"), F.max("_declared").alias("_declared"),
    )
    listed = lambda names: F.array(*map(F.lit, names))
    a = a.withColumn("coverage", F.when(F.col("total_chars") > 0, F.round(F.col("labelled_chars") / F.col("total_chars"), 2)).otherwise(0.0))
    a = a.withColumn("sections_found", F.array_sort(F.array_intersect("_present", listed(BODY_SECTIONS)))).withColumn("sections_missing", F.array_except(listed(REQUIRED_SECTIONS), "_present"))
    bodiless = F.size(F.array_intersect("_present", listed([s for s in BODY_SECTIONS if s != "abstract"]))) == 0
    trust = F.when(F.col("_declared"), "declared").when(bodiless, "none").when(F.size("sections_missing") > 0, "low").when(F.col("coverage") < TRUSTED_COVERAGE, "low").otherwise("ok")
    return a.withColumn("confidence", trust).drop("_present", "_declared")


def review_signals(cards: DataFrame) -> DataFrame:
    """A10. Per article: tables, and those that a person should look at. cards: (slug, header_confidence, header_row, truncated, columns_dropped)."""
    return cards.groupBy("slug").agg(
        F.count(F.lit(1)).alias("tables"), F.count_if(F.col("header_confidence") == "low").alias("header_low"), F.count_if(F.col("header_row").isNull()).alias("headerless"), F.count_if(F.coalesce("truncated", F.lit(False))).alias("truncated"),
        F.sum(F.coalesce("columns_dropped", F.lit(0))).alias("columns_dropped"),
    )


def census(files: DataFrame, group: str, kind: str) -> DataFrame:
    """A14. Per group a map from kind to its number; a null kind counts as none."""
    counted = files.groupBy(group, F.coalesce(F.col(kind), F.lit("none")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("census"))


def hyphen_tallies(text: Column) -> Column:
    """A16. STRUCT<kept, joined>: hyphens at line ends that stay (beside a digit or before a capital) and those that go."""
    kept, joined = r"(?<=\d)-\s*\n|-\s*\n\s*(?=[\d\p{Lu}])", r"(?<=\p{L})-\s*\n\s*(?=\p{Ll})"
    return F.struct(F.regexp_count(text, F.lit(kept)).alias("kept"), F.regexp_count(text, F.lit(joined)).alias("joined"))


def totals(blocks: DataFrame) -> DataFrame:
    """A18, C39. Per article: files, blocks, characters, tables, and its sections in order of name."""
    return blocks.groupBy("slug").agg(
        F.count_distinct("source_file").alias("files"), F.count(F.lit(1)).alias("blocks"), F.sum(F.length("text")).alias("chars"), F.count_if(F.col("kind") == "table").alias("tables"), F.array_sort(F.collect_set("section")).alias("sections")
    )


def listing(articles: DataFrame, limit: int, oldest: bool = False, size: str = "bytes", at: str = "fetched_at", name: str = "slug") -> DataFrame:
    """S3. The ``limit`` largest articles, or the ``limit`` oldest; ties by name."""
    return articles.orderBy(F.col(at).asc_nulls_first() if oldest else F.col(size).desc(), name).limit(limit)


def first_rows(rows: DataFrame, group: Sequence[str], order: str, cells: str, n: int = 3) -> DataFrame:
    """S5. The first ``n`` rows of each group that hold a value."""
    full = rows.where(F.exists(cells, lambda c: T.clean_cell(c).isNotNull()))
    return full.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(order))).where(F.col("_n") <= n).drop("_n")


def in_file_order(main: DataFrame, supplements: DataFrame, order: str = "file_no") -> DataFrame:
    """ST5. Blocks of an article's main text, then those of its supplements by their number, renumbered as ``index``."""
    both = main.withColumn("_place", F.lit(-1)).unionByName(supplements.withColumn("_place", F.col(order)), allowMissingColumns=True)
    return both.withColumn("index", (F.row_number().over(Window.partitionBy("slug").orderBy("_place", "index")) - 1).cast("int")).drop("_place")


def distinct_links(links: DataFrame, group: str, order: str, url: str = "url") -> DataFrame:
    """ST6. The first of links that differ in their fragment only."""
    w = Window.partitionBy(group, T.url_without_fragment(F.col(url))).orderBy(order)
    return links.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def lost(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """ST7. Distinct keys that would be lost if ``new`` took the place of ``old``."""
    return old.select(key).distinct().join(new.select(key), key, "left_anti")


def on_disk(entries: DataFrame, files: DataFrame, keys: Sequence[str] = ("slug", "path")) -> DataFrame:
    """J13. Manifest entries with the size of their file; status is missing where there is none, no_path where none is named."""
    held = files.select(*keys, F.col("bytes").alias("_held")).dropDuplicates(list(keys))
    out = entries.join(held, list(keys), "left")
    return out.withColumn("status", F.when(F.col(keys[-1]).isNull(), "no_path").when(F.col("_held").isNull(), "missing").otherwise("ok")).withColumnRenamed("_held", "bytes_held")


def corrected_doi(relations: Column) -> Column:
    """C24. The DOI that this record corrects: of the first relation (type, reference) whose type begins as a notice's does and whose reference holds a DOI."""
    named = F.filter(relations, lambda r: F.exists(F.array(*map(F.lit, NOTICE_RELATIONS)), lambda p: F.startswith(F.lower(F.trim(r["type"])), p)))
    found = F.transform(named, lambda r: F.lower(F.regexp_replace(F.regexp_extract(r["reference"], f"({T.DOI})", 1), r"[.,;)]+$", "")))
    return F.get(F.filter(found, lambda d: d != ""), F.lit(0))


def open_urls(entries: Column) -> Column:
    """C25. Addresses of PDFs that are marked open. entries: ARRAY<STRUCT<style, code, url>>."""
    fits = lambda e: (F.lower(e["style"]) == "pdf") & F.upper(e["code"]).isin(*OPEN_CODES) & (F.length(e["url"]) > 0)
    return F.transform(F.filter(F.coalesce(entries, F.array().cast("array<struct<style: string, code: string, url: string>>")), lambda e: F.coalesce(fits(e), F.lit(False))), lambda e: e["url"])


def session_expired(attempts: Column, tier: str = "proxy_browser") -> Column:
    """C35. Did the tier that needs a session find it expired? attempts: ARRAY<STRUCT<tier, status>>."""
    return F.coalesce(F.exists(attempts, lambda a: (a["tier"] == tier) & (a["status"] == "session_expired")), F.lit(False))


def looks_like_pdf(content: Column) -> Column:
    """C36. Do the bytes, white space before them aside, begin as a PDF does?"""
    return F.coalesce(F.decode(F.substring(content, 1, 1024), "ISO-8859-1").rlike(r"^[\s\x0b]*%PDF"), F.lit(False))


def rendition(opening: Column) -> Column:
    """X22. author_manuscript if the opening pages say so, else published."""
    low = F.lower(opening)
    return F.when(F.exists(F.array(*map(F.lit, MANUSCRIPT_MARKS)), lambda m: F.contains(low, m)), "author_manuscript").otherwise("published")


def alnum(text: Column) -> Column:
    """X23. Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def doi_tail(doi: Column) -> Column:
    """X23. What stands behind a DOI's first slash, as letters and digits."""
    return alnum(F.regexp_replace(T.normalized_doi(doi), "^[^/]*/", ""))


def identity_text(pages: DataFrame, key: str, ends: int = 2) -> DataFrame:
    """C22. The texts of a document's first and last ``ends`` pages, in order. pages: (key, page from 1, text)."""
    last = F.max("page").over(Window.partitionBy(key))
    kept = pages.withColumn("_last", last).where((F.col("page") <= ends) | (F.col("page") > F.col("_last") - ends))
    return kept.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda p: p["text"]), "\n").alias("text"))


def stored_entries(files: DataFrame, group: str, order: str, name: str, folder: str = "supplementary") -> DataFrame:
    """C27, SK4. Adds index (from 1) and path of each file as it is stored: its number before its safe name; with bytes and sha256 where there is content."""
    index = F.row_number().over(Window.partitionBy(group).orderBy(order))
    out = files.withColumn("index", index).withColumn("path", F.concat(F.lit(f"{folder}/"), T.ordinal_name(F.col("index"), F.col(name))))
    return out.withColumn("bytes", F.octet_length("content")).withColumn("sha256", F.sha2("content", 256)) if "content" in files.columns else out


def why_nothing_applied(pmcid: Column, n_open: Column, is_preprint: Column, tiers: Column, browser: str = "proxy_browser") -> Column:
    """C26. Why no tier could try an article: what tiers look for, and which there were."""
    hint = F.when(F.array_contains(tiers, browser), F.lit("")).otherwise(F.lit("; a browser tier, which needs none of these, is not among them"))
    known = F.concat(F.lit("pmcid="), F.coalesce(pmcid, F.lit("none")), F.lit(", open PDF addresses="), n_open.cast("string"), F.lit(", preprint="), F.when(is_preprint, "yes").otherwise("no"))
    return F.concat(F.lit("no tier could try this article ("), known, F.lit("); tiers: "), F.when(F.size(tiers) > 0, F.array_join(tiers, ", ")).otherwise(F.lit("none")), hint)


def checked(spec: DataFrame, record: DataFrame, files: DataFrame) -> DataFrame:
    """C7, C23. Checks (slug, check, ok, detail) of fetched articles against a reference set; ok is null where there is nothing to compare.

    spec: (slug, has_pdf, expected_status, files ARRAY<STRUCT<file, sha256, members ARRAY<STRING>>>); record: (slug, pdf_ok, status); files: (slug, sha256) of what was fetched, archive members among them.
    """
    universe = files.groupBy("slug").agg(F.collect_set("sha256").alias("held"))
    a = spec.join(record, "slug", "left").join(universe, "slug", "left").withColumn("held", F.coalesce("held", F.array().cast("array<string>"))).withColumn("files", F.coalesce("files", F.array().cast("array<struct<file: string, sha256: string, members: array<string>>>")))
    there = lambda f: F.array_contains(F.col("held"), f["sha256"]) | ((F.size(f["members"]) > 0) & (F.size(F.array_except(f["members"], F.col("held"))) == 0))
    missing = F.transform(F.filter("files", lambda f: ~F.coalesce(there(f), F.lit(False))), lambda f: f["file"])
    known = F.flatten(F.transform("files", lambda f: F.concat(F.array(f["sha256"]), F.coalesce(f["members"], F.array().cast("array<string>")))))
    a = a.withColumn("missing", missing).withColumn("extra", F.size(F.array_except("held", known)))
    pdf_ok = F.coalesce("pdf_ok", F.lit(False))
    tests = F.array(
        F.struct(F.lit("pdf_present").alias("check"), F.when(F.col("has_pdf"), pdf_ok).alias("ok"), F.when(pdf_ok, "fetched").otherwise("not fetched").alias("detail")),
        F.struct(F.lit("supplementary_status").alias("check"), F.when(F.col("expected_status").isNotNull(), F.coalesce(F.col("expected_status") == F.col("status"), F.lit(False))).alias("ok"), F.coalesce("status", F.lit("none")).alias("detail")),
        F.struct(F.lit("supplements_matched").alias("check"), (F.size("missing") == 0).alias("ok"), F.array_join("missing", ", ").alias("detail")),
        F.struct(F.lit("supplements_extra").alias("check"), F.lit(None).cast("boolean").alias("ok"), F.col("extra").cast("string").alias("detail")),
    )
    return a.select("slug", F.explode(tests).alias("t")).select("slug", "t.*")


def failures(checks: DataFrame) -> DataFrame:
    """C23. Failed checks only; what could not be checked is no failure."""
    return checks.where(F.col("ok").eqNullSafe(F.lit(False)))


def label_split(answers: DataFrame, partial: bool = False) -> tuple[DataFrame, DataFrame]:
    """SK7. (labels, refused): one record per article with its accessions in order; an article with a role left open is refused unless ``partial``. answers: (slug, pos, accession, role)."""
    a = answers.groupBy("slug").agg(F.count_if(F.col("role").isNull()).alias("open"), F.array_sort(F.collect_list(F.struct("pos", "accession", "role"))).alias("accessions"))
    a = a.withColumn("complete", F.col("open") == 0)
    return a if partial else a.where("complete"), a.where("not complete").select("slug", "open") if not partial else a.limit(0).select("slug", "open")


def summary_line(slug: Column, status: Column, files: Column, n_bytes: Column) -> Column:
    """SK8. One line on an article."""
    return F.concat(slug, F.lit("  "), F.coalesce(status, F.lit("no_manifest")), F.lit("  files="), files.cast("string"), F.lit("  "), T.human_bytes(n_bytes))


def candidates_outside(blocks: DataFrame, excluded: Sequence[str] = ("references",)) -> DataFrame:
    """C14. Blocks in which identifiers are looked for: reference lists are not the article's own words."""
    return blocks.where(~F.coalesce(F.col("section").isin(*excluded), F.lit(False)))


def iso_utc(ts: Column) -> Column:
    """Date/time: a moment as ISO 8601 in UTC, to the second."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
