"""Text assembly on layout blocks: furniture, headings, and sections carried forward."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiremill.functions import text as T
from quiremill.limits import DEFAULT, Limits

#: Sections that are statements of a paragraph or two, and those that hold little evidence.
BOUNDED = ("abstract", "conclusions", "data_availability")
LOW_VALUE = ("references",)
FURNITURE_CHARS = 100


def running_lines(lines: DataFrame, limits: Limits = DEFAULT, group: str = "slug", page: str = "page") -> DataFrame:
    """A12. (group, text, pages): short lines that stand on ``running_header_min_pages`` pages or more."""
    short = lines.where((F.length("text") <= FURNITURE_CHARS) & (F.trim("text") != ""))
    return short.groupBy(group, "text").agg(F.count_distinct(page).alias("pages")).where(F.col("pages") >= limits.running_header_min_pages)


def without_furniture(lines: DataFrame, running: DataFrame, group: str = "slug") -> DataFrame:
    """T1. Lines with ``dropped_as``: furniture, page_number or null for what stays. Nothing leaves the table, so that drops can be counted."""
    mark = running.select(F.col(group), F.col("text"), F.lit(True).alias("_running"))
    j = lines.join(mark, [group, "text"], "left")
    return j.withColumn("dropped_as", F.when(F.col("_running"), "furniture").when(T.is_page_number(F.col("text")), "page_number")).drop("_running")


def top_running(running: DataFrame, n: int = 20) -> DataFrame:
    """S4."""
    return running.orderBy(F.desc("pages"), "text").limit(n)


def with_headings(blocks: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """T3 to T7. Known headings, headings split off glued paragraphs (one block becomes two), other headings, paragraphs; too short texts are marked ``dropped_as``."""
    text, known, glued = F.col("text"), T.section_of_heading(F.col("text")), T.glued_heading(F.col("text"))
    part = lambda kind, t, section, source: F.struct(F.lit(kind).alias("kind"), t.alias("text"), section.cast("string").alias("section"), F.lit(source).cast("string").alias("section_source"))
    none = F.lit(None)
    b = blocks.withColumn("_known", known).withColumn("_glued", glued)
    parts = (
        F.when(F.col("_known").isNotNull(), F.array(part("heading", text, F.col("_known"), "heading")))
        .when(F.col("_glued").isNotNull(), F.array(part("heading", F.col("_glued.heading"), F.col("_glued.section"), "heading"), part("paragraph", F.col("_glued.rest"), none, None)))
        .when(T.looks_like_heading(text), F.array(part("heading", text, none, None)))
        .otherwise(F.array(part("paragraph", text, none, None)))
    )
    rest = [c for c in blocks.columns if c not in ("kind", "text", "section", "section_source")]
    out = b.select(*rest, F.posexplode(parts).alias("part", "_p")).select(*rest, "part", "_p.*")
    return out.withColumn("dropped_as", F.when(F.length(F.trim("text")) < limits.min_paragraph_chars, "too_short"))


def carried_sections(blocks: DataFrame, limits: Limits = DEFAULT, group: str = "slug", order: str = "index") -> DataFrame:
    """W2. Adds ``carried``: the section of the last known heading, as windows over one shuffle.

    ``section`` holds a recognised section on headings and null elsewhere. A bounded section ends once ``max_bounded_section_chars`` have
    passed since its heading; from there it is abandoned and never opened again in that document. In low-value sections only headings
    and citation-like texts are labelled. ``refused`` tells why a label is missing: over_budget, abandoned or no_evidence.
    """
    doc = Window.partitionBy(group).orderBy(order)
    b = blocks.withColumn("_h", F.when(F.col("kind") == "heading", F.col("section")))
    b = b.withColumn("_run", F.sum(F.when(F.col("_h").isNotNull(), 1).otherwise(0)).over(doc.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(group, "_run").orderBy(order)
    b = b.withColumn("_sec", F.first("_h").over(run.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_rs", F.first(order).over(run.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.coalesce(F.sum(F.when(F.col("_h").isNull(), F.length("text")).otherwise(0)).over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    b = b.withColumn("_over", F.col("_h").isNull() & F.coalesce(F.col("_sec").isin(*BOUNDED), F.lit(False)) & (before > limits.max_bounded_section_chars))
    b = b.withColumn("_ab", F.min(F.when(F.col("_over"), F.col(order))).over(Window.partitionBy(group, "_sec")))
    abandoned = F.coalesce(F.col("_rs") > F.col("_ab"), F.lit(False))
    unseen = F.col("_sec").isin(*LOW_VALUE) & F.col("_h").isNull() & ~T.looks_like_citation(F.col("text"))
    why = F.when(F.col("_sec").isNull(), None).when(abandoned, "abandoned").when(F.col("_over"), "over_budget").when(unseen, "no_evidence")
    b = b.withColumn("refused", why).withColumn("carried", F.when(F.col("refused").isNull(), F.col("_sec")))
    return b.drop("_h", "_run", "_sec", "_rs", "_over", "_ab")


def text_status(blocks: DataFrame, limits: Limits = DEFAULT, group: str = "slug") -> DataFrame:
    """T9. Per document ok, garbled_text_encoding or no_text_scanned_pdf, from blocks with ``unnamed`` and ``glyphs`` counts."""
    a = blocks.groupBy(group).agg(F.sum("glyphs").alias("glyphs"), F.sum("unnamed").alias("unnamed"), F.sum(F.length("text")).alias("chars"))
    share = F.try_divide(F.col("unnamed"), F.col("glyphs"))
    return a.withColumn("status", F.when(share > limits.max_unnamed_glyph_fraction, "garbled_text_encoding").when(F.coalesce("chars", F.lit(0)) < limits.min_pdf_text_chars, "no_text_scanned_pdf").otherwise("ok"))
