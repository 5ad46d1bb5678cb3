"""Cards: what a sheet's tables hold, assembled from header, names, profiles and samples; and the rows behind a card."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiremill.functions.text import clean_cell
from quiremill.limits import DEFAULT, Limits
from quiremill.operators import corpus, tables

SHEET = tables.SHEET


def fitted(cells: Column, width: Column) -> Column:
    """C33. A row's cells cut or filled with nulls to ``width``."""
    return F.slice(F.concat(F.transform(cells, clean_cell), F.array_repeat(F.lit(None).cast("string"), width)), F.lit(1), width)


def parted(rows: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """C2. Rows with the part of their sheet: its number, start and row count from there (``row_no`` stays absolute); rows between parts go, as do parts beyond ``max_tables_per_sheet`` (counted in ``tables_skipped``)."""
    found = tables.panels(rows)
    found = found.withColumn("tables_skipped", F.greatest(F.count(F.lit(1)).over(Window.partitionBy(*SHEET)) - limits.max_tables_per_sheet, F.lit(0))).where(F.col("panel") < limits.max_tables_per_sheet)
    listed = found.groupBy(*SHEET).agg(F.collect_list(F.struct("panel", "start", "end")).alias("_parts"), F.max("tables_skipped").alias("tables_skipped"))
    r = rows.join(listed, list(SHEET), "left")
    mine = F.get(F.filter("_parts", lambda p: (F.col("row_no") >= p["start"]) & (F.col("row_no") < p["end"])), F.lit(0))
    r = r.withColumn("_p", mine).where("_parts is null or _p is not null")
    return r.withColumn("part", F.coalesce("_p.panel", F.lit(0))).withColumn("start", F.coalesce("_p.start", F.lit(0))).drop("_p", "_parts").withColumn("tables_skipped", F.coalesce("tables_skipped", F.lit(0)))


def cards(rows: DataFrame, limits: Limits = DEFAULT, forced: DataFrame | None = None) -> DataFrame:
    """C1, C2. One card per table of a sheet. rows: (source_file, sheet, row_no from 0, cells, and truncated if known).

    The header is detected in each part, or forced (source_file, sheet, part, header_row from 0 or null for none), which confirms it. A sparse row above it is joined onto it. Names are made unique, columns beyond
    ``max_columns`` dropped and counted, rows without a value skipped, columns profiled, and empty ones at the right end cut off. A column that holds its own name puts the header in doubt. Rows in ``first_data_row`` and so on
    are absolute and count from 1. A sheet without any value gives no card.
    """
    key = [*SHEET, "part"]
    r = parted(rows if "truncated" in rows.columns else rows.withColumn("truncated", F.lit(False)), limits).withColumn("at", F.col("row_no") - F.col("start"))
    head = tables.detected_headers(r.select(*key, F.col("at").alias("row_no"), "cells"), limits, key).where("width > 0")
    if forced is not None:
        f = forced.select(*key, F.col("header_row").alias("_row"), F.lit(True).alias("_forced"))
        head = head.join(f, key, "left").withColumn("header_row", F.when(F.col("_forced"), F.col("_row")).otherwise(F.col("header_row")))
        head = head.withColumn("header_confidence", F.when(F.col("_forced"), "confirmed").otherwise(F.col("header_confidence"))).drop("_row")
    else:
        head = head.withColumn("_forced", F.lit(None).cast("boolean"))
    span = r.groupBy(*key).agg(F.max(F.size("cells")).alias("cols"), F.max("truncated").alias("truncated"), F.max("tables_skipped").alias("tables_skipped"), F.max("at").alias("_last"), F.min("start").alias("start"))
    h = head.drop("header").join(span, key)
    lines = r.join(h.select(*key, "header_row", "cols"), key)
    named = lines.where(F.col("at").between(F.col("header_row") - 1, F.col("header_row"))).groupBy(*key).agg(
        F.max(F.when(F.col("at") == F.col("header_row"), fitted(F.col("cells"), F.col("cols")))).alias("_low"), F.max(F.when(F.col("at") < F.col("header_row"), fitted(F.col("cells"), F.col("cols")))).alias("_up")
    )
    h = h.join(named, key, "left").withColumn("_two", F.when(F.col("_forced").isNull() & F.col("_up").isNotNull(), tables.composed_header(F.col("_up"), F.col("_low"), F.col("width"))))
    h = h.withColumn("_names", F.slice(F.coalesce("_two", "_low", F.array_repeat(F.lit(None).cast("string"), F.col("cols"))), 1, limits.max_columns)).withColumn("columns_dropped", F.greatest(F.col("cols") - limits.max_columns, F.lit(0)))
    names = tables.unique_names(h.select(*key, F.posexplode("_names").alias("position", "name")), key).select(*key, "position", F.col("unique_name").alias("name"))
    data = lines.where(F.col("at") > F.coalesce("header_row", F.lit(-1))).withColumn("cells", F.slice(fitted(F.col("cells"), F.col("cols")), 1, limits.max_columns)).where(F.exists("cells", lambda c: c.isNotNull()))
    counted = data.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"), (F.min("row_no") + 1).alias("first_data_row"), (F.max("row_no") + 1).alias("last_data_row"))
    samples = corpus.first_rows(data, key, "row_no", "cells", limits.max_sample_rows).groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("row_no", "cells"))), lambda s: F.transform(s["cells"], lambda c: F.coalesce(c, F.lit("")))).alias("sample_rows"))
    cells = data.select(*key, "row_no", "truncated", F.posexplode("cells").alias("position", "value")).withColumn("column", F.col("position").cast("string"))
    profile = tables.profiles(cells, [*key, "truncated"], limits, complete=True).withColumn("position", F.col("column").cast("int")).drop("column")
    # A table that was not read whole lists no values, only examples.
    profile = profile.withColumn("examples", F.when(F.col("truncated"), F.coalesce("examples", F.slice("values", 1, 5))).otherwise(F.col("examples"))).withColumn("values", F.when(~F.col("truncated"), F.col("values"))).drop("truncated")
    p = names.join(profile, [*key, "position"], "left").withColumn("dtype", F.coalesce("dtype", F.lit("empty")))
    p = p.withColumn("_self", F.coalesce(F.array_contains(F.transform(F.coalesce("values", "examples"), lambda v: F.lower(v)), F.lower("name")), F.lit(False)))
    p = p.withColumn("_full", F.max(F.when(F.col("dtype") != "empty", F.col("position"))).over(Window.partitionBy(*key))).where(F.col("_full").isNull() | (F.col("position") <= F.col("_full")))
    column = F.struct("position", "name", "dtype", F.coalesce("n_values", F.lit(0)).alias("n_values"), F.coalesce("n_empty", F.lit(0)).alias("n_empty"), F.coalesce("n_unique", F.lit(0)).alias("n_unique"), "values", "examples", "min", "max", "median", F.coalesce("n_non_finite", F.lit(0)).alias("n_non_finite"))
    listed = p.groupBy(*key).agg(F.array_sort(F.collect_list(column)).alias("columns"), F.max("_self").alias("_self"))
    out = h.join(listed, key).join(counted, key, "left").join(samples, key, "left")
    doubt = F.col("_self") & F.col("_forced").isNull()
    notes = F.array_compact(F.array(
        F.when(F.col("header_row").isNull(), F.lit("no header row; columns are known by their places")), F.when(F.col("_two").isNotNull(), F.lit("header of two rows, the upper one filled forward")), F.when(F.col("columns_dropped") > 0, F.concat(F.col("columns_dropped").cast("string"), F.lit(" columns beyond the cap"))),
        F.when(F.col("n_rows").isNull(), F.lit("header without data rows")), F.when(F.col("truncated"), F.lit("not read to its end: values are examples")), F.when(doubt, F.lit("a column holds its own name as a value")),
    ))
    ref = F.struct(F.col("source_file").alias("file"), "sheet", (F.col("header_row") + F.col("start") + 1).alias("header_row"), "first_data_row", "last_data_row")
    return out.select(
        *key, "header_row", F.when(doubt, "low").otherwise(F.col("header_confidence")).alias("header_confidence"), F.when(F.size("captions") > 0, F.array_join("captions", " ")).alias("caption"), F.transform("columns", lambda c: c["name"]).alias("header"),
        F.size("columns").alias("n_columns"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "truncated", "columns", F.coalesce("sample_rows", F.array().cast("array<array<string>>")).alias("sample_rows"), "columns_dropped", "tables_skipped", notes.alias("notes"), ref.alias("data_ref"),
    )


def rows_behind(found: DataFrame, rows: DataFrame, limit: int = 20) -> DataFrame:
    """SC20. (source_file, sheet, part, row from 1, cells, is_header): the header and the first ``limit`` data rows that each card describes, read again."""
    c = found.select(*SHEET, "part", F.col("data_ref.header_row").alias("_h"), F.col("data_ref.first_data_row").alias("_a"), F.least("data_ref.last_data_row", F.col("data_ref.first_data_row") + limit - 1).alias("_b"))
    r = rows.select(*SHEET, (F.col("row_no") + 1).alias("row"), F.transform("cells", lambda x: F.coalesce(clean_cell(x), F.lit(""))).alias("cells"))
    j = r.join(c, list(SHEET)).where((F.col("row") == F.col("_h")) | F.col("row").between(F.col("_a"), F.col("_b")))
    return j.select(*SHEET, "part", "row", "cells", (F.col("row") == F.coalesce("_h", F.lit(-1))).alias("is_header"))


def as_blocks(found: DataFrame, label: Column | None = None, role: str = "supplement") -> DataFrame:
    """C28. Cards as table blocks; a supplied label comes before the sheet's name."""
    title = F.col("sheet")
    return found.select(F.lit("table").alias("kind"), F.lit(role).alias("role"), "source_file", F.concat(F.lit("sheet "), title, F.lit(" part "), F.col("part").cast("string")).alias("locator"), F.coalesce(label, title).alias("label") if label is not None else title.alias("label"), F.array_join("header", " | ").alias("text"))


def stale(found: DataFrame, files: DataFrame, digests: Sequence[str] = ("source_file", "sha256")) -> DataFrame:
    """SC20. Cards whose source file has another digest now, or is gone."""
    f = files.select(F.col(digests[0]).alias("source_file"), F.col(digests[1]).alias("_now"))
    return found.join(f, "source_file", "left").where(~F.col("sha256").eqNullSafe(F.col("_now"))).drop("_now")
