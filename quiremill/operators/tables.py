"""Tables summarised by column: header detection, panels, names, profiles, cards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiremill.functions.text import NON_FINITE, as_number, clean_cell, value_kind
from quiremill.limits import DEFAULT, Limits

#: Share of numeric values from which a mixed column counts as numeric.
NUMERIC_SHARE = 0.8
SHEET = ("source_file", "sheet")


def present(cells: Column) -> Column:
    return F.filter(F.transform(cells, clean_cell), lambda c: c.isNotNull())


def repeating_header(cells: Column) -> Column:
    """W6. STRUCT<offset, repeats>: after at most two leading cells the rest is a block of distinct names repeated; the smallest offset, then the shortest block. Null if not."""

    def at(offset):
        tail = F.slice(cells, offset + 1, F.greatest(F.size(cells), F.lit(1)))
        n = F.size(tail)

        def fits(p):
            block = F.slice(tail, 1, p)
            return (n % p == 0) & (F.size(F.array_distinct(block)) == p) & (tail == F.flatten(F.array_repeat(block, (n / p).cast("int"))))

        periods = F.when(n >= 4, F.filter(F.sequence(F.lit(2), F.greatest(F.lit(2), (n / 2).cast("int"))), fits)).otherwise(F.array().cast("array<int>"))
        first = F.get(periods, F.lit(0))
        return F.when(first.isNotNull(), F.struct(F.lit(offset).alias("offset"), (n / first).cast("int").alias("repeats")))

    return F.coalesce(*(at(o) for o in (0, 1, 2)))


def label_like(cells: Column, width: Column) -> Column:
    """Does a row of clean cells read like column names? Few numbers, no long cells, names mostly distinct or in repeating blocks."""
    here = F.filter(cells, lambda c: c.isNotNull())
    n = F.size(here)
    numeric = F.size(F.filter(here, lambda c: value_kind(c) == "number"))
    long_cells = F.size(F.filter(here, lambda c: F.length(c) > 80))
    distinct = F.size(F.array_distinct(F.transform(here, lambda c: F.lower(c))))
    enough = distinct >= F.greatest(F.least(F.lit(2), n), F.floor(n * 0.7).cast("int"))
    return (n >= F.least(F.lit(2), F.greatest(F.lit(1), width))) & (numeric <= F.floor(n / 2)) & (long_cells == 0) & (enough | repeating_header(here).isNotNull())


def detected_headers(rows: DataFrame, limits: Limits = DEFAULT, sheet: Sequence[str] = SHEET) -> DataFrame:
    """W3. Per sheet header_row (null if none), captions above it, confidence and width. rows: (sheet columns, row_no from 0, cells).

    The header is the first of ``max_header_scan_rows`` rows that is wide enough and label-like. Rows of one cell above it are
    captions. Confidence is high if a number stands in the next three rows and none in the header.
    """
    r = rows.withColumn("_c", F.transform("cells", clean_cell)).withColumn("_n", F.size(F.filter("_c", lambda c: c.isNotNull())))
    r = r.withColumn("_width", F.max("_n").over(Window.partitionBy(*sheet)))
    numeric = F.exists("_c", lambda c: F.coalesce(value_kind(c) == "number", F.lit(False)))
    r = r.withColumn("_numeric", numeric).withColumn("_next", F.max("_numeric").over(Window.partitionBy(*sheet).orderBy("row_no").rowsBetween(1, 3)))
    single = (F.col("_n") == 1) & (F.col("_width") > 1)
    wide = F.col("_n") >= F.greatest(F.least(F.lit(2), F.col("_width")), F.floor(F.col("_width") * 0.5).cast("int"))
    r = r.where(F.col("row_no") < limits.max_header_scan_rows).withColumn("_header", (F.col("_n") > 0) & ~single & wide & label_like(F.col("_c"), F.col("_width")))
    r = r.withColumn("_first", F.min(F.when(F.col("_header"), F.col("row_no"))).over(Window.partitionBy(*sheet)))
    above = single & (F.col("_first").isNull() | (F.col("row_no") < F.col("_first")))
    caption = F.when(above, F.struct("row_no", F.get(F.filter("_c", lambda c: c.isNotNull()), F.lit(0)).alias("text")))
    at = F.col("row_no") == F.col("_first")
    out = r.groupBy(*sheet).agg(
        F.min("_first").cast("int").alias("header_row"), F.array_sort(F.collect_list(caption)).alias("_captions"), F.max(F.when(at, F.col("_next") & ~F.col("_numeric"))).alias("_high"),
        F.max("_width").alias("width"), F.max(F.when(at, F.col("_c"))).alias("header"),
    )
    return out.select(*sheet, "header_row", "header", F.transform("_captions", lambda c: c["text"]).alias("captions"), F.when(F.coalesce("_high", F.lit(False)), "high").otherwise("low").alias("header_confidence"), "width")


def composed_header(upper: Column, lower: Column, width: Column) -> Column:
    """W4. A sparse row of group labels, filled forward, joined onto the header below it; null if ``upper`` is no such row."""
    up, low = F.filter(upper, lambda c: c.isNotNull()), F.filter(lower, lambda c: c.isNotNull())
    able = (F.size(up) >= 2) & (F.size(up) < F.size(low)) & ~F.exists(up, lambda c: value_kind(c) == "number") & label_like(upper, width)
    carried = F.transform(F.sequence(F.lit(1), F.size(lower)), lambda i: F.get(F.reverse(F.filter(F.slice(upper, 1, i), lambda c: c.isNotNull())), F.lit(0)))
    joined = F.zip_with(carried, lower, lambda g, n: F.when(g.isNotNull() & n.isNotNull(), F.concat(g, F.lit(" / "), n)).otherwise(F.coalesce(n, g)))
    return F.when(able, joined)


def panels(rows: DataFrame, sheet: Sequence[str] = SHEET) -> DataFrame:
    """W5. (sheet columns, panel, start, end): parts of a sheet between blank rows. A part of one row joins the part below it, such parts at the end go; a sheet of less than two parts gives none."""
    blank = F.size(present(F.col("cells"))) == 0
    w = Window.partitionBy(*sheet).orderBy("row_no")
    r = rows.withColumn("_blank", blank).withColumn("_island", F.sum(F.when(F.col("_blank"), 1).otherwise(0)).over(w)).where("not _blank")
    parts = r.groupBy(*sheet, "_island").agg(F.min("row_no").alias("start"), (F.max("row_no") + 1).alias("end"))
    listed = parts.groupBy(*sheet).agg(F.array_sort(F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end")))).alias("p"))
    zero = F.array().cast("array<struct<start: int, end: int>>")

    def step(acc, x):
        last = F.get(acc, F.size(acc) - 1)
        lone = (F.size(acc) > 0) & F.coalesce(last["end"] - last["start"] == 1, F.lit(False))
        joined = F.array_append(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.struct(last["start"].alias("start"), x["end"].alias("end")))
        return F.when(lone, joined).otherwise(F.array_append(acc, x))

    merged = F.aggregate("p", zero, step)
    trimmed = F.when((F.size("m") > 0) & (F.element_at("m", -1)["end"] - F.element_at("m", -1)["start"] == 1), F.slice("m", 1, F.greatest(F.size("m") - 1, F.lit(0)))).otherwise(F.col("m"))
    out = listed.withColumn("m", merged).withColumn("m", trimmed).where(F.size("m") >= 2)
    return out.select(*sheet, F.posexplode("m").alias("panel", "x")).select(*sheet, "panel", "x.start", "x.end")


def unique_names(columns: DataFrame, group: Sequence[str], position: str = "position", name: str = "name") -> DataFrame:
    """W11. Adds ``unique_name``: a null name is column_N by its position from 1, a repeat (whatever its case) gets its number in brackets."""
    filled = F.coalesce(F.col(name), F.concat(F.lit("column_"), (F.col(position) + 1).cast("string")))
    c = columns.withColumn("_name", filled)
    n = F.row_number().over(Window.partitionBy(*group, F.lower("_name")).orderBy(position))
    return c.withColumn("unique_name", F.when(n == 1, F.col("_name")).otherwise(F.concat("_name", F.lit(" ("), n.cast("string"), F.lit(")")))).drop("_name")


def cells_long(df: DataFrame, group: Sequence[str], row: str, columns: Sequence[str]) -> DataFrame:
    """(group, row_no, column, value) from a wide frame: values as clean text."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), clean_cell(F.col(c)).alias("value")) for c in columns))
    return df.select(*group, F.col(row).alias("row_no"), F.explode(pairs).alias("x")).select(*group, "row_no", "x.column", "x.value")


def profiles(cells: DataFrame, group: Sequence[str] = (), limits: Limits = DEFAULT, complete: bool = True) -> DataFrame:
    """A1. One row per column of long cells (group, row_no, column, value): its type, counts, values or examples, and range.

    Distinct values ignore case and show the spelling seen first. All values are listed if there are few enough and none is long and the table was read
    whole (``complete``); else the first five are examples. The median is the upper one. Values are first made distinct, so that
    a column of few values costs few rows after the first aggregation; no row gathers more of a column than the values it may list.
    """
    keys = [*group, "column"]
    kind = value_kind(F.col("value"))
    per_value = (
        cells.withColumn("_low", F.lower("value"))
        .groupBy(*keys, "value", "_low")
        .agg(F.count(F.lit(1)).alias("n"), F.min("row_no").alias("first"))
        .withColumn("_kind", kind)
        .withColumn("_num", as_number(F.col("value")))
        .withColumn("_odd", F.coalesce(F.col("value").rlike(NON_FINITE), F.lit(False)))
    )
    per_low = per_value.groupBy(*keys, "_low").agg(
        F.min_by("value", "first").alias("value"), F.min("first").alias("first"), F.sum("n").alias("n"), F.sum(F.when(F.col("_kind") == "number", F.col("n")).otherwise(0)).alias("n_num"),
        F.min("_kind").alias("_kind"), F.max("_kind").alias("_last_kind"), F.sum(F.when(F.col("_odd"), F.col("n")).otherwise(0)).alias("n_odd"), F.min("_num").alias("_min"), F.max("_num").alias("_max"),
    )
    value = F.col("value").isNotNull()
    a = per_low.groupBy(*keys).agg(
        F.sum(F.when(value, F.col("n")).otherwise(0)).alias("n_values"), F.sum(F.when(~value, F.col("n")).otherwise(0)).alias("n_empty"), F.count(F.when(value, 1)).alias("n_unique"), F.sum("n_num").alias("n_num"),
        F.min("_kind").alias("kind"), F.max("_last_kind").alias("_last_kind"), F.sum("n_odd").alias("n_non_finite"), F.max(F.when(value, F.length("value"))).alias("longest"), F.min("_min").alias("min"), F.max("_max").alias("max"),
    )
    # The first values of a column. The condition holds a count so that it stays above the first aggregation, which then runs once for all uses.
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("first", "value"))
    top = per_low.where(F.when(F.col("n") > 0, F.col("value")).isNotNull()).withColumn("_place", place).where(F.col("_place") <= max(limits.max_unique_values, 5) + 1)
    firsts = top.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_place", "value"))).alias("firsts"))
    for part in (firsts, _upper_medians(per_value, keys)):
        a = _beside(a, part, keys)
    single = F.col("kind") == F.col("_last_kind")
    dtype = F.when(F.col("n_values") == 0, "empty").when(single, F.col("kind")).when(F.col("n_num") >= NUMERIC_SHARE * F.col("n_values"), "number").otherwise("mixed")
    a = a.withColumn("dtype", dtype).withColumn("firsts", F.coalesce(F.transform("firsts", lambda x: x["value"]), F.array().cast("array<string>")))
    few = F.when(F.col("dtype") == "number", F.col("n_unique") <= limits.max_unique_numeric_values).otherwise(F.col("n_unique") <= limits.max_unique_values)
    whole = F.lit(complete) & few & (F.col("longest") <= limits.max_value_chars) & (F.col("n_unique") > 0)
    by_number = F.transform(F.array_sort(F.transform("firsts", lambda v: F.struct(as_number(v).isNull().alias("no"), as_number(v).alias("x"), v.alias("v")))), lambda s: s["v"])
    by_text = F.transform(F.array_sort(F.transform("firsts", lambda v: F.struct(F.lower(v).alias("l"), v.alias("v")))), lambda s: s["v"])
    is_num = F.col("dtype") == "number"
    return a.select(
        *keys, "dtype", "n_values", "n_empty", "n_unique", F.when(whole, F.when(is_num, by_number).otherwise(by_text)).alias("values"), F.when(~F.coalesce(whole, F.lit(False)), F.slice("firsts", 1, 5)).alias("examples"),
        F.when(is_num, F.col("min")).alias("min"), F.when(is_num, F.col("max")).alias("max"), F.when(is_num, F.col("median")).alias("median"), "n_non_finite",
    )


def _beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys that may be null."""
    r = right.select(*(F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)), *(c for c in right.columns if c not in keys))
    same = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    return left.join(r, same, "left").drop(*(f"_r{i}" for i in range(len(keys))))


def _upper_medians(per_value: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, median): of all numbers of a column, each ``n`` times, the one with half of them, rounded down, before it.

    Numbers are counted by their order of magnitude in steps of 2 ** (1 / 1024), which keeps their order, and only those of the step that holds the median are put in order.
    """
    size = F.rint(F.log2(F.abs("_num")) * 1024) + 2_000_000  # above 0 for all doubles but 0, whose logarithm is null
    # Both columns of the first aggregation are named, so that it runs once for all uses.
    nums = per_value.where(F.when((F.col("n") > 0) | F.col("first").isNull(), F.col("_num")).isNotNull())
    nums = nums.groupBy(*keys, "_num").agg(F.sum("n").alias("n")).withColumn("_step", F.coalesce(F.signum("_num") * size, F.lit(0.0)))
    w = Window.partitionBy(*keys)
    steps = nums.groupBy(*keys, "_step").agg(F.sum("n").alias("_n")).withColumn("_half", F.floor(F.sum("_n").over(w) / 2))
    steps = steps.withColumn("_before", F.sum("_n").over(w.orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
    middle = steps.where((F.col("_before") <= F.col("_half")) & (F.col("_half") < F.col("_before") + F.col("_n")))
    near = _beside(nums, middle.select(*keys, "_step", (F.col("_half") - F.col("_before")).alias("_rest")), [*keys, "_step"]).where("_rest is not null")
    run = F.sum("n").over(w.orderBy("_num").rowsBetween(Window.unboundedPreceding, 0))
    return near.withColumn("_run", run).where(F.col("_run") > F.col("_rest")).groupBy(*keys).agg(F.min("_num").alias("median"))


def self_named(profile: DataFrame) -> DataFrame:
    """ST8. Adds ``self_named``: the column's name stands among its own values, so the header is in doubt."""
    return profile.withColumn("self_named", F.coalesce(F.array_contains(F.transform(F.coalesce("values", "examples"), lambda v: F.lower(v)), F.lower("column")), F.lit(False)))


def rendered_column(position: Column) -> Column:
    """X30. A column's line on a card."""
    listed = F.array_join(F.coalesce("values", "examples"), " | ")
    return F.concat(position.cast("string"), F.lit(". "), F.col("column"), F.lit(" ["), F.col("dtype"), F.lit(", "), F.col("n_unique").cast("string"), F.lit(" distinct"), F.when(F.col("n_empty") > 0, F.concat(F.lit(", "), F.col("n_empty").cast("string"), F.lit(" empty"))).otherwise(F.lit("")), F.lit("] "), F.when(F.col("values").isNotNull(), F.lit("= ")).otherwise(F.lit("e.g. ")), listed)


def rendered_card(lines: DataFrame, group: Sequence[str], limits: Limits = DEFAULT) -> DataFrame:
    """S10. Column lines in order while they fit ``max_card_chars`` less a fifth for samples, at most ``max_rendered_columns``; what is hidden is counted. lines: (group, position, line)."""
    room = limits.max_card_chars - limits.max_card_chars // 5
    listed = lines.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("position", "line"))).alias("l"))
    zero = F.struct(F.lit("").alias("text"), F.lit(0).alias("shown"), F.lit(False).alias("full"))

    def step(acc, x):
        text = F.when(acc["text"] == "", x["line"]).otherwise(F.concat(acc["text"], F.lit("\n"), x["line"]))
        fits = ~acc["full"] & (F.length(text) <= room) & (acc["shown"] < limits.max_rendered_columns)
        return F.struct(F.when(fits, text).otherwise(acc["text"]).alias("text"), F.when(fits, acc["shown"] + 1).otherwise(acc["shown"]).alias("shown"), (~fits).alias("full"))

    out = listed.select(*group, F.aggregate("l", zero, step).alias("r"), F.size("l").alias("n"))
    return out.select(*group, "r.text", F.col("r.shown").alias("columns_shown"), (F.col("n") - F.col("r.shown")).alias("columns_hidden"))


def capped(rows: DataFrame, group: Sequence[str], order: str, cap: int) -> DataFrame:
    """S8, SC10. Rows within the cap, with ``considered`` and ``dropped`` counts of their group."""
    w = Window.partitionBy(*group)
    r = rows.withColumn("_n", F.row_number().over(w.orderBy(order))).withColumn("considered", F.count(F.lit(1)).over(w))
    return r.where(F.col("_n") <= cap).withColumn("dropped", F.greatest(F.col("considered") - cap, F.lit(0))).drop("_n")
