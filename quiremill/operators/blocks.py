"""Blocks: numbering and identity, filters, preference, budgeted packs, files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quiremill import schemas

PACK_BUDGET = 60_000
TABLE_HEADROOM = 400
#: Blocks of an article that a pack looks at before it leaves out what can't fit any more.
PACK_HEAD = 256
PACK_ORDER = ("rank", "index", "block_id", "chars", "is_table")
PROVENANCE = ("block_id", "kind", "role", "section", "source_file", "locator", "chars")


def lines_as_blocks(df: DataFrame, doc: str = "doc_id", text: str = "text", kind: str = "paragraph") -> DataFrame:
    """SC15. One block per non-blank line of each text, in order, with its line number as locator."""
    lines = df.select(F.col(doc).alias("slug"), F.posexplode(F.split(text, "\n")).alias("line", "text")).where(F.trim("text") != "")
    return lines.select("slug", F.col("line").alias("pos"), F.lit(kind).alias("kind"), F.lit("main_text").alias("role"), F.lit("txt").alias("origin"), F.lit("text").alias("source_file"), F.concat(F.lit("line "), F.col("line")).alias("locator"), "text")


def numbered(blocks: DataFrame, order: str = "pos") -> DataFrame:
    """W1. Adds index, chars, text_sha256, ordinal and block_id. The id leaves the section out, so that relabelling keeps it; equal blocks differ by their ordinal. One shuffle by slug."""
    key = ["role", "origin", "source_file", "locator", "kind", "text_sha256"]
    b = blocks.withColumn("chars", F.length("text")).withColumn("text_sha256", F.sha2("text", 256))
    b = b.withColumn("index", (F.row_number().over(Window.partitionBy("slug").orderBy(order)) - 1).cast("int"))
    b = b.withColumn("ordinal", (F.row_number().over(Window.partitionBy("slug", *key).orderBy("index")) - 1).cast("int"))
    return b.withColumn("block_id", F.left(F.sha2(F.concat_ws("\0", *key, F.col("ordinal").cast("string")), 256), F.lit(16)))


def filtered(
    blocks: DataFrame, kinds: Sequence[str] = (), sections: Sequence[str] = (), roles: Sequence[str] = (), files: Sequence[str] = (), contains: str | None = None, exclude_sections: Sequence[str] = ()
) -> DataFrame:
    """FL1. Blocks that meet every condition given; an empty one is no condition. A null section is never excluded."""
    want = F.lit(True)
    for column, allowed in (("kind", kinds), ("section", sections), ("role", roles)):
        if allowed:
            want &= F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    if files:
        want &= F.exists(F.array(*map(F.lit, files)), lambda f: F.contains(F.col("source_file"), f))
    if contains:
        want &= F.contains(F.lower("text"), F.lower(F.lit(contains)))
    if exclude_sections:
        want &= ~F.coalesce(F.col("section").isin(*exclude_sections), F.lit(False))
    return blocks.where(want)


def shown(blocks: DataFrame, kind: str | None = None, section: str | None = None, role: str | None = None, file: str | None = None, limit: int = 20, preview: int = 600) -> DataFrame:
    """FL2. The first ``limit`` blocks that fit, with cut texts, and how many fit in all."""
    rows = filtered(blocks, [kind] if kind else (), [section] if section else (), [role] if role else (), [file] if file else ())
    cut = F.when(F.length("text") > preview, F.concat(F.left("text", F.lit(preview)), F.lit("…"))).otherwise(F.col("text"))
    return rows.withColumn("matching", F.count(F.lit(1)).over(Window.partitionBy("slug"))).withColumn("text", cut).orderBy("slug", "index").limit(limit)


def provenance(blocks: DataFrame) -> DataFrame:
    """FL3. Where blocks come from, without their texts."""
    return blocks.select("slug", *PROVENANCE)


def preference(sections: Sequence[str]) -> Column:
    """S1. 0 for a section that was asked for, 1 for none, 2 for others; sorting by it and the index drops nothing."""
    return F.when(F.col("section").isin(*sections), 0).when(F.col("section").isNull(), 1).otherwise(2)


def packed(blocks: DataFrame, budget: int = PACK_BUDGET, headroom: int = TABLE_HEADROOM, sections: Sequence[str] = ()) -> DataFrame:
    """S2. Per slug the blocks that a greedy walk in preferred order keeps within ``budget`` characters, and what it drops.

    A block that doesn't fit is skipped and the walk goes on; a table needs ``headroom`` characters left, however small it is. The lists are as long as the article;
    who takes only the counts gathers no blocks in one row.
    """
    order = F.struct(*PACK_ORDER)
    b = pack_marks(blocks, budget, headroom, sections).withColumn("n_dropped", F.col("n") - F.col("n_kept"))

    def ids(n):
        listed = F.array_sort(F.collect_list(F.when(F.col(n) > 0, F.struct(order.alias("o"), F.col(n).cast("int").alias("n")))))
        return F.flatten(F.transform(listed, lambda x: F.array_repeat(x["o"]["block_id"].cast("string"), x["n"])))

    unknown = F.max(F.col("chars").isNull() & (F.col("n_dropped") > 0))
    chars = lambda n: F.coalesce(F.sum(F.col("chars").cast("long") * F.col(n)), F.lit(0).cast("long"))
    return b.groupBy("slug").agg(
        F.sum("n").cast("int").alias("considered"), chars("n_kept").alias("used"), ids("n_kept").alias("kept"), ids("n_dropped").alias("dropped"), F.when(~unknown, chars("n_dropped")).alias("dropped_chars"), F.sum("n_kept").alias("n_kept")
    )


def pack_marks(blocks: DataFrame, budget: int = PACK_BUDGET, headroom: int = TABLE_HEADROOM, sections: Sequence[str] = (), head: int = PACK_HEAD) -> DataFrame:
    """S2. (slug, PACK_ORDER, n, n_kept): blocks, equal ones as one row, and how many of them the walk of ``packed`` keeps. ``chars`` are from 0.

    What is left of the budget never grows, so a block larger than what is left after the ``head`` first ones is surely skipped. These are walked first, and then, behind them, the blocks that may still fit.
    Blocks without characters change nothing: they are judged by where the walk falls below ``headroom``.
    """
    rank = preference(sections) if sections else F.lit(0)
    one = blocks.select("slug", rank.alias("rank"), "index", "block_id", "chars", (F.col("kind") == "table").alias("is_table"))
    table, order = F.coalesce("is_table", F.lit(True)), F.struct(*PACK_ORDER)
    need = F.when(table, F.greatest(F.col("chars"), F.lit(headroom))).otherwise(F.col("chars"))
    b = one.groupBy("slug", *PACK_ORDER).agg(F.count(F.lit(1)).alias("n"))
    # The condition holds a count so that it stays above the aggregation, which then runs once for all uses.
    live = b.where(F.when(F.col("n") > 0, (F.col("chars") > 0) & (need <= budget))).withColumn("_need", need.cast("long"))
    w = Window.partitionBy("slug").orderBy(*PACK_ORDER)
    first = _walked(live.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= head).drop("_place").withColumn("_left", F.lit(budget).cast("long")))
    reached = first.groupBy(F.col("slug").alias("_slug")).agg(F.min("_left").alias("_left"), F.max(order).alias("_last"), F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") == head)
    rest = live.join(reached, F.col("slug").eqNullSafe(F.col("_slug"))).where((order > F.col("_last")) & (F.col("_need") <= F.col("_left")))
    walked = first.unionByName(_walked(rest.select(*live.columns, "_left")))
    short = walked.where(F.col("_left") < headroom).groupBy(F.col("slug").alias("_slug")).agg(F.min(order).alias("_short"))
    bare = b.where(F.when(F.col("n") > 0, (F.col("chars") == 0) & table)).join(short, F.col("slug").eqNullSafe(F.col("_slug")), "left")
    bare = bare.where(F.lit(headroom <= budget) & (F.col("_short").isNull() | (order < F.col("_short"))))
    none = F.lit(0).cast("long")
    marks = b.withColumn("n_kept", F.when((F.col("chars") == 0) & ~table, F.col("n")).otherwise(none))
    for kept in (walked.select("slug", *PACK_ORDER, none.alias("n"), "n_kept"), bare.select("slug", *PACK_ORDER, none.alias("n"), F.col("n").alias("n_kept"))):
        marks = marks.unionByName(kept)
    return marks.groupBy("slug", *PACK_ORDER).agg(F.sum("n").alias("n"), F.sum("n_kept").alias("n_kept"))


def _walked(rows: DataFrame) -> DataFrame:
    """Rows with ``n_kept`` of their ``n`` equal blocks that a walk in order keeps, from ``_left`` characters at a slug's first row on; ``_left`` is then what is left behind the row. One row at a time."""
    ordered = rows.repartition("slug").sortWithinPartitions("slug", *PACK_ORDER)

    def walk(batches):
        import pyarrow as pa

        now, left = object(), 0
        for batch in batches:
            kept, after = [], []
            for slug, chars, need, n, start in zip(*(batch.column(c).to_pylist() for c in ("slug", "chars", "_need", "n", "_left")), strict=True):
                if slug != now:
                    now, left = slug, start
                k = min(n, (left - need) // chars + 1) if need <= left else 0
                left -= k * chars
                kept.append(k)
                after.append(left)
            held = [batch.column(c) for c in batch.schema.names if c != "_left"]
            yield pa.RecordBatch.from_arrays([*held, pa.array(kept, pa.int64()), pa.array(after, pa.int64())], [*(c for c in batch.schema.names if c != "_left"), "n_kept", "_left"])

    ordered = ordered.select(*(c for c in ordered.columns if c != "_left"), "_left")
    schema = StructType([*(f for f in ordered.schema if f.name != "_left"), StructField("n_kept", LongType()), StructField("_left", LongType())])
    return ordered.mapInArrow(walk, schema)


def first_kept(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """ST1. The first row of each key, with the number of rows it stands for."""
    w = Window.partitionBy(*keys)
    return rows.withColumn("_n", F.row_number().over(w.orderBy(order))).withColumn("copies", F.count(F.lit(1)).over(w)).where("_n = 1").drop("_n")


def distinct_in_order(rows: DataFrame, key: str, order: str) -> DataFrame:
    """ST2. Distinct values with first position and number of mentions."""
    return rows.groupBy(key).agg(F.min(order).alias("first_at"), F.count(F.lit(1)).alias("mentions")).withColumn("repeated", F.col("mentions") > 1)


def by_id(blocks: DataFrame) -> DataFrame:
    """C13. One block per (slug, block_id): the last."""
    return blocks.groupBy("slug", "block_id").agg(F.max_by(F.struct(*(c for c in blocks.columns if c not in ("slug", "block_id"))), "index").alias("b")).select("slug", "block_id", "b.*")


def as_json(df: DataFrame) -> DataFrame:
    """SK1, SK3. One JSON object per row as ``value``, keys in alphabetical order, nulls left out; non-finite numbers become nulls first, as JSON has none."""
    kinds = dict(df.dtypes)
    fields = [F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(F.col(c)).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in sorted(df.columns)]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("value"))


def read_blocks(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """SC4. (blocks, rejected): lines of JSON under the block schema; a line that isn't JSON is rejected, not fatal."""
    rows = spark.read.schema(schemas.BLOCK + ", _corrupt_record string").json(paths)
    return rows.where(F.col("_corrupt_record").isNull() & F.col("kind").isNotNull()).drop("_corrupt_record"), rows.where(F.col("_corrupt_record").isNotNull()).select("_corrupt_record")


def blocks_digest(blocks: DataFrame) -> DataFrame:
    """SK1, C17. Per slug the SHA-256 of its JSON lines in order, and their number."""
    line = F.struct(F.col("index"), F.to_json(F.struct(*sorted(c for c in blocks.columns if c != "slug"))).alias("json"))
    return blocks.groupBy("slug").agg(F.array_sort(F.collect_list(line)).alias("l")).select("slug", F.sha2(F.array_join(F.transform("l", lambda x: x["json"]), "\n"), 256).alias("blocks_sha256"), F.size("l").alias("lines"))


def markdown(blocks: DataFrame) -> DataFrame:
    """SK2. (slug, markdown): headings marked, a line where the source file changes, blocks parted by blank lines."""
    w = Window.partitionBy("slug").orderBy("index")
    changed = F.coalesce(F.lag("source_file").over(w) != F.col("source_file"), F.lit(True))
    body = F.when(F.col("kind") == "heading", F.concat(F.lit("## "), F.col("text"))).when(F.col("kind") == "table", F.concat(F.lit("```\n"), F.col("text"), F.lit("\n```"))).otherwise(F.col("text"))
    part = F.when(changed, F.concat(F.lit("<!-- "), F.col("source_file"), F.lit(" -->\n\n"), body)).otherwise(body)
    rows = blocks.withColumn("part", part)
    return rows.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("index", "part"))).alias("p")).select("slug", F.array_join(F.transform("p", lambda x: x["part"]), "\n\n").alias("markdown"))
