"""Mixing sources to target weights by Pareto order sampling. DataFrame operations only.

A source's target is its share by weight of the words that the mix takes, held to ``max_copies`` times its own words;
what goes beyond is shared out again by weight. Of ``rate = target / words`` the whole part is certain: each document is
taken that often. The rest is a sample without replacement of a fixed size in words. Documents have inclusion odds of their own, in proportion to
their sizes (so that few long documents are taken once more rather than many short ones); they are ranked by random odds u / (1 - u), with u
uniform by a hash of the id, divided by inclusion odds, and taken in that order as long as the words still fit. The factor that would make
the odds add up to the sample is one number a source, which no ranking within the source depends on. One closing document, the one
whose size is next to what is then missing, brings the source to its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiremill.llm.common import WORD, checkpointed, small

#: Cells of the rank scale to a doubling of the rank. Words are added up by cell first; only the cell of the cut is looked into.
CELLS = 256
WEIGHTS = (3, 1, 2)


def uniform(id_col: str, seed: str = "mix"):
    """A number in (0, 1) from 48 bits of an MD5 of the id; null ids share one number."""
    return (F.conv(F.left(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), F.lit(12)), 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sources: DataFrame, share: float, weights: Sequence[int] = WEIGHTS, max_copies: float = 2.0) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size): one row per source, sorted in one task.

    With sources by growing cap / weight, the first k are held to their caps, and the others share the rest at one level.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(by_name) - 1) % len(weights)
    t = sources.withColumn("weight", F.element_at(F.array(*(F.lit(w) for w in weights)), at + 1)).withColumn("cap", F.lit(max_copies) * F.col("source_size"))
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    here, whole = by_cap.rowsBetween(Window.unboundedPreceding, Window.currentRow), Window.partitionBy()
    total = F.lit(share) * F.sum("source_size").over(whole)
    level = (total - (F.sum("cap").over(here) - F.col("cap"))) / (F.sum("weight").over(whole) - F.sum("weight").over(here) + F.col("weight"))
    t = t.withColumn("_level", level).withColumn("_held", F.col("cap") <= F.col("_level") * F.col("weight"))
    common = F.max(F.when(~F.col("_held"), F.col("_level"))).over(whole)
    return t.withColumn("target", F.when(F.col("_held"), F.col("cap")).otherwise(F.col("weight") * common)).select("source", "source_size", "weight", "target")


def mix(
    df: DataFrame, share: float = 1.5, weights: Sequence[int] = WEIGHTS, max_copies: float = 2.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", cells: int = CELLS, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per row of ``df``: id, source, size, source_size, target, copies, taken (= copies * size), and the columns ``keep``.

    Null texts and texts without words have size 0 and take nothing; null is a source of its own, the last one; an empty
    table gives no rows. A long text counts by its words alone. Rows that tie (equal ids, or null ones, of one size) are taken one by one, so that a cut among
    them misses the target by less than one of them; which of them are taken is open, as they are equal here. Reruns and retries agree, since all
    else depends on ids, sizes and sources only. Other columns of ``df`` are ignored.
    """
    size = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")
    kept = [F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)]
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), uniform(id_col, seed).alias("u"), F.monotonically_increasing_id().alias("rid"), *kept)
    rows = checkpointed(rows.withColumn("rank", F.when(F.col("size") > 0, F.col("u") / (1 - F.col("u")) / F.col("size"))).drop("u"))
    rows = rows.withColumn("cell", F.floor(F.log2("rank") * cells).cast("int"))

    cell_sums = checkpointed(rows.groupBy("source", "cell").agg(F.sum("size").alias("words")))  # some thousand rows per source
    plan = targets(cell_sums.groupBy("source").agg(F.sum("words").alias("source_size")), share, weights, max_copies)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(max_copies))).otherwise(F.lit(0.0))
    plan = plan.withColumn("whole", F.floor(rate).cast("int")).withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    plan = checkpointed(plan)
    n_sources = plan.count()
    same = lambda a, b: a["source"].eqNullSafe(b["source"])

    # The cell in which the words in order of rank pass the rest.
    cum = cell_sums.where("cell is not null").withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("cell")))
    p = small(plan.select("source", "rest"), n_sources)
    cut = cum.join(p, same(cum, p)).where(F.col("upto") > F.col("rest")).groupBy(cum["source"].alias("source")).agg(F.min(F.struct("cell", (F.col("upto") - F.col("words")).alias("before"), "rest")).alias("c"))
    cut = checkpointed(cut.select("source", F.col("c.cell").alias("cut_cell"), F.col("c.before").alias("before"), F.col("c.rest").alias("rest")))

    # In it the first group of tied rows, by parts of the table, that doesn't fit as a whole; and the last of its rows that fits.
    key = F.struct("rank", F.col("id").isNull().alias("null"), "id", "size", F.shiftright("rid", 33).alias("part"))
    c = small(cut, n_sources)
    near = rows.join(c, same(rows, c) & (rows["cell"] == c["cut_cell"])).select(rows["source"], key.alias("key"), "rid", "size", "before", "rest")
    tied = near.groupBy("source", "key").agg(F.count(F.lit(1)).alias("n"), F.any_value("size").alias("size"), F.any_value("before").alias("before"), F.any_value("rest").alias("rest"))
    words = F.col("n") * F.col("size")
    tied = tied.withColumn("ahead", F.col("before") + F.sum(words).over(Window.partitionBy("source").orderBy("key")) - words).where(F.col("ahead") + words > F.col("rest"))
    edge = tied.groupBy("source").agg(F.min(F.struct("key", "ahead", "rest", "size")).alias("e"))
    edge = checkpointed(edge.select("source", F.col("e.key").alias("edge"), F.floor((F.col("e.rest") - F.col("e.ahead")) / F.col("e.size")).alias("fit"), "e.ahead", "e.rest", "e.size"))
    e = small(edge.select("source", "edge", "fit"), n_sources)
    last = near.join(e, same(near, e) & (near["key"] == e["edge"])).select(near["source"], "rid", "fit").withColumn("n", F.row_number().over(Window.partitionBy("source").orderBy("rid"))).where("n = fit").select("source", F.col("rid").alias("last"))
    edge = edge.join(last, same(edge, last), "left").select(edge["source"], "edge", "last", (F.col("rest") - F.col("ahead") - F.col("fit") * F.col("size")).alias("missing"))
    edge = checkpointed(edge.join(cut.select("source", "cut_cell"), same(edge, cut)).select(edge["source"], "cut_cell", "edge", "last", "missing"))

    g = small(edge, n_sources)
    within = (key < F.col("edge")) | ((key == F.col("edge")) & F.coalesce(F.col("rid") <= F.col("last"), F.lit(False)))
    drawn = F.when(F.col("cut_cell").isNull(), F.lit(True)).otherwise((F.col("cell") < F.col("cut_cell")) | ((F.col("cell") == F.col("cut_cell")) & within))
    marked = rows.join(g, same(rows, g), "left").select(rows["source"], "id", "size", "rank", "rid", *(f"_keep{i}" for i in range(len(keep))), F.coalesce(drawn, F.lit(False)).alias("drawn"), F.coalesce("missing", F.lit(0.0)).alias("missing"))
    off = F.abs(F.col("size") - F.col("missing"))
    closing = marked.where(~F.col("drawn") & (off < F.col("missing"))).groupBy("source").agg(F.min(F.struct(off.alias("off"), F.col("rank"), F.col("id").isNull().alias("null"), F.col("id"), F.col("rid"))).alias("k"))
    closing = closing.select("source", F.col("k.rid").alias("closing"))
    extra = checkpointed(plan.join(closing, same(plan, closing), "left").select(plan["source"], "source_size", "target", "whole", (F.col("rest") <= 0).alias("none"), "closing"))
    x = small(extra, n_sources)
    out = marked.join(x, same(marked, x)).withColumn("extra", (~F.col("none") & (F.col("drawn") | F.coalesce(F.col("rid") == F.col("closing"), F.lit(False)))).cast("int"))
    out = out.withColumn("copies", F.when(F.col("size") > 0, F.least(F.col("whole") + F.col("extra"), F.lit(int(max_copies)))).otherwise(0).cast("int"))
    back = [F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)]
    return out.select(F.col("id").alias(id_col), marked["source"].alias(source_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"), *back)
