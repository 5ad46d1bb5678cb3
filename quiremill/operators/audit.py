"""Audits of one rendition against another: shingle alignment, scores by section, reading order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiremill.functions.text import shingles, words

SHINGLE = 8


def shingle_rows(blocks: DataFrame, keep: list[str], size: int = SHINGLE) -> DataFrame:
    """Each shingle of each block with its position."""
    # Words are a column of their own: inside the lambda over positions they would be split anew at each.
    return blocks.select(*keep, words(F.col("text")).alias("_words")).select(*keep, F.posexplode(shingles(F.col("_words"), size)).alias("at", "shingle"))


def shingle_index(reference: DataFrame, value: str, group: list[str], size: int = SHINGLE) -> DataFrame:
    """A7. (group, shingle, value): shingles that stand under one value only."""
    rows = shingle_rows(reference, [*group, value], size)
    return rows.groupBy(*group, "shingle").agg(F.min(value).alias(value), F.max(value).alias("_max")).where(F.col(value) == F.col("_max")).drop("_max")


def voted(blocks: DataFrame, index: DataFrame, value: str, key: list[str], group: list[str], size: int = SHINGLE) -> DataFrame:
    """J8. For each block that shares a shingle with the index: the value with the most votes (ties: the one met first), votes and shared shingles."""
    rows = shingle_rows(blocks, list(dict.fromkeys([*group, *key])), size)
    hits = rows.join(index, [*group, "shingle"]) if group else rows.join(index, "shingle")
    votes = hits.groupBy(*dict.fromkeys([*group, *key]), value).agg(F.count(F.lit(1)).alias("votes"), F.min("at").alias("first"))
    best = votes.groupBy(*dict.fromkeys([*group, *key])).agg(F.max_by(value, F.struct("votes", -F.col("first"))).alias(value), F.max("votes").alias("votes"), F.sum("votes").alias("shared"))
    return best


def section_scores(pairs: DataFrame, group: str = "slug") -> DataFrame:
    """A6. Precision and recall per section. pairs: (slug, reference, candidate); a null candidate counts against recall only."""
    tp = F.col("reference").eqNullSafe(F.col("candidate"))
    by_ref = pairs.where("reference is not null").groupBy(group, F.col("reference").alias("section")).agg(F.count_if(tp).alias("tp"), F.count_if(~tp).alias("fn"), F.lit(0).cast("long").alias("fp"))
    by_cand = pairs.where("candidate is not null").groupBy(group, F.col("candidate").alias("section")).agg(F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fn"), F.count_if(~tp).alias("fp"))
    s = by_ref.unionByName(by_cand).groupBy(group, "section").agg(F.sum("tp").alias("tp"), F.sum("fn").alias("fn"), F.sum("fp").alias("fp"))
    return s.withColumn("precision", F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")))


def confusions(pairs: DataFrame, group: str = "slug") -> DataFrame:
    """A6. What was labelled as what, most often first."""
    wrong = pairs.where(~F.col("reference").eqNullSafe(F.col("candidate")))
    return wrong.groupBy(group, "reference", "candidate").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reference", "candidate")


def reading_order(aligned: DataFrame, group: str = "slug", order: str = "index", place: str = "place") -> DataFrame:
    """A19, J9, W12. Steps backward between neighbours and pairs out of order, with their fractions.

    A pair out of order is counted at its later member: places above its own that came before. One fold per document, whose blocks are capped.
    """
    w = Window.partitionBy(group).orderBy(order)
    steps = aligned.withColumn("_back", (F.col(place) < F.lag(place).over(w)).cast("int"))
    listed = steps.groupBy(group).agg(F.count(F.lit(1)).alias("blocks"), F.sum(F.coalesce("_back", F.lit(0))).alias("backward_steps"), F.transform(F.array_sort(F.collect_list(F.struct(order, place))), lambda x: x[place]).alias("_p"))
    inverted = F.aggregate(
        F.transform("_p", lambda x, i: F.size(F.filter(F.slice("_p", F.lit(1), i), lambda y: y > x)).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b
    )
    n = F.col("blocks")
    out = listed.withColumn("inverted_pairs", inverted)
    return out.select(group, "blocks", "backward_steps", "inverted_pairs", F.try_divide(F.col("backward_steps"), n - 1).alias("backward_fraction"), F.try_divide(F.col("inverted_pairs"), (n * (n - 1) / 2)).alias("inverted_fraction"))


def regressions(now: DataFrame, before: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """J12. What got worse: keys, measure now and before."""
    j = now.select(*keys, F.col(measure).alias("now")).join(before.select(*keys, F.col(measure).alias("before")), keys)
    return j.where(F.col("now") < F.col("before"))


def without_pair(a: DataFrame, b: DataFrame, key: str = "slug") -> DataFrame:
    """C15. Keys that only one rendition has, so that nothing can be audited."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti").withColumn("lacks", F.lit("reference")).unionAll(b.select(key).distinct().join(a.select(key).distinct(), key, "left_anti").withColumn("lacks", F.lit("candidate")))
