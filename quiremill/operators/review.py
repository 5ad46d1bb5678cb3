"""Review answers: the last one counts, stale ones don't, states, queues, and what answers change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiremill.limits import DEFAULT, Limits

#: Order of questions in a queue.
KINDS = ("main_text", "header", "file", "label", "section", "sign_off")


def latest(answers: DataFrame, keys: list[str], order: str = "pos") -> DataFrame:
    """W8. The last answer to each question, with how many it replaces."""
    w = Window.partitionBy(*keys)
    a = answers.withColumn("_n", F.row_number().over(w.orderBy(F.col(order).desc()))).withColumn("replaced", F.count(F.lit(1)).over(w) - 1)
    return a.where("_n = 1").drop("_n")


def with_staleness(answers: DataFrame, files: DataFrame, key: str = "path") -> DataFrame:
    """J4. Adds stale: the file's digest is known now, was known then, and differs. Unknown on either side keeps the answer."""
    j = answers.join(files.select("slug", F.col(key), F.col("sha256").alias("_now")), ["slug", key], "left")
    return j.withColumn("stale", F.coalesce(F.col("source_sha256") != F.col("_now"), F.lit(False))).drop("_now")


def answered(queue: DataFrame, answers: DataFrame, keys: list[str]) -> DataFrame:
    """J3. Each question with its last answer: adds verdict, stale (bytes or card changed) and open."""
    a = answers.select(*keys, "verdict", "stale", F.col("card_fingerprint").alias("_fp"))
    j = queue.join(a, keys, "left")
    changed = F.coalesce(F.col("_fp") != F.col("card_fingerprint"), F.lit(False))
    j = j.withColumn("stale", F.coalesce("stale", F.lit(False)) | changed)
    return j.withColumn("open", F.col("verdict").isNull() | F.col("stale")).drop("_fp")


def states(questions: DataFrame, group: str = "slug") -> DataFrame:
    """W9. Per article stale, reviewed, partially_reviewed, queued or unreviewed, the first that holds."""
    a = questions.groupBy(group).agg(
        F.count(F.lit(1)).alias("questions"), F.count_if(F.col("open")).alias("open"), F.bool_or("stale").alias("_stale"), F.bool_or((F.col("kind") == "sign_off") & ~F.col("open")).alias("_signed"), F.count_if(~F.col("open")).alias("answered"),
    )
    state = F.when(F.col("_stale"), "stale").when((F.col("open") == 0) | F.col("_signed"), "reviewed").when(F.col("answered") > 0, "partially_reviewed").when(F.col("questions") > 0, "queued").otherwise("unreviewed")
    return a.select(group, "questions", "open", "answered", state.alias("state"))


def queue(questions: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """W13. Questions in order of kind and position, capped per article; ``hidden`` counts what the cap leaves out."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    w = Window.partitionBy("slug")
    q = questions.withColumn("_n", F.row_number().over(w.orderBy(rank, "pos"))).withColumn("_all", F.count(F.lit(1)).over(w))
    cap = limits.max_review_cards_per_article
    return q.where(F.col("_n") <= cap).withColumn("hidden", F.greatest(F.col("_all") - cap, F.lit(0))).withColumn("place", F.col("_n")).drop("_n", "_all")


def reviewed_sections(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """C4. A reviewer's section fills blocks that have none and is marked as such; answers: (slug, block_id, section)."""
    j = blocks.join(answers.select("slug", "block_id", F.col("section").alias("_s")), ["slug", "block_id"], "left")
    fills = F.col("section").isNull() & F.col("_s").isNotNull()
    return j.withColumn("section_source", F.when(fills, "review").otherwise(F.col("section_source"))).withColumn("section", F.coalesce("section", "_s")).drop("_s")


def card_fingerprint(header: Column, header_row: Column, n_columns: Column) -> Column:
    """C18. 16 hex digits of a card's shape; a missing header row reads None."""
    return F.left(F.sha2(F.concat_ws("#", F.array_join(header, "|", ""), F.coalesce(header_row.cast("string"), F.lit("None")), n_columns.cast("string")), 256), F.lit(16))


def overridden(cards: DataFrame, answers: DataFrame) -> DataFrame:
    """J14. Cards with a reviewer's header row: has_header false means none, null means not answered. answers: (slug, source_file, locator, header_row, has_header)."""
    j = cards.join(answers.select("slug", "source_file", "locator", F.col("header_row").alias("_r"), F.col("has_header").alias("_h")), ["slug", "source_file", "locator"], "left")
    row = F.when(F.col("_h").eqNullSafe(F.lit(False)), None).when(F.col("_r").isNotNull(), F.col("_r")).otherwise(F.col("header_row"))
    sure = F.col("_h").isNotNull() | F.col("_r").isNotNull()
    return j.withColumn("header_row", row).withColumn("header_confidence", F.when(sure, "confirmed").otherwise(F.col("header_confidence"))).drop("_r", "_h")


def unchanged(keys: DataFrame, stored: DataFrame) -> DataFrame:
    """C5. Articles whose extraction key and block digest are those stored; the rest must be extracted anew."""
    s = stored.select("slug", F.col("extraction_key").alias("_k"), F.col("blocks_sha256").alias("_b"))
    j = keys.join(s, "slug", "left")
    return j.withColumn("unchanged", F.coalesce((F.col("extraction_key") == F.col("_k")) & (F.col("blocks_sha256") == F.col("_b")), F.lit(False))).drop("_k", "_b")


def extraction_key(*parts: Column) -> Column:
    """C16. SHA-256 over the sorted JSON of what an extraction depends on."""
    return F.sha2(F.to_json(F.struct(*(p.alias(f"k{i:02d}") for i, p in enumerate(parts)))), 256)
