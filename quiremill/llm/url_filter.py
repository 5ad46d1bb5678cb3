"""URL filters: host-suffix and path-prefix expressions, joined to rules on short hash prefixes. DataFrame operations only.

A URL is expanded into one expression for each *shape* that the rules have: a shape is a number of host labels and a
length of path. So ``http://a.b.org/en/12`` under the shapes (1, 1) and (2, 5) gives ``org/`` and ``b.org/en/1``. Rules
and expressions meet by the first bytes of their SHA-256; a match counts only if the whole digests agree. Of the rules
that fit, the longest wins; of equally long ones a block, then the smaller string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import ascii_lower, local_frame, small

ALLOW, BLOCK = "allow", "block"
#: Hex digits of a digest that the join uses.
PREFIX_HEX = 8


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, action) as a DataFrame."""
    return local_frame(spark, rules, "host string, path string, action string")


def host_and_path(url):
    """Columns for host and path of a URL. Null, or no ``://``: both are empty."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def _digested(df: DataFrame, expression: str) -> DataFrame:
    return df.withColumn("digest", F.sha2(F.col(expression), 256)).withColumn("short", F.left("digest", F.lit(PREFIX_HEX)))


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", keep: Sequence[str] = ("page_id",), default: str = ALLOW) -> DataFrame:
    """One row per row of ``df``: the ``keep`` columns, host, path, rule (like ``net/``; null if none fits) and verdict.

    Null and malformed URLs have an empty host and path, fit no rule and get the default. Equal rows are judged once and
    given out as often as they came, so that a URL that fills a third of the table costs one row. Rules may be repeated;
    null parts of rules fit nothing; an empty rule table leaves every row its default. Columns of ``df`` other than
    ``keep`` and ``url`` are ignored, whatever their names.
    """
    host, path = host_and_path(F.col(url))
    rows = df.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keep)), host.alias("host"), path.alias("path"))
    keys = rows.columns
    rows = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))

    rules = rules.where("host is not null and path is not null").dropDuplicates(["host", "path", "action"])
    listed = rules.select(F.concat("host", "path").alias("_rule"), F.col("action").alias("_action"), F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars"))
    # Bounded by the labels of a host name times the lengths of a path, not by the number of rules or URLs.
    shapes = sorted((r.labels, r.chars) for r in listed.select("labels", "chars").distinct().collect())

    parts = F.split("host", r"\.")
    made = [
        F.when((F.size(parts) >= n) & (F.length("path") >= chars), F.concat(F.array_join(F.slice(parts, -n, n), "."), F.substring("path", 1, chars)))
        for n, chars in shapes
    ]
    expressions = F.array_compact(F.array(*made)) if made else F.array().cast("array<string>")
    asked = _digested(rows.withColumn("_expression", F.explode_outer(expressions)), "_expression").withColumnRenamed("digest", "_digest")
    offered = small(_digested(listed.drop("labels", "chars"), "_rule"))
    # Longest first, then block before allow, then the smaller string: max_by over a struct would need inverted strings.
    best = F.min(F.when(F.col("_rule").isNotNull(), F.struct((-F.length("_rule")).alias("n"), (F.col("_action") != BLOCK).alias("a"), F.col("_rule").alias("rule"), F.col("_action").alias("action"))))
    judged = (
        asked.join(offered, (asked["short"] == offered["short"]) & (asked["_digest"] == offered["digest"]), "left")
        .groupBy(*keys)
        .agg(best.alias("_best"), F.first("_copies").alias("_copies"))
    )
    return judged.select(
        *(F.col(f"_k{i}").alias(k) for i, k in enumerate(keep)), "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.action"), F.lit(default)).alias("verdict"), F.explode(F.expr("sequence(1L, _copies)")).alias("_copy"),
    ).drop("_copy")
