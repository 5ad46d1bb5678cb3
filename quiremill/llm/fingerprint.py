"""Document fingerprints by one-permutation MinHash. DataFrame operations only.

Every shingle of ``SHINGLE`` words is hashed once, to 64 bits: the high bits name its bin, and a bin keeps its smallest
hash. Empty bins are filled by optimal densification: bin j tries the bins h(j, 1), h(j, 2), ... and takes the first that
has a hash. h(j, .) puts all bins in an order drawn at random for each j, so that the tries end, and take each filled bin
with the same chance. A fingerprint packs the low ``BITS`` bits of each bin. Of two fingerprints a share E of bins agrees, by chance a share C = 2 ** -BITS, so the likeness is
(E - C) / (1 - C), not below 0.

Words are lower-cased. A text of fewer words than a shingle has one shingle, all its words. A text without words (null,
empty, only white space) has the empty fingerprint, which is like itself only.
"""

from __future__ import annotations

import functools
import json

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiremill.llm.common import checkpointed, small

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 8
#: Tries are made in stretches that end here; a text with many filled bins seldom needs the second.
STRETCHES = (8, 40, BINS)
_SHIFT = 64 - BIN_BITS
_LOW = (1 << _SHIFT) - 1


def _sentinels():
    """The largest hash of each bin, as signed longs: what a bin holds that got no smaller one."""
    return F.array(*(F.lit((b << _SHIFT | _LOW) - (1 << 64 if b >= BINS // 2 else 0)).cast("long") for b in range(BINS)))


@functools.cache
def probes() -> str:
    """The order in which each bin tries the others, as JSON: rows of numbers of bins."""
    return json.dumps([np.random.default_rng([29, j]).permutation(BINS).tolist() for j in range(BINS)])


def _empty(x):
    return x.bitwiseAND(F.lit(_LOW)) == F.lit(_LOW)


def with_bins(df: DataFrame, text, out: str, size: int = SHINGLE) -> DataFrame:
    """``df`` with column ``out``: the low bits of the bins as ARRAY<TINYINT>, empty for a text without words.

    Each step is a column of its own where the next one uses it more than once, so that it is computed once a row.
    """
    keep = [F.col(f"`{c}`") for c in df.columns]
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    df = df.select(*keep, F.transform(words, lambda w: F.xxhash64(w)).alias("_w"))
    n = F.size("_w")
    shingles = F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*(F.get("_w", i + k) for k in range(size))))).when(n > 0, F.array(F.xxhash64("_w"))).otherwise(F.array().cast("array<bigint>"))
    df = df.select(*keep, (n > 0).alias("_any"), F.sort_array(F.concat(shingles, _sentinels())).alias("_s"))
    bin_of = lambda x: F.shiftrightunsigned(x, _SHIFT)
    first = F.filter("_s", lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get("_s", i - 1))))
    df = df.select(*keep, "_any", first.alias("_d"))
    order = F.from_json(F.lit(probes()), "array<array<int>>")

    def settled(x, j):
        spans = zip((0, *STRETCHES), STRETCHES, strict=False)
        tries = [F.get(F.filter(F.slice(F.get(order, j), lo + 1, hi - lo), lambda q: ~_empty(F.get("_d", q))), F.lit(0)) for lo, hi in spans]
        return F.when(~_empty(x), x).otherwise(F.get("_d", F.coalesce(*tries)))

    packed = F.transform("_d", lambda x, j: (settled(x, j).bitwiseAND(F.lit((1 << BITS) - 1)) - (1 << BITS - 1)).cast("tinyint"))
    return df.select(*keep, F.when(F.col("_any"), packed).otherwise(F.array().cast("array<tinyint>")).alias(out))


def likeness(a: str, b: str):
    """Estimate of the Jaccard similarity of the shingle sets behind two bin columns, from 0 to 1."""
    agree = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.get(a, j) == F.get(b, j))) / F.lit(float(BINS))
    chance = 2.0**-BITS
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0)).otherwise(F.greatest(F.lit(0.0), (agree - chance) / (1 - chance)))


def as_hex(bins: str):
    """Two hex digits a bin."""
    table = F.array(*(F.lit(f"{b:02x}") for b in range(1 << BITS)))
    return F.array_join(F.transform(bins, lambda x: F.get(table, x.cast("int") + (1 << BITS - 1))), "")


def next_keys(rows: DataFrame) -> DataFrame:
    """(id, h, k, next_id, next_h) for each distinct (id, h) of rows (id, h, n): the next by descending id, after the last the first.

    Rows are dealt by ranges of ids; a window looks back within a range, and the largest key of each range (a row a
    range) links the ranges.
    """
    key = [F.col("id").asc_nulls_first(), F.col("h").asc()]
    ranged = rows.groupBy("id", "h").agg(F.max("n").alias("n")).repartitionByRange(*key).withColumn("part", F.spark_partition_id())
    ranged = checkpointed(ranged)
    ends = ranged.groupBy("part").agg(F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "h")).alias("top"))
    by_part = Window.orderBy("part")
    ends = ends.select("part", F.coalesce(F.lag("top").over(by_part), F.last("top").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("below"))
    back = F.lag(F.struct(F.col("id").isNotNull().alias("known"), "id", "h")).over(Window.partitionBy("part").orderBy(*key))
    linked = ranged.withColumn("back", back).join(small(checkpointed(ends)), "part").withColumn("nx", F.coalesce("back", "below"))
    return linked.select("id", "h", F.floor(F.col("n") / 2).cast("int").alias("k"), F.col("nx.id").alias("next_id"), F.col("nx.h").alias("next_h"))


def fingerprints_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Whole texts are read, however long: a row holds its text, its words' hashes and its bins. The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as many (or all) of
    the next document's by descending id; null ids come last. Null texts count as empty. Rows with one id are ordered by a hash of
    their texts; rows that are equal in both are one document to their neighbours, and each gets a row. A lone document
    is its own next one. Other columns of ``df`` are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), text.alias("text")).select("id", F.xxhash64("text").alias("h"), "text")
    nexts = checkpointed(next_keys(rows.select("id", "h", F.length("text").alias("n"))))
    repeated = df.count() > nexts.count()

    full = with_bins(rows, F.col("text"), "bins")
    same = lambda a, b, i, h: a["id"].eqNullSafe(b[i]) & (a["h"] == b[h])
    given = nexts.select(F.col("id").alias("to_id"), F.col("h").alias("to_h"), "k", "next_id", "next_h")
    heads = full.join(given, same(full, given, "next_id", "next_h")).select("to_id", "to_h", "k", F.left("text", F.col("k")).alias("head"), F.col("bins").alias("next_bins"))
    if repeated:
        heads = heads.groupBy("to_id", "to_h").agg(F.any_value("k").alias("k"), F.any_value("head").alias("head"), F.any_value("next_bins").alias("next_bins"))
    own = full.join(heads, same(full, heads, "to_id", "to_h"))
    n = F.length("text")
    edited = own.select("id", n.alias("n_chars"), "bins", "next_bins", F.concat(F.left("text", n - F.col("k")), "head").alias("edited"))
    edited = with_bins(edited, F.col("edited"), "edited_bins")
    return edited.select(
        F.col("id").alias(id_col), F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), as_hex("bins").alias("fingerprint"),
        as_hex("edited_bins").alias("edited_fingerprint"), likeness("bins", "edited_bins").alias("near_edited"), likeness("bins", "next_bins").alias("near_next"),
    )
