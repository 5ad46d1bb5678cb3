"""From raw documents to token ids: quality, near-duplicates, mixing, tokens. Each stage is written and read again.

A stage takes (spark, docs, sf_dir). docs are documents, or what the stage before kept; all but the last stage return the
columns of docs as they are. A stage's decisions hold for rows, by their id and a hash of all their columns: rows that share an id (or have none) are
judged each by its own text, and rows that are equal in all columns count as often as they stand there. Extra columns, whatever their names, are carried along. An
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm import bpe, mixing, ngram_join, quality
from quiremill.llm.common import checkpointed, delete, release, shared_path
from quiremill.llm.queries import RANKS
from quiremill.sources.tables import read


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a hash of all columns under a name that no column has."""
    name = "_key"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))), name


def _decided(docs: DataFrame, decisions: DataFrame, key: str, how: str, extra: str | None = None) -> DataFrame:
    """Rows of docs with a decision (doc_id, key, extra); a null id matches a null."""
    d = decisions.select(F.col("doc_id").alias("_decided_id"), F.col(key).alias("_decided_key"), *([F.col(extra).alias("_decided")] if extra else []))
    return docs.join(d, docs["doc_id"].eqNullSafe(d["_decided_id"]) & (docs[key] == d["_decided_key"]), how)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. Those without words go; rows whose noisy weight ties with the last one kept stay."""
    rows, key = _keyed(docs)
    kept = checkpointed(quality.resample(rows, read(spark, sf_dir, "labels"), keep=[key]).where("kept").select("doc_id", key).distinct())
    return _decided(rows, kept, key, "left_semi").select(*(rows[c] for c in docs.columns))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates (five words, Jaccard 0.8): the one with the smallest id (null ids last, ties by hash); rows equal in all columns are one. Documents without words all stay."""
    release(spark)  # what the stage before shuffled
    rows, key = _keyed(docs)
    kept = checkpointed(ngram_join.representatives(rows, key, size=5, num=80, den=100))
    columns = [rows[c] for c in docs.columns]
    if not kept.where("rows > 1").take(1):
        return _decided(rows, kept, key, "left_semi").select(*columns)
    single = _decided(rows, kept.where("rows = 1"), key, "left_semi").select(*columns)
    repeated = _decided(rows, kept.where("rows > 1"), key, "left_semi").dropDuplicates(["doc_id", key]).select(*docs.columns)
    return single.unionAll(repeated)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those that it doesn't take, and those without words, go. Rows equal in all columns are taken as often as the mix takes them together."""
    rows, key = _keyed(docs)
    taken = mixing.mix(rows, keep=[key]).groupBy("doc_id", key).agg(F.sum("copies").cast("int").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    taken = checkpointed(taken)
    if taken.where("rows > 1").take(1):
        rows = rows.dropDuplicates(["doc_id", key])
    found = _decided(rows, taken, key, "inner", "copies")
    return found.select(*(rows[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), F.col("_decided"))).alias("_decided_copy")).drop("_decided_copy")


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, their number, and whether decoding gave the text back. A null text has no ids; columns named ids, decoded, n_tokens or exact are replaced."""
    found = bpe.round_trip(docs, RANKS)
    return found.withColumn("n_tokens", F.size("ids").cast("long")).withColumn("exact", F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).drop("decoded")


STAGES = [("quality", quality_stage), ("near_duplicates", dedup_stage), ("mixing", mixing_stage), ("tokens", tokens_stage)]

#: SQL has neither the trained weights nor the links; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents under ``sf_dir``. What a stage wrote is deleted once the next one is written."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
