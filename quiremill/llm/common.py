"""What the training-data operators share: checkpoints in the shared folder and checked broadcasts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Rows up to which a table of a few narrow columns is broadcast after its rows were counted.
BROADCAST_ROWS = 20_000

#: A word, here and in the contracts: a maximal run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where that is unset, a temporary one in local mode, as in tests; on a cluster no folder of one machine will do."""
    found = spark.conf.get("spark.checkpoint.dir", None) or getattr(shared_dir, "own", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        found = shared_dir.own = tempfile.mkdtemp(prefix="quiremill-")
    return found


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so that no lost executor makes it be computed again."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/quiremill/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ours that nothing reads any more."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


#: Schema of counts that travel by blocks: a few rows a task, whatever the number of counters.
BLOCKS = "block int, counts binary"


def packed(counts: dict[int, np.ndarray]) -> pa.RecordBatch:
    """Rows (block, counts) of whole numbers of 64 bits."""
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array([c.tobytes() for c in counts.values()], pa.binary())], names=["block", "counts"])


def added(blocks: DataFrame) -> DataFrame:
    """The sums of all rows of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found[block] = found.get(block, 0) + np.frombuffer(counts.as_buffer(), np.int64)
        yield packed(found)

    return blocks.repartition("block").mapInArrow(run, BLOCKS)


#: How to drop what this worker keeps between its tasks, by operator.
_kept: dict[str, Callable[[], None]] = {}


def begin(operator: str, drop: Callable[[], None] | None = None) -> None:
    """Says whose task this worker begins. What it kept for others goes and its memory is given back, so that workers, which wait as long as there are tasks, hold one operator's tables and caches.

    drop: drops what ``operator`` is going to keep.
    """
    others = [o for o in _kept if o != operator]
    for o in others:
        _kept.pop(o)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library
            ctypes.CDLL(None).malloc_trim(0)
    if drop:
        _kept[operator] = drop


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files of finished phases: it acts when the driver's JVM drops their handles."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def local_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A DataFrame of a few rows held by the driver, made by SQL functions alone."""
    names = [c.split()[0] for c in schema.split(", ")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    kind = ", ".join(f"{c.split()[0]}: {c.split()[1]}" for c in schema.split(", "))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{kind}>>")))


def with_fields(kept: StructField, ddl: str) -> StructType:
    """A schema of one kept field and those of a DDL string."""
    return StructType([kept, *StructType.fromDDL(ddl).fields])


def small(df: DataFrame, rows: int | None = None, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``bound`` rows (counted unless given); else as it is."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= bound else df


def with_small(rows: DataFrame, few: DataFrame, key: str, by: str, salts: int = 16) -> DataFrame:
    """Inner join on ``key`` with a table of one row a key: broadcast if it is small enough, else dealt by a salt of ``by`` too, so that no key's rows are one task's."""
    n = few.count()
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(few), key)
    dealt = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by, F.lit("salt")), F.lit(salts)).cast("int")).join(dealt, [key, "_salt"]).drop("_salt")


def ascii_lower(column):
    """A-Z lower-cased, all else kept."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
