"""An extension of ours: blocks of documents that arrive, by the batch operators. The reference has no streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.operators import blocks


def arriving(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    """A stream of parquet files that are put under ``path``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def blocks_sink(out: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: numbers a batch's documents' lines and writes them under the batch's own folder, so that a batch that is run again replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        blocks.numbered(blocks.lines_as_blocks(batch)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return write


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Events by type and window of time; rows later than ``late`` are left out by the watermark."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return e.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
