"""Readers of the parquet tables that the registered queries run over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` under ``sf_dir``; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
