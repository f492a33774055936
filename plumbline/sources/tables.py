"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.plans.shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole table ``name`` below ``sf_dir``; a file or a folder of parts."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
