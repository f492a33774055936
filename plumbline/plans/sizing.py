"""How many partitions a plan stage gets, and which tables may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only when a bounded count proves ``df`` has at most ``max_rows`` rows; else leave a shuffle join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
