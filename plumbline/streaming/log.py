"""The outcome log as a stream: an extension of the batch operators, with the same results on what has arrived.

The log itself has no late data rules; here a watermark bounds how long a redelivery may lag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.schemas import MANIFEST


def log_stream(spark: SparkSession, path: str, schema: str = MANIFEST) -> DataFrame:
    """Records of JSON-lines files as they are added to a folder."""
    return spark.readStream.schema(schema).json(path)


def once(stream: DataFrame, key: str, time: str, lag: str) -> DataFrame:
    """Each record once: redeliveries within ``lag`` are dropped by keyed state that the watermark clears."""
    return stream.withWatermark(time, lag).dropDuplicatesWithinWatermark([key])


def status_by_window(stream: DataFrame, time: str, width: str, lag: str) -> DataFrame:
    """Counts of each status in tumbling windows; rows later than ``lag`` are left out."""
    return stream.withWatermark(time, lag).groupBy(F.window(time, width), "status").agg(F.count("*").alias("n")).select("window.start", "status", "n")


def append_new(stream: DataFrame, target: str, key: str, checkpoint: str) -> StreamingQuery:
    """Resumable indexing: each batch adds only rows whose key the parquet target doesn't hold yet; a batch that is repeated adds nothing."""

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates([key])
        try:
            rows = rows.join(spark.read.parquet(target).select(key), key, "left_anti")
        except Exception as e:  # first batch: no target yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        rows.write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
