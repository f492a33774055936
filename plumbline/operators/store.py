"""A store of page vectors as a table partitioned by model; a point's key is a digest of its file, page and model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import uuid5
from plumbline.operators.provenance import not_indexed, upsert

#: Fixed value: bytes of one stored number.
NUMBER = 4


def point_id(namespace: str, sha: Column, page_no: Column, model: Column) -> Column:
    """The same page of the same file under the same model always has the same key."""
    return uuid5(namespace, F.concat_ws(":", sha, page_no.cast("string"), model))


def create(points: DataFrame, path: str) -> None:
    """Write an empty store with the columns of ``points``, unless there is one."""
    points.limit(0).write.mode("ignore").partitionBy("model").parquet(path)


def read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def indexed_pages(store: DataFrame, sha: str, model: str) -> DataFrame:
    """Numbers of the pages of a file that the store holds for a model: one partition, one column, no vectors."""
    return store.where((F.col("model") == model) & (F.col("pdf_sha") == sha)).select("page_no").distinct()


def to_index(pages: DataFrame, store: DataFrame) -> DataFrame:
    """Pages that are still to be embedded."""
    return not_indexed(pages, store, ["pdf_sha", "page_no", "model"])


def replaced(store: DataFrame, points: DataFrame) -> DataFrame:
    """The store with new points put in the place of old ones of the same key."""
    return upsert(store, points.dropDuplicates(["point_id"]), "point_id")


def stored_bytes(vectors: DataFrame, by: list[str], vector: str = "vec") -> DataFrame:
    """Vectors and bytes of each group."""
    return vectors.groupBy(*by).agg(F.count("*").alias("n_vectors"), (F.sum(F.size(vector)) * NUMBER).alias("n_bytes"))
