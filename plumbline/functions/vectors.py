"""Vector products: Column forms for single rows, Arrow blocks for a set of queries against all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.plans.columns import col
from plumbline.plans.shipping import ship


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product in double precision; 0 where a side is null or empty."""
    wide = lambda c: F.transform(col(c), lambda x: x.cast("double"))
    return F.coalesce(F.aggregate(F.zip_with(wide(a), wide(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x), F.lit(0.0))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of the angle between two vectors; 0 where one is null, empty or zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(F.lit(0.0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as one matrix without going through Python objects."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def products(rows: DataFrame, ident: str, vector: str, queries: DataFrame, query_id: str, query_vector: str, normalized: bool = True, keep: int | None = None, block: int = 4096, weight: Column | None = None) -> DataFrame:
    """``query_id, ident, score`` of every query against every row, or of the ``keep`` best rows of each query in each partition.

    The queries go out in blocks of at most ``block`` vectors, so what is broadcast is bounded; each block is one pass of dense products over
    Arrow batches. With ``keep`` only a partial top leaves a partition, so the shuffle that follows carries ``keep`` rows a query and task.
    ``weight`` multiplies a row's scores, before the best are taken. Rows and queries without a vector give nothing.
    """
    spark = rows.sparkSession
    ship(spark)
    schema = "query_id long, ident long, score double"
    slim = rows.select(F.col(ident).cast("long").alias("ident"), F.col(vector).alias("vec"), (F.lit(1.0) if weight is None else weight.cast("double")).alias("weight")).where("ident IS NOT NULL AND size(vec) > 0")
    asked = queries.select(F.col(query_id).cast("long").alias("q"), F.col(query_vector).alias("vec")).where("q IS NOT NULL AND size(vec) > 0")
    out: DataFrame | None = None

    def scan(ids: list[int], vectors: list[list[float]]) -> DataFrame:
        matrix = np.array(vectors, np.float64)
        if normalized:
            norms = np.linalg.norm(matrix, axis=1, keepdims=True)
            matrix = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
        shared = spark.sparkContext.broadcast((np.array(ids), matrix))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers, targets = shared.value
            best_score = best_id = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                m, own = _matrix(batch.column("vec")), batch.column("ident").to_numpy(zero_copy_only=False)
                if normalized:
                    norms = np.linalg.norm(m, axis=1, keepdims=True)
                    m = np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)
                scores = (targets @ m.T) * batch.column("weight").to_numpy(zero_copy_only=False)
                if keep is None:
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(numbers, len(own))), pa.array(np.tile(own, len(numbers))), pa.array(scores.ravel())], names=["query_id", "ident", "score"])
                    continue
                ids_here = np.broadcast_to(own, scores.shape)
                if best_score is not None:
                    scores, ids_here = np.hstack([best_score, scores]), np.hstack([best_id, ids_here])
                close = np.round(scores, 9)
                if scores.shape[1] > keep:  # only rows that reach the keep-th score of some query are sorted, ties at that score included
                    least = np.partition(close, -keep, axis=1)[:, -keep]
                    alive = np.flatnonzero((close >= least[:, None]).any(axis=0))
                    scores, ids_here, close = scores[:, alive], ids_here[:, alive], close[:, alive]
                order = np.lexsort((ids_here, -close), axis=1)[:, :keep]
                best_score, best_id = np.take_along_axis(scores, order, 1), np.take_along_axis(ids_here, order, 1)
            if best_score is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(numbers, best_id.shape[1])), pa.array(best_id.ravel()), pa.array(best_score.ravel())], names=["query_id", "ident", "score"])

        return slim.mapInArrow(run, schema)

    ids: list[int] = []
    vectors: list[list[float]] = []
    for row in asked.toLocalIterator():
        ids.append(row.q)
        vectors.append(list(row.vec))
        if len(ids) == block:
            part = scan(ids, vectors)
            out, ids, vectors = (part if out is None else out.unionByName(part)), [], []
    if ids:
        part = scan(ids, vectors)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)
