"""Top N rows of every group by secondary sort, streamed without buffering a group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.plans.shipping import ship


def _emit_first(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keeps the first ``n`` distinct identifiers of each run of equal groups; state is one group name and at most ``n`` identifiers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: object = None
        taken: list[object] = []
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            groups, ids = batch.column("grp"), batch.column("ident")
            changes = np.flatnonzero(pc.not_equal(groups.slice(1), groups.slice(0, rows - 1)).to_numpy(zero_copy_only=False)) + 1
            starts = [0, *changes.tolist(), rows]
            keep: list[int] = []
            for begin, end in zip(starts, starts[1:]):
                if (name := groups[begin].as_py()) != group:
                    group, taken = name, []
                at = begin
                while len(taken) < n and at < end:
                    if (ident := ids[at].as_py()) not in taken:
                        taken.append(ident)
                        keep.append(at)
                    at += 1
            if keep:
                yield batch.take(pa.array(keep, pa.int64()))

    return run


def top_n(df: DataFrame, group: str, score: str, rank: str, ident: str, n: int = 5) -> DataFrame:
    """The ``n`` best rows of each ``group``: score descending, then rank ascending with null last, then identifier ascending.

    ``group``, ``score``, ``rank`` and ``ident`` are column expressions such as ``paper.similarity``. Returns ``grp, ident, score, rank``.
    Each input partition is sorted where it lies and emits at most ``n`` rows a group, so a group that holds a third of all rows
    sends ``n`` rows a partition through the one shuffle; partitions by group are then sorted and streamed the same way.
    Rows whose group, score or identifier is null or whose score is NaN never count. An identifier that comes several times in a group counts
    once, with its best row. Groups of fewer rows return all; an empty table gives no rows; other columns of any name are ignored.
    """
    ship(df.sparkSession)
    rows = df.select(
        F.expr(group).alias("grp"), F.expr(ident).alias("ident"), F.expr(score).cast("double").alias("score"), F.expr(rank).cast("long").alias("rank")
    ).where("grp IS NOT NULL AND ident IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)")
    order = [F.col("grp"), F.desc("score"), F.asc_nulls_last("rank"), F.asc("ident")]
    local = rows.sortWithinPartitions(*order).mapInArrow(_emit_first(n), rows.schema)
    return local.repartition("grp").sortWithinPartitions(*order).mapInArrow(_emit_first(n), rows.schema)
