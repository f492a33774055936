"""Filling containers of fixed capacity: bulk-synchronous best fit over run-length-coded sizes and gaps."""

from __future__ import annotations

import base64
import os
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.plans.lineage import cut
from plumbline.plans.shipping import ship
from plumbline.plans.sizing import shuffle_partitions

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, ident: str, text: str, vocabulary: str = VOCABULARY, pattern: str | None = None) -> DataFrame:
    """``ident, tokens`` of every whole text; null texts give no row, empty texts have 0 tokens.

    The vocabulary file is read where the driver runs and sent to the executors with the job; ``pattern`` splits texts into words (None: that of the public tokenizers).
    """
    if not os.path.isfile(vocabulary):
        raise FileNotFoundError(f"no vocabulary file {vocabulary}")
    if pattern is None:
        from public_tokenizers import PATTERN as pattern
    ship(docs.sparkSession)
    docs.sparkSession.sparkContext.addFile(vocabulary)
    name = os.path.basename(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(SparkFiles.get(name), pattern).encode_ordinary
        for batch in batches:
            n = np.fromiter((len(encode(t)) for t in batch.column("text").to_pylist()), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("ident"), pa.array(n)], names=["ident", "tokens"])

    slim = docs.select(F.col(ident).cast("long").alias("ident"), F.col(text).alias("text")).where("ident IS NOT NULL AND text IS NOT NULL")
    return slim.mapInArrow(run, "ident long, tokens long")


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Placement of ``counts[size]`` items of each size up to ``capacity``: rows (size, first rank, first container, items a container), and the containers used.

    One superstep for each size, largest first. All items of the size, ranked, sweep over the gaps from the size's successor on: the
    item of rank r goes to container r // q of the sweep, where q items fill a container of that gap before any larger gap is a better fit,
    so no two items claim one place. The gaps are updated and the next size follows. Gaps are runs of neighbouring
    containers with equal gap, so the work depends on the number of different sizes (at most ``capacity``), not on the number of items,
    and the result is that of sequential best-fit decreasing.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first container, number)
    gaps: list[int] = []
    plan: list[tuple[int, int, int, int]] = []
    used = 0

    def add(gap: int, first: int, number: int) -> None:
        if gap > 0 and number > 0:
            if gap not in runs:
                runs[gap] = []
                insort(gaps, gap)
            runs[gap].append((first, number))

    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            k = bisect_left(gaps, size)
            if k < len(gaps):
                gap = gaps[k]
                first, number = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], gaps[k]
            else:
                gap, first, number = capacity, used, -(-left // (capacity // size))
                used += number
            fill = gap // size
            full = min(number, left // fill)
            if full:
                plan.append((size, rank, first, fill))
                add(gap - fill * size, first, full)
                rank, left = rank + full * fill, left - full * fill
            if full < number:
                if left:  # fewer than fill one container
                    plan.append((size, rank, first + full, left))
                    add(gap - left * size, first + full, 1)
                    rank, left, full = rank + left, 0, full + 1
                add(gap, first + full, number - full)
    return plan, used


def pieces(sizes: DataFrame, capacities: DataFrame) -> DataFrame:
    """``container, capacity, ident, piece, tokens``: texts cut only where one alone exceeds the capacity."""
    fits = capacities.where("capacity_tokens > 0").select("container", F.col("capacity_tokens").cast("long").alias("capacity"))
    cut_up = _with_capacities(sizes, fits).withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("tokens") / F.col("capacity")).cast("int") - 1))))
    return cut_up.select("container", "capacity", "ident", "piece", F.least("capacity", F.col("tokens") - F.col("piece") * F.col("capacity")).alias("tokens"))


def _with_capacities(sizes: DataFrame, fits: DataFrame) -> DataFrame:
    """Every text once for each kind of container; the kinds are a fixed, tiny table."""
    kinds = [F.struct(F.lit(r.container).alias("container"), F.lit(r.capacity).cast("long").alias("capacity")) for r in fits.distinct().orderBy("container", "capacity").collect()]
    kind = F.array(*kinds) if kinds else F.array().cast("array<struct<container:string,capacity:bigint>>")
    return sizes.withColumn("kind", F.explode(kind)).select("ident", "tokens", "kind.container", "kind.capacity")


def pack(docs: DataFrame, capacities: DataFrame, ident: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``container, container_no, ident, piece, tokens``: the container of every text for each kind of container.

    Texts are tokenized once, whole, where they lie; from then on only (identifier, length) moves. Items of one size are ranked
    in two levels, by size and hash bucket, so a length that a third of all texts share is still spread over all tasks. What reaches
    the driver is the number of items of each size, at most one row for each size up to the capacities; what is broadcast is the plan over
    these sizes, whose rows are at most the sizes times the different gaps they meet. Null texts and null identifiers are left out; empty texts take no space and lie in container 0; repeated rows are placed
    each; without texts or kinds of container there are no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    items = pieces(cut(token_counts(docs, ident, text, vocabulary)), capacities)
    buckets = shuffle_partitions(spark)
    items = items.withColumn("bucket", F.pmod(F.xxhash64("ident", "piece"), F.lit(buckets)))
    counted = items.groupBy("container", "capacity", "tokens", "bucket").agg(F.count("*").alias("n"))
    plans: dict[tuple[str, int], dict[int, int]] = {}
    for r in counted.groupBy("container", "capacity", "tokens").agg(F.sum("n").alias("n")).where("tokens > 0").collect():
        plans.setdefault((r.container, r.capacity), {})[r.tokens] = r.n
    made = {}
    for (container, capacity), counts in plans.items():
        rows = np.array(sorted(best_fit(counts, capacity)[0]), np.int64).reshape(-1, 4)
        sizes = np.array(sorted(counts), np.int64)
        before_size = np.cumsum([0, *[counts[x] for x in sizes.tolist()]])[:-1]  # items of smaller sizes: numbers all items from 0, whatever their sizes
        made[container, capacity] = (sizes, before_size, before_size[np.searchsorted(sizes, rows[:, 0])] + rows[:, 1], rows[:, 1], rows[:, 2], rows[:, 3])
    shared = spark.sparkContext.broadcast(made)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tokens", "rank"))
            number = np.zeros(batch.num_rows, np.int64)
            for (container, capacity), (sizes, before_size, start, first_rank, first, fill) in shared.value.items():
                same = pc.and_(pc.equal(batch.column("container"), container), pc.equal(batch.column("capacity"), capacity))
                own = np.flatnonzero(same.to_numpy(zero_copy_only=False).astype(bool) & (size > 0))
                row = np.searchsorted(start, before_size[np.searchsorted(sizes, size[own])] + rank[own], side="right") - 1
                number[own] = first[row] + (rank[own] - first_rank[row]) // fill[row]
            yield pa.RecordBatch.from_arrays(
                [batch.column("container"), pa.array(number), batch.column("ident"), batch.column("piece"), batch.column("tokens")],
                names=["container", "container_no", "ident", "piece", "tokens"],
            )

    kind = ["container", "capacity", "tokens"]
    before = counted.withColumn("before", F.expr("sum(n) OVER (PARTITION BY container, capacity, tokens ORDER BY bucket) - n")).drop("n")
    ranked = items.withColumn("place", F.expr("row_number() OVER (PARTITION BY container, capacity, tokens, bucket ORDER BY ident, piece)")).join(before, [*kind, "bucket"])
    ranked = ranked.select("container", "capacity", "ident", "piece", "tokens", (F.col("place") - 1 + F.col("before")).alias("rank"))
    return ranked.mapInArrow(place, "container string, container_no long, ident long, piece int, tokens long")
