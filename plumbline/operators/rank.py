"""Ranking of works: similarity, penalty, floor, top-k and fetchable-first selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the ranking: floor, penalty of a bare title, works kept, probes a round and in all, discount of an unverified copy.
FLOOR, TITLE_ONLY, TOP_K, PROBES_PER_K, MAX_PROBES, UNVERIFIED = 0.70, 0.85, 5, 3, 45, 0.7


def penalized(score: Column, title_only: Column) -> Column:
    """A work known by its title alone scores less."""
    return score * F.when(title_only, TITLE_ONLY).otherwise(1.0)


def confidence(score: Column, verified: Column) -> Column:
    """Score, discounted where no copy was verified."""
    return F.round(score * F.when(verified, 1.0).otherwise(UNVERIFIED), 3)


#: Steps of a score range: a group is sorted in pieces of one step each, so no task sorts the whole pool of a query.
STEPS = 4096


def step(score: Column) -> Column:
    """Which piece of a group a score lies in; larger scores in larger steps, NaN in the last, null in the first."""
    return F.when(score.isNull(), F.lit(-(1 << 62))).when(F.isnan(score), F.lit(1 << 62)).otherwise(F.floor(F.greatest(F.lit(-1e12), F.least(F.lit(1e12), score)) * STEPS)).cast("long")


def ranked(scored: DataFrame, group: str, score: str, order: str, floor: float = FLOOR) -> DataFrame:
    """Adds ``similarity_rank`` among the rows of a group at or above the floor, best first, ties in pool order.

    Exact ranks of whole groups: rows are numbered within their step of the score range and the counts of higher steps, summed before any
    shuffle, are added, so a group that holds a third of all rows is spread over its steps.
    """
    rows = scored.where(F.col(score) >= floor).withColumn("_step", step(F.col(score)))
    counts = rows.groupBy(group, "_step").agg(F.count("*").alias("_n"))
    higher = Window.partitionBy(group).orderBy(F.desc("_step")).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col(group).alias("_g"), F.col("_step").alias("_s"), F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_before"))
    by = Window.partitionBy(group, "_step").orderBy(F.desc(score), F.asc(order))
    numbered = rows.withColumn("_k", F.row_number().over(by)).join(before, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_step") == F.col("_s")))
    return numbered.withColumn("similarity_rank", (F.col("_k") + F.col("_before")).cast("int")).drop("_step", "_k", "_before", "_g", "_s")


def best_ranked(scored: DataFrame, group: str, score: str, order: str, k: int = TOP_K, floor: float = FLOOR) -> DataFrame:
    """The first ``k`` ranks of each group. The bound stands beside the window, so each input partition keeps ``k`` rows of a group before the shuffle."""
    by = Window.partitionBy(group).orderBy(F.desc(score), F.asc(order))
    return scored.where(F.col(score) >= floor).withColumn("similarity_rank", F.row_number().over(by)).where(F.col("similarity_rank") <= k)


def top_k(rows: DataFrame, k: int = TOP_K) -> DataFrame:
    """The first ``k`` ranks of each group."""
    return rows.where(F.col("similarity_rank") <= k)


def fetchable_first(rows: DataFrame, group: str, score: str, ok: str, k: int = TOP_K) -> DataFrame:
    """Works that can be fetched first, then the best of the rest; ``rank`` orders the kept ones by similarity again.

    ``rows`` carry ``similarity_rank``. Only a window of ranks is probed: it widens by ``3 k`` until ``k`` copies are verified, to 45 at most; the closed
    form of that loop needs only the rank of the k-th verified row. Rows beyond the window count as unverified, so the first 45 (or ``k``) ranks decide. Adds ``pdf_verified``.
    """
    rows = rows.where(F.col("similarity_rank") <= max(MAX_PROBES, k))
    w = Window.partitionBy(group)
    limit = F.least(F.max("similarity_rank").over(w), F.lit(MAX_PROBES))
    good = F.col(ok) & (F.col("similarity_rank") <= limit)
    nth = F.sum(good.cast("int")).over(w.orderBy("similarity_rank").rowsBetween(Window.unboundedPreceding, 0))
    kth = F.min(F.when(good & (F.col("_nth") == k), F.col("similarity_rank"))).over(w)
    step = F.lit(PROBES_PER_K * k)
    window = F.coalesce(F.least(limit, F.ceil(F.col("_kth") / step) * step), limit)
    probed = rows.withColumn("_nth", nth).withColumn("_kth", kth).withColumn("verified_window", window.cast("int"))
    probed = probed.withColumn("pdf_verified", F.col(ok) & (F.col("similarity_rank") <= F.col("verified_window")))
    place = F.row_number().over(w.orderBy(F.desc("pdf_verified"), F.asc("similarity_rank")))
    kept = probed.withColumn("_place", place).where(F.col("_place") <= k)
    final = F.row_number().over(w.orderBy(F.desc(score), F.desc("pdf_verified"), F.asc("similarity_rank")))
    return kept.withColumn("rank", final).drop("_nth", "_kth", "_place")
