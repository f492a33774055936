"""Score distributions of pools: summary by index picks, survivors of floors, reports for each model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.rank import step

#: The two floors whose survivors are counted.
FLOORS = (0.70, 0.75)


def score_summary(scored: DataFrame, group: str, score: str) -> DataFrame:
    """Maximum, top tenth, median and minimum: picks from the descending scores at ``floor(share * n)``, no interpolation.

    Exact, without sorting a group: equal scores are counted before the shuffle, the counts of score steps find the one step that holds each pick, and only that step's scores are summed up.
    """
    values = scored.select(F.col(group).alias("_g"), F.col(score).cast("double").alias("_v")).groupBy("_g", "_v").agg(F.count("*").alias("_n")).withColumn("_step", step(F.col("_v")))
    steps = values.groupBy("_g", "_step").agg(F.sum("_n").alias("_n"))
    down = Window.partitionBy("_g").orderBy(F.desc("_step"))
    steps = steps.withColumn("_to", F.sum("_n").over(down)).withColumn("_all", F.sum("_n").over(Window.partitionBy("_g")))
    at = lambda share: F.least(F.col("_all") - 1, F.floor(F.lit(share) * F.col("_all")))
    picks = steps.withColumn("_pick", F.explode(F.array(*[F.struct(F.lit(s).alias("share"), at(s).alias("k")) for s in (0.1, 0.5)]))).where("_pick.k >= _to - _n AND _pick.k < _to")
    picks = picks.select(F.col("_g").alias("_pg"), F.col("_step").alias("_ps"), F.col("_pick.share").alias("share"), (F.col("_pick.k") - F.col("_to") + F.col("_n")).alias("_k"))
    inside = values.join(picks, F.col("_g").eqNullSafe(F.col("_pg")) & (F.col("_step") == F.col("_ps")))
    run = F.sum("_n").over(Window.partitionBy("_g", "share").orderBy(F.desc("_v")))
    hit = inside.withColumn("_run", run).where("_k < _run AND _k >= _run - _n").groupBy("_g").agg(*[F.max(F.when(F.col("share") == s, F.col("_v"))).alias(f"_p{k}") for k, s in enumerate((0.1, 0.5))])
    whole = values.groupBy("_g").agg(F.sum("_n").alias("pool_size"), F.max("_v").alias("_high"), F.min("_v").alias("_low")).withColumnRenamed("_g", group)
    joined = whole.join(hit, F.col(group).eqNullSafe(F.col("_g")), "left")
    return joined.select(group, "pool_size", *[F.round(c, 4).alias(n) for c, n in (("_high", "score_max"), ("_p0", "score_top10"), ("_p1", "score_median"), ("_low", "score_min"))])


def model_pools(models: list[str], pools: DataFrame) -> DataFrame:
    """Every model with every pool, as a bench runs them; the models are a stated list."""
    return pools.withColumn("model", F.explode(F.array(*[F.lit(m) for m in dict.fromkeys(models)])))


def floor_survivors(scored: DataFrame, group: str, score: str, title_only: str, floors: tuple[float, float] = FLOORS) -> DataFrame:
    """Works at or above each floor, and bare titles among those of the lower one."""
    low, high = floors
    return scored.groupBy(group).agg(
        F.count_if(F.col(score) >= low).alias("n_low"), F.count_if((F.col(score) >= low) & F.col(title_only)).alias("n_low_title_only"), F.count_if(F.col(score) >= high).alias("n_high")
    )
