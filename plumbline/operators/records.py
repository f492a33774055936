"""Published forms of results: nested records and JSON envelopes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.plans.columns import col


def promoted_urls(urls: Column | str, allowed: Callable[[Column], Column]) -> Column:
    """The allowed addresses, then the rest, each in order."""

    def test(u: Column) -> Column:
        return F.coalesce(allowed(u), F.lit(False))

    known = F.filter(col(urls), lambda u: u.isNotNull())
    return F.concat(F.filter(known, test), F.filter(known, lambda u: ~test(u)))


def alternatives(values: Column | str) -> Column:
    """The second to fourth of a list."""
    return F.slice(col(values), 2, 3)


def envelope(rows: DataFrame, by: list[str], order: str, fields: list[str], name: str) -> DataFrame:
    """One JSON text for each group: its keys, and its rows in order under ``name``."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*fields).alias("r")))), lambda x: x["r"])
    return rows.groupBy(*by).agg(listed.alias(name)).select(*by, F.to_json(F.struct(*by, name)).alias("json"))


def rotated(x0: Column, y0: Column, x1: Column, y1: Column, rotation: Column, width: Column, height: Column) -> Column:
    """A box of an unrotated page of ``width`` x ``height`` on the page as shown after a clockwise turn by a multiple of 90 degrees, corners in order."""
    turn = F.pmod(rotation, F.lit(360))
    corner = lambda x, y: F.when(turn == 90, F.struct((height - y).alias("x"), x.alias("y"))).when(turn == 180, F.struct((width - x).alias("x"), (height - y).alias("y"))).when(turn == 270, F.struct(y.alias("x"), (width - x).alias("y"))).otherwise(F.struct(x.alias("x"), y.alias("y")))
    a, b = corner(x0, y0), corner(x1, y1)
    return F.struct(F.least(a["x"], b["x"]).alias("x0"), F.least(a["y"], b["y"]).alias("y0"), F.greatest(a["x"], b["x"]).alias("x1"), F.greatest(a["y"], b["y"]).alias("y1"))


def resolution(rows: DataFrame) -> Column:
    """The ``resolution`` block of a published record, as readers of either tool's log expect it; without a paper its fields are null, its confidence 0 and its alternatives empty."""
    there = F.col("paper").isNotNull()
    other = F.transform(F.slice(F.coalesce("paper.pdf_urls", F.array().cast("array<string>")), 2, 3), lambda u: F.struct(u.alias("pdf_url")))
    source = F.nullif(F.array_join("paper.retrieval_sources", "+"), F.lit(""))
    return F.struct(
        F.col("paper.pdf_url").alias("pdf_url"), F.col("paper.doi").alias("doi"), F.col("paper.title").alias("matched_title"), F.when(there, F.col("paper.confidence")).otherwise(0.0).alias("confidence"),
        source.alias("source"), F.when(there, other).otherwise(F.slice(other, 1, 0)).alias("alternatives"), F.col("run.errors").alias("errors"),
    )


RUN = ("query_description", "expanded_queries", "expansion_error", "embedding_model", "min_similarity", "selection", "verified_window", "pool_size", "truncated_sources", "errors")


def run_metadata() -> Column:
    """What each record repeats of its run, so that a line stands for itself."""
    return F.struct(*[F.col(f"run.{c}").alias(c) for c in RUN])
