"""Identity of citations: title similarity, identity score, the best copy of a request."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from plumbline.functions.text import normalize_title
from plumbline.plans.columns import col
from plumbline.plans.lineage import cut
from plumbline.plans.sizing import broadcast_if_small

#: Titles at or above THRESHOLD name the same work; a found title inside the requested one counts from this share of its length; score of a keyed record that doesn't repeat its DOI.
THRESHOLD, PART_SCORE, PART_SHARE, SILENT_KEYED, TIE = 0.82, 0.95, 0.6, 0.9, 1e-9


#: Hosts up to which the allowed ones are broadcast; more are joined by shuffle.
SMALL_HOSTS = 200_000


def _ratios(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in pairs:
        yield pd.Series([None if a is None or b is None else SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right)], dtype="float64")


def title_similarity(requested: Column | str, found: Column | str) -> Column:
    """1 for equal normalized titles, 0.95 for most of the requested one, else the sequence ratio; added words before it stay below the threshold.

    Guards run in the JVM; only pairs that none of them settles carry text to the Arrow function that computes the ratio.
    """
    a, b = F.coalesce(normalize_title(requested), F.lit("")), F.coalesce(normalize_title(found), F.lit(""))
    empty = (a == "") | (b == "")
    part = F.contains(a, b) & (F.length(b) / F.length(a) >= PART_SHARE)
    settled = empty | (a == b) | part
    ratio = F.pandas_udf(_ratios, DoubleType())(F.when(~settled, a), F.when(~settled, b))
    prepended = F.contains(b, a) & ~F.startswith(b, a)
    return F.when(empty, 0.0).when(a == b, 1.0).when(part, PART_SCORE).when(prepended, F.least(ratio, F.lit(THRESHOLD - 0.01))).otherwise(ratio)


def identity_score(requested_doi: Column | str, found_doi: Column | str, doi_keyed: Column | str, similarity: Column | str) -> Column:
    """How strongly a record proves to be the requested work."""
    asked, has = F.nullif(F.lower(F.trim(col(requested_doi))), F.lit("")), F.nullif(F.lower(F.trim(col(found_doi))), F.lit(""))
    like = F.coalesce(col(similarity), F.lit(0.0))
    return F.when(asked.isNull(), like).when(asked == has, 1.0).when(~F.coalesce(col(doi_keyed), F.lit(False)), 0.0).when(has.isNull(), SILENT_KEYED).otherwise(like)


def candidate_order(scored: DataFrame, group: str, score: str, verified: str, order: list[str]) -> DataFrame:
    """Adds ``pos``: candidates of a request by score, then verified copies, then their own order."""
    by = Window.partitionBy(group).orderBy(F.desc(score), F.desc(verified), *[F.asc(c) for c in order])
    return scored.withColumn("pos", F.row_number().over(by))


def pick_best(positioned: DataFrame, group: str, score: str, verified: str) -> DataFrame:
    """Adds ``is_best``: the first verified candidate of those that share the top score, else their first."""
    top = F.max(score).over(Window.partitionBy(group))
    tier = positioned.withColumn("_tier", F.col(score) >= top - TIE)
    by = Window.partitionBy(group).orderBy(F.desc("_tier"), F.desc(F.col("_tier") & F.col(verified)), F.asc("pos"))
    return tier.withColumn("is_best", F.row_number().over(by) == 1).drop("_tier")


def best_first(positioned: DataFrame, group: str, allowed: str | None = None) -> DataFrame:
    """Adds ``final_pos``: the best candidate, the other allowed ones, then the rest, each in order."""
    keys = [F.desc("is_best"), *([F.desc(allowed)] if allowed else []), F.asc("pos")]
    return positioned.withColumn("final_pos", F.row_number().over(Window.partitionBy(group).orderBy(*keys)))


def allowed_urls(urls: DataFrame, hosts: DataFrame, url: str = "url") -> DataFrame:
    """Rows whose host is on the list or below a host of the list: distinct hosts are joined by equality on their suffixes, and the rows by host, so an address is never a key."""
    from plumbline.functions.text import host, host_suffixes

    known = urls.withColumn("_host", host(url))
    distinct = known.select("_host").where("_host IS NOT NULL").distinct()
    ok = distinct.withColumn("_at", F.explode(host_suffixes("_host"))).join(hosts.select(host("host").alias("_at")).distinct(), "_at", "left_semi").select("_host").distinct()
    return known.join(broadcast_if_small(cut(ok), SMALL_HOSTS), "_host", "left_semi").drop("_host")
