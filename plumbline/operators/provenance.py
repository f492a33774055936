"""The append-only log of outcomes: last record of a path, counts, resumable indexing, alternate hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import base_name, title_from_path


def downloaded_entries(log: DataFrame, order: list[str]) -> DataFrame:
    """``path, query, title, doi, first_seen``: the last downloaded record of each file name, at the place of its first."""
    place = F.struct(*order)
    title = F.coalesce(F.nullif(F.col("paper.title"), F.lit("")), F.nullif(F.col("resolution.matched_title"), F.lit("")), title_from_path("path"))
    doi = F.coalesce(F.nullif(F.col("paper.doi"), F.lit("")), F.col("resolution.doi"))
    rows = log.where("status = 'downloaded' AND path IS NOT NULL AND path <> ''").select(
        base_name("path").alias("path"), F.coalesce("query", F.lit("")).alias("query"), title.alias("title"), doi.alias("doi"), place.alias("_at")
    )
    last = F.max_by(F.struct("query", "title", "doi"), "_at").alias("last")
    return rows.groupBy("path").agg(last, F.min("_at").alias("_first")).select("path", "last.*", F.col(f"_first.{order[-1]}").alias("first_seen"))


def distinct_queries(entries: DataFrame) -> DataFrame:
    """Queries in order of their first entry."""
    first = entries.groupBy("query").agg(F.min("first_seen").alias("first_seen"), F.count("*").alias("n_files"))
    return first


def resolve_query(entries: DataFrame, index: int | None = None) -> str:
    """The one query of a set of entries, or the one at ``index``; more than one without an index is an error, not a guess."""
    found = distinct_queries(entries).orderBy("first_seen").select("query").limit((index or 0) + 2).collect()
    if index is None and len(found) > 1:
        raise ValueError("several queries; name one by its index")
    if not found or (index or 0) >= len(found):
        raise ValueError("no such query")
    return found[index or 0].query


def status_counts(log: DataFrame) -> DataFrame:
    """Number of records of each status; statuses without records have no row."""
    return log.groupBy("status").agg(F.count("*").alias("n"))


def not_indexed(pages: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Pages that a store doesn't hold yet."""
    return pages.join(stored.select(*keys), keys, "left_anti")


def upsert(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Stored rows without those that come anew, and the new ones."""
    return stored.join(new.select(key), key, "left_anti").unionByName(new)


def first_success(attempts: DataFrame, by: list[str]) -> DataFrame:
    """For each group the first attempt (``url, pos, ok, reason``) that succeeded; where none did, all reasons in order."""
    reasons = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("ok"), F.struct("pos", "reason")))), lambda x: x["reason"]), "; ")
    out = attempts.groupBy(*by).agg(F.min_by("url", F.when(F.col("ok"), F.col("pos"))).alias("url"), reasons.alias("_reasons"))
    return out.withColumn("detail", F.when(F.col("url").isNull(), F.col("_reasons"))).drop("_reasons")


def run_cost(records: DataFrame) -> DataFrame:
    """Adds ``cpu_percent``: CPU time as a share of wall time, to one decimal; null without wall time."""
    return records.withColumn("cpu_percent", F.when(F.col("wall_seconds") > 0, F.round(100 * F.col("cpu_seconds") / F.col("wall_seconds"), 1)))


def latest_by_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; one aggregation with partial maxima, no sort of a whole group."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")).select(*keys, "_last.*")


def already_there(works: DataFrame, files: DataFrame, ident: str, names: str) -> DataFrame:
    """``ident, path`` of works of which a file lies under the name of any of their copies: names are exploded and joined by equality with the files' base names; the first copy's file counts."""
    each = works.select(F.col(ident), F.posexplode(names).alias("_pos", "_name"))
    there = files.where("path IS NOT NULL").select(base_name("path").alias("_name"), "path").groupBy("_name").agg(F.min("path").alias("path"))
    return each.join(there, "_name").groupBy(ident).agg(F.min_by("path", "_pos").alias("path"))


def with_entries(files: DataFrame, entries: DataFrame) -> DataFrame:
    """Every file with the title, DOI and query of its entry in the log, null where the log has none."""
    known = entries.select(F.col("path").alias("_name"), "query", "title", "doi")
    return files.withColumn("_name", base_name("path")).join(known, "_name", "left").withColumn("title", F.coalesce("title", title_from_path("path"))).drop("_name")
