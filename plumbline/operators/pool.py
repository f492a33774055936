"""The pool of candidates of a query: merging into works, truncation and first errors of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import normalize_title


def doi_norm(doi: Column) -> Column:
    return F.nullif(F.lower(F.trim(doi)), F.lit(""))


def work_keys(candidates: DataFrame) -> DataFrame:
    """Adds ``norm`` and ``key``: the first candidate of a normalized title fixes the key of all candidates with it.

    That is the DOI of the first candidate, missing or not, else the title itself; candidates without a normalized title are dropped.
    """
    rows = candidates.withColumn("norm", normalize_title("title")).where("norm <> ''")
    first = Window.partitionBy("query_id", "norm").orderBy("ordinal", "cand_id")
    doi = F.first(doi_norm(F.col("doi"))).over(first)
    return rows.withColumn("key", F.coalesce(doi, F.concat(F.lit("title:"), F.col("norm"))))


def _in_order(place: Column, value: Column) -> Column:
    """Distinct values of a group in order of their first appearance."""
    seen = F.transform(F.array_sort(F.collect_set(F.when(value.isNotNull(), F.struct(place.alias("p"), value.alias("v"))))), lambda x: x["v"])
    return F.array_distinct(seen)


def merge_works(candidates: DataFrame) -> DataFrame:
    """One row for each work of a query: first title, longest abstract, first DOI and landing page, copies and sources in order of appearance."""
    rows = work_keys(candidates).withColumn("place", F.struct("ordinal", "cand_id"))
    place = F.col("place")

    def first(c: str) -> Column:
        return F.min_by(c, F.when(F.nullif(F.col(c), F.lit("")).isNotNull(), place))

    longest = F.max_by("abstract", F.when(F.length("abstract") > 0, F.struct(F.length("abstract"), -F.col("ordinal"), -F.col("cand_id"))))
    return rows.groupBy("query_id", "key").agg(
        F.min_by("title", place).alias("title"), longest.alias("abstract"), first("doi").alias("doi"), first("landing_url").alias("landing_url"),
        _in_order(place, F.nullif(F.col("pdf_url"), F.lit(""))).alias("pdf_urls"), _in_order(place, F.col("source")).alias("retrieval_sources"),
        F.array_sort(F.collect_set("query_index")).alias("matched_queries"), F.count("*").alias("n_candidates"),
    )


def truncated_sources(candidates: DataFrame, per_source: int = 20) -> DataFrame:
    """For each query the sources of which a job returned at least ``per_source`` candidates."""
    jobs = candidates.groupBy("query_id", "source", "query_index").count().where(F.col("count") >= per_source)
    return jobs.groupBy("query_id").agg(F.array_sort(F.collect_set("source")).alias("truncated_sources"))


def first_errors(jobs: DataFrame) -> DataFrame:
    """``query_id, errors``: the first failure of each source in job order (``source, error, ordinal``)."""
    first = jobs.where("error IS NOT NULL").groupBy("query_id", "source").agg(F.min_by("error", "ordinal").alias("error"))
    return first.groupBy("query_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "error")))).alias("errors"))


def expanded_queries(queries: DataFrame) -> DataFrame:
    """Description first, then its variants, each text once without regard to case (``query_id, pos, text``)."""
    once = Window.partitionBy("query_id", F.lower("text")).orderBy("pos")
    kept = queries.where("text IS NOT NULL AND trim(text) <> ''").withColumn("_n", F.row_number().over(once)).where("_n = 1").drop("_n")
    return kept.withColumn("query_index", F.row_number().over(Window.partitionBy("query_id").orderBy("pos")) - 1)


def fan_out(queries: DataFrame, sources: list[str]) -> DataFrame:
    """``query_id, query_index, source, job``: every variant of a description asked at every source of a stated list, numbered in the order of their answers."""
    each = F.explode(F.arrays_zip(F.sequence(F.lit(0), F.lit(len(sources) - 1)).alias("n"), F.array(*[F.lit(s) for s in sources]).alias("source"))).alias("s")
    return queries.select("query_id", "query_index", each).select("query_id", "query_index", "s.source", (F.col("query_index") * len(sources) + F.col("s.n")).alias("job"))


def answers(jobs: DataFrame, results: DataFrame, errors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The candidates of all jobs in one table, ``ordinal`` in the order of jobs and of their answers, and the jobs that failed.

    ``results`` have ``query_id, query_index, source, place``, ``errors`` an ``error`` for a job; a failed job gives no candidates. Ordinals need no sort of a query's whole pool: a job's
    first ordinal is the number of answers of the jobs before it.
    """
    key = ["query_id", "query_index", "source"]
    failed = jobs.join(errors.where("error IS NOT NULL").groupBy(*key).agg(F.min("error").alias("error")), key)
    sound = jobs.join(failed.select(*key), key, "left_anti")
    sizes = sound.join(results.groupBy(*key).agg(F.count("*").alias("_n")), key)
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("query_id").orderBy("job").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy(*key).orderBy("place")) - 1
    placed = results.withColumn("_k", inside).join(sizes.select(*key, before.alias("_before")), key)
    return placed.withColumn("ordinal", (F.col("_before") + F.col("_k")).cast("int")).drop("_k", "_before"), failed
