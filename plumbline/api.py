"""What callers use: citations to copies, descriptions to works, page search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.vectors import products
from plumbline.operators import attribution, identity, pool, rank


def resolve_citations(requests: DataFrame, candidates: DataFrame, hosts: DataFrame | None = None) -> DataFrame:
    """Of a request given several times the smallest title with its DOI counts. Candidates of each request (``req_id, title, doi``) that prove to be the work, best copy first (``final_pos``), with ``score`` and ``confidence``."""
    asked = requests.select("req_id", F.col("title").alias("_title"), F.col("doi").alias("_doi")).groupBy("req_id").agg(F.min(F.struct("_title", "_doi")).alias("_r")).select("req_id", "_r.*")
    rows = candidates.join(asked, "req_id").where("pdf_url IS NOT NULL").withColumn("_like", identity.title_similarity("_title", "title"))
    rows = rows.withColumn("score", identity.identity_score("_doi", "doi", "doi_keyed", "_like")).where(F.col("score") >= identity.THRESHOLD).drop("_title", "_doi", "_like")
    rows = identity.candidate_order(rows.withColumn("pdf_verified", F.coalesce("pdf_verified", F.lit(False))), "req_id", "score", "pdf_verified", ["ordinal"])
    if hosts is None:
        best = identity.best_first(identity.pick_best(rows, "req_id", "score", "pdf_verified"), "req_id")
    else:
        ok = identity.allowed_urls(rows.select("pdf_url").distinct(), hosts, "pdf_url").withColumn("allowed", F.lit(True))
        rows = rows.join(ok, "pdf_url", "left").withColumn("allowed", F.coalesce("allowed", F.lit(False)))
        first = identity.pick_best(rows.where("allowed"), "req_id", "score", "pdf_verified").where("is_best").select("req_id", "pos", "is_best")
        best = identity.best_first(rows.join(first, ["req_id", "pos"], "left").withColumn("is_best", F.coalesce("is_best", F.lit(False))), "req_id", "allowed")
    return best.withColumn("confidence", rank.confidence(F.col("score"), F.col("pdf_verified")))


def rank_descriptions(descriptions: DataFrame, works: DataFrame, k: int = rank.TOP_K, floor: float = rank.FLOOR, probes: DataFrame | None = None) -> DataFrame:
    """The ``k`` works (``work_id, vec, title_only, url``) nearest to each description (``query_id, vec``), fetchable ones first where ``probes`` (``url, ok``) are given."""
    weight = F.when(F.col("title_only"), rank.TITLE_ONLY).otherwise(1.0)
    keep = k if probes is None else rank.MAX_PROBES + k
    works = works.where("work_id IS NOT NULL")
    near = products(works, "work_id", "vec", descriptions, "query_id", "vec", keep=keep, weight=weight)
    rows = rank.best_ranked(near.withColumnsRenamed({"ident": "work_id", "score": "similarity"}), "query_id", "similarity", "work_id", keep, floor)
    if probes is None:
        return rank.top_k(rows, k).withColumn("rank", F.col("similarity_rank"))
    known = works.select("work_id", "url").join(probes.groupBy("url").agg(F.max("ok").alias("ok")), "url", "left").groupBy("work_id").agg(F.max(F.coalesce("ok", F.lit(False))).alias("ok"))
    return rank.fetchable_first(rows.join(known, "work_id"), "query_id", "similarity", "ok", k)


def search_pages(patches: DataFrame, tokens: DataFrame, grids: DataFrame, cells: DataFrame, k: int = 10, regions: int = 3) -> tuple[DataFrame, DataFrame]:
    """The ``k`` best pages by late interaction, and their best regions; attribution runs over those pages alone."""
    maxima = attribution.token_maxima(patches, tokens)
    top = attribution.top_pages(attribution.page_scores(maxima), k)
    heat = attribution.heat(maxima.join(top.select("page_id"), "page_id", "left_semi"), cells, grids)
    parts = attribution.components(attribution.hot_cells(attribution.blurred(heat, grids)), grids)
    return top, attribution.regions(parts, heat, top, grids, regions)


def merge_candidates(candidates: DataFrame) -> DataFrame:
    """The works behind the candidates of each query."""
    return pool.merge_works(candidates)
