"""The core's queries over the tables of a data directory. Where a table stands in for a record of the domain, the query says which."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.vectors import products
from plumbline.operators import attribution, calibrate, chunking, identity, layout, pool, provenance, rank, records, store
from plumbline.sources import files, payloads
from plumbline.sources.tables import table

NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
ALLOWED = ("europress.example", "files.openshelf.example", "preprintia.example")


def _hosts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(h,) for h in ALLOWED], "host string")


# --- similarity: embeddings stand in for works, ids divisible by 100 for descriptions, labels divisible by 3 for bare titles


def _scored(spark: SparkSession, d: str, keep: int | None) -> DataFrame:
    e = table(spark, d, "embeddings")
    bare = F.col("label") % 3 == 0
    return products(e, "vec_id", "embedding", e.where("vec_id % 100 = 0"), "vec_id", "embedding", keep=keep, weight=F.when(bare, rank.TITLE_ONLY).otherwise(1.0))


def semantic_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = rank.best_ranked(_scored(spark, d, rank.TOP_K), "query_id", "score", "ident", floor=0.2)
    return rows.select("query_id", F.col("ident").alias("vec_id"), "similarity_rank", F.round("score", 6).alias("similarity"))


def similarity_distribution(spark: SparkSession, d: str) -> DataFrame:
    return calibrate.score_summary(_scored(spark, d, None), "query_id", "score")


def rag_topk(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    near = products(e, "vec_id", "embedding", e.where("vec_id % 100 = 0"), "vec_id", "embedding", keep=3).withColumn("distance", 1 - F.col("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "ident"))
    rows = near.withColumn("place", place).where("place <= 3 AND distance <= 0.5")
    return rows.select("query_id", F.col("ident").alias("vec_id"), "place", F.round("distance", 6).alias("distance"))


# --- ranking of works: table paper, pools by query_id, pool order by paper_id


def similarity_rank(spark: SparkSession, d: str) -> DataFrame:
    rows = rank.ranked(table(spark, d, "paper").where("similarity IS NOT NULL AND NOT isnan(similarity)"), "query_id", "similarity", "paper_id")
    return rows.select("query_id", "paper_id", "similarity_rank")


def rank_only_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = rank.best_ranked(table(spark, d, "paper"), "query_id", "similarity", "paper_id")
    sure = rank.confidence(F.col("similarity"), F.coalesce("pdf_verified", F.lit(False)))
    return rows.select("query_id", "paper_id", F.col("similarity_rank").alias("rank"), sure.alias("confidence"))


def fetchable_first_topk(spark: SparkSession, d: str) -> DataFrame:
    papers = table(spark, d, "paper").select("query_id", "paper_id", "similarity", F.coalesce("pdf_verified", F.lit(False)).alias("ok"))
    rows = rank.fetchable_first(rank.best_ranked(papers, "query_id", "similarity", "paper_id", rank.MAX_PROBES), "query_id", "similarity", "ok")
    return rows.select("query_id", "paper_id", "rank", "similarity_rank", "pdf_verified", "verified_window")


def score_distribution(spark: SparkSession, d: str) -> DataFrame:
    return calibrate.score_summary(table(spark, d, "paper"), "query_id", "similarity")


def floor_survivors(spark: SparkSession, d: str) -> DataFrame:
    return calibrate.floor_survivors(table(spark, d, "paper"), "query_id", "similarity", "title_only")


def scored_pool(spark: SparkSession, d: str) -> DataFrame:
    scores = F.sort_array(F.collect_list(F.round("similarity", 4)), False)
    return table(spark, d, "paper").groupBy("query_id").agg(F.count("*").alias("pool_size"), scores.alias("scored"))


def bench_report(spark: SparkSession, d: str) -> DataFrame:
    papers = table(spark, d, "paper")
    words = F.size(F.filter(F.split(T.paper_text("title", "abstract", " "), r"\s+"), lambda w: w != ""))
    stats = papers.groupBy("query_id").agg(F.max(words).alias("longest_words"), F.count_if(words > 60).alias("n_over_window"), F.count_if("title_only").alias("n_title_only"))
    top = rank.best_ranked(papers, "query_id", "similarity", "paper_id", 3)
    best = top.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("similarity_rank", "paper_id"))), lambda x: x["paper_id"]).alias("top"))
    return stats.join(best, "query_id", "left")


# --- pools of candidates: table semantic_candidate


def dedup_works(spark: SparkSession, d: str) -> DataFrame:
    return pool.work_keys(table(spark, d, "semantic_candidate")).groupBy("query_id", "key").agg(F.count("*").alias("n_candidates"))


def merge_works(spark: SparkSession, d: str) -> DataFrame:
    return pool.merge_works(table(spark, d, "semantic_candidate"))


def truncated_sources(spark: SparkSession, d: str) -> DataFrame:
    return pool.truncated_sources(table(spark, d, "semantic_candidate"), per_source=3)


def first_errors(spark: SparkSession, d: str) -> DataFrame:
    """Failures that the runs of table manifest logged, by description."""
    log = table(spark, d, "manifest").where("run.errors IS NOT NULL AND query IS NOT NULL")
    jobs = log.select(F.col("query").alias("query_id"), F.col("record_id").alias("ordinal"), F.explode("run.errors").alias("source", "error"))
    return pool.first_errors(jobs).select("query_id", F.transform(F.map_entries("errors"), lambda e: F.concat(e["key"], F.lit("="), e["value"])).alias("errors"))


def expanded_queries(spark: SparkSession, d: str) -> DataFrame:
    """Variants that the runs of table manifest used for each description, in order of first use."""
    log = table(spark, d, "manifest").where("run.expanded_queries IS NOT NULL AND query IS NOT NULL")
    used = log.select(F.col("query").alias("query_id"), "record_id", F.posexplode("run.expanded_queries").alias("k", "text"))
    used = used.groupBy("query_id", "text").agg(F.min(F.struct("record_id", "k")).alias("pos"))
    return pool.expanded_queries(used).select("query_id", "query_index", "text")


# --- text functions


def normalize_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "semantic_candidate").where("title IS NOT NULL").select("cand_id", T.normalize_title("title").alias("norm"))


def strip_markup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "semantic_candidate").select("cand_id", T.strip_markup("abstract").alias("abstract"))


def clean_queries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "query_request").select("query_id", T.clean_query("description").alias("cleaned"), T.split_compounds("description").alias("words"))


def paper_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "paper").select("paper_id", T.paper_text("title", "abstract").alias("text"))


def abstract_from_positions(spark: SparkSession, d: str) -> DataFrame:
    """Descriptions turned into maps from word to positions and back."""
    words = F.filter(F.split("description", r"\s+"), lambda w: w != "")
    each = table(spark, d, "query_request").select("query_id", F.posexplode(words).alias("k", "word")).groupBy("query_id", "word").agg(F.collect_list("k").alias("at"))
    index = each.groupBy("query_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("word", "at")))).alias("index"))
    return index.select("query_id", T.from_positions("index").alias("text"))


def slugs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "identity_candidate")
    own = F.coalesce(F.nullif(F.col("location_doi"), F.lit("")), F.col("doi"))
    return rows.select("ident_id", T.citation_slug("title", own, "pdf_url").alias("citation_slug"), T.semantic_slug("title", "pdf_url").alias("semantic_slug"))


def point_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.uuid5(NAMESPACE, F.concat_ws(":", F.sha2("text", 256), F.col("doc_id").cast("string"), F.lit("page-model"))).alias("point_id"))


def location_dois(spark: SparkSession, d: str) -> DataFrame:
    """Preprint addresses of table identity_candidate, given arXiv's host."""
    url = F.regexp_replace("pdf_url", r"^https://[^/]+/abs/(\d{4})\.(\d{5})\d*", "https://arxiv.org/abs/$1.$2v2")
    return table(spark, d, "identity_candidate").select("ident_id", T.location_doi(url, "doi").alias("location_doi"))


def chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.chunk_documents(table(spark, d, "documents"), "doc_id", "text").select(F.col("ident").alias("doc_id"), "chunk_no", "n_words", F.md5("text").alias("digest"))


def display_texts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "manifest").where("usage IS NOT NULL").select("record_id", "usage.*").distinct()
    return rows.select("record_id", T.bytes_text("peak_rss_bytes").alias("peak"), T.seconds_text(F.floor("wall_seconds")).alias("wall"))


# --- hosts and allowlists


def hosts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "semantic_candidate").select(T.host("pdf_url").alias("host")).groupBy("host").agg(F.count("*").alias("n"))


def allowlist_semi(spark: SparkSession, d: str) -> DataFrame:
    return identity.allowed_urls(table(spark, d, "semantic_candidate").where("pdf_url IS NOT NULL").select("cand_id", "pdf_url"), _hosts(spark), "pdf_url")


def blocked_hosts(spark: SparkSession, d: str) -> DataFrame:
    urls = table(spark, d, "semantic_candidate").where("pdf_url IS NOT NULL").select("query_id", "cand_id", "pdf_url")
    blocked = urls.join(identity.allowed_urls(urls, _hosts(spark), "pdf_url").select("cand_id"), "cand_id", "left_anti")
    return blocked.groupBy("query_id").agg(F.array_join(F.array_sort(F.collect_set(T.host("pdf_url"))), ", ").alias("detail"))


def fetch_targets(spark: SparkSession, d: str) -> DataFrame:
    """The first address of each paper on an allowed host."""
    urls = table(spark, d, "paper").select("paper_id", F.posexplode("pdf_urls").alias("pos", "url")).where("url IS NOT NULL AND trim(url) <> ''")
    return identity.allowed_urls(urls, _hosts(spark)).groupBy("paper_id").agg(F.min_by("url", "pos").alias("url"))


def alternate_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Attempts at each paper's addresses in turn; an address on the host of datadepot or coastcat fails."""
    urls = table(spark, d, "paper").select("paper_id", F.posexplode("pdf_urls").alias("pos", "url")).where("url IS NOT NULL AND trim(url) <> ''")
    bad = T.host("url").rlike("datadepot|coastcat|gatewire")
    return provenance.first_success(urls.withColumn("ok", ~bad).withColumn("reason", F.concat(F.lit("refused by "), T.host("url"))), ["paper_id"])


def url_promotion(spark: SparkSession, d: str) -> DataFrame:
    urls = records.promoted_urls(F.filter("pdf_urls", lambda u: F.trim(u) != ""), lambda u: T.host(u).isin(*ALLOWED))
    return table(spark, d, "paper").where("pdf_urls IS NOT NULL").select("paper_id", urls.alias("urls"), records.alternatives(urls).alias("alternatives"))


def result_json(spark: SparkSession, d: str) -> DataFrame:
    """The best papers of each query as one JSON text."""
    top = rank.best_ranked(table(spark, d, "paper"), "query_id", "similarity", "paper_id")
    return records.envelope(top, ["query_id"], "similarity_rank", ["paper_id", "similarity_rank", "key"], "papers")


# --- identity of citations: tables citation_request and identity_candidate


def _scored_candidates(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "citation_request").groupBy("req_id").agg(F.min(F.struct("title", "doi")).alias("r")).select("req_id", F.col("r.doi").alias("asked_doi"))
    rows = table(spark, d, "identity_candidate").join(asked, "req_id")
    return rows.withColumn("score", identity.identity_score("asked_doi", "doi", "doi_keyed", "title_score")).withColumn("pdf_verified", F.coalesce("pdf_verified", F.lit(False)))


def identity_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored_candidates(spark, d).select("ident_id", F.round("score", 4).alias("score"), rank.confidence(F.col("score"), F.col("pdf_verified")).alias("confidence"))


def _positioned(spark: SparkSession, d: str) -> DataFrame:
    rows = _scored_candidates(spark, d).where((F.col("score") >= identity.THRESHOLD) & F.col("pdf_url").isNotNull())
    return identity.pick_best(identity.candidate_order(rows, "req_id", "score", "pdf_verified", ["ordinal", "ident_id"]), "req_id", "score", "pdf_verified")


def pick_best(spark: SparkSession, d: str) -> DataFrame:
    return _positioned(spark, d).where("is_best").select("req_id", "ident_id", "pos")


def alternatives(spark: SparkSession, d: str) -> DataFrame:
    rows = identity.best_first(_positioned(spark, d), "req_id").where("final_pos BETWEEN 2 AND 4")
    return rows.groupBy("req_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("final_pos", "pdf_url"))), lambda x: x["pdf_url"]).alias("alternatives"))


def allowed_rerank(spark: SparkSession, d: str) -> DataFrame:
    rows = _positioned(spark, d).drop("is_best")
    ok = identity.allowed_urls(rows.select("ident_id", "pdf_url"), _hosts(spark), "pdf_url").select("ident_id", F.lit(True).alias("allowed"))
    marked = rows.join(ok, "ident_id", "left").withColumn("allowed", F.coalesce("allowed", F.lit(False)))
    best = identity.pick_best(marked.where("allowed"), "req_id", "score", "pdf_verified").where("is_best").select("ident_id", "is_best")
    final = identity.best_first(marked.join(best, "ident_id", "left").withColumn("is_best", F.coalesce("is_best", F.lit(False))), "req_id", "allowed")
    return final.select("req_id", "ident_id", "allowed", "final_pos")


def title_similarity_pairs(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "citation_request").where("title IS NOT NULL").groupBy("req_id").agg(F.min("title").alias("asked_title"))
    rows = table(spark, d, "identity_candidate").join(asked, "req_id")
    return rows.select("ident_id", F.round(identity.title_similarity("asked_title", "title"), 6).alias("similarity"))


# --- late interaction: 25 embeddings make a page of 5 x 5 cells, 600 x 800 points; ids divisible by 100 are the query's tokens


def _patches(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 25).alias("page_id"), (F.col("vec_id") % 25).cast("int").alias("patch_idx"), F.col("embedding").alias("vec"))


def _maxima(spark: SparkSession, d: str) -> DataFrame:
    tokens = table(spark, d, "embeddings").where("vec_id % 100 = 0").select((F.col("vec_id") / 100).cast("int").alias("tok"), F.col("embedding").alias("vec"))
    return attribution.token_maxima(_patches(spark, d), tokens)


def _grids(spark: SparkSession, d: str) -> DataFrame:
    one = [F.lit(5).alias("grid_rows"), F.lit(5).alias("grid_cols"), F.lit(True).alias("grid_ok"), F.lit(600.0).alias("width_pt"), F.lit(800.0).alias("height_pt")]
    return _patches(spark, d).select("page_id").distinct().select("page_id", *one)


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return _patches(spark, d).select("page_id", F.col("patch_idx").alias("cell"), "patch_idx").distinct()


def _top(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The maxima of the ten best pages, and their scores: attribution comes after the top-k."""
    maxima = _maxima(spark, d)
    top = attribution.top_pages(attribution.page_scores(maxima))
    return maxima.join(top.select("page_id"), "page_id", "left_semi"), top


def maxsim_argmax(spark: SparkSession, d: str) -> DataFrame:
    return _maxima(spark, d).select("page_id", "tok", "patch_idx", F.round("best", 5).alias("best"))


def maxsim_rank(spark: SparkSession, d: str) -> DataFrame:
    return attribution.top_pages(attribution.page_scores(_maxima(spark, d))).select("page_id", F.round("score", 4).alias("score"))


def heat_map(spark: SparkSession, d: str) -> DataFrame:
    return attribution.heat(_maxima(spark, d), _cells(spark, d), _grids(spark, d)).select("page_id", "cell", F.round("v", 4).alias("v"))


def box_blur(spark: SparkSession, d: str) -> DataFrame:
    heat = attribution.heat(_maxima(spark, d), _cells(spark, d), _grids(spark, d))
    return attribution.blurred(heat, _grids(spark, d)).select("page_id", "cell", F.round("v", 4).alias("v"))


def hot_cells(spark: SparkSession, d: str) -> DataFrame:
    grids = _grids(spark, d)
    smooth = attribution.blurred(attribution.heat(_maxima(spark, d), _cells(spark, d), grids), grids)
    return attribution.hot_cells(smooth).where("hot").select("page_id", "cell")


def hot_regions(spark: SparkSession, d: str) -> DataFrame:
    maxima, top = _top(spark, d)
    grids = _grids(spark, d)
    heat = attribution.heat(maxima, _cells(spark, d), grids)
    parts = attribution.components(attribution.hot_cells(attribution.blurred(heat, grids)), grids)
    found = attribution.regions(parts, heat, top, grids)
    return found.select("page_id", "region_no", "component", "cells", "x0", "y0", "x1", "y1", F.round("share", 4).alias("share"))


def stored_bytes(spark: SparkSession, d: str) -> DataFrame:
    return store.stored_bytes(_patches(spark, d), ["page_id"])


# --- page lines: lines of documents, laid out in two columns with a heading; two regions on each page


def _lines(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("page_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "text")).where("trim(text) <> ''")
    x0 = F.when(F.col("line_no") == 0, 50.0).when(F.col("line_no") % 2 == 1, 50.0).otherwise(310.0)
    x1 = F.when(F.col("line_no") == 0, 550.0).when(F.col("line_no") % 2 == 1, 290.0).otherwise(550.0)
    y0 = F.floor((F.col("line_no") + 1) / 2) * 14.0 + 40.0
    return rows.select("page_id", "line_no", x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), (y0 + 12.0).alias("y1"), F.trim("text").alias("text"))


def _regions(spark: SparkSession, d: str) -> DataFrame:
    boxes = F.array(*[F.struct(F.lit(n).alias("region_no"), *[F.lit(float(v)).alias(c) for c, v in zip(("x0", "y0", "x1", "y1"), box)]) for n, box in ((1, (40, 0, 560, 100)), (2, (300, 90, 560, 400)))])
    return table(spark, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("page_id")).distinct().select("page_id", F.explode(boxes).alias("r")).select("page_id", "r.*")


def lines_in_region(spark: SparkSession, d: str) -> DataFrame:
    return layout.lines_in_regions(_regions(spark, d), _lines(spark, d)).select("page_id", "region_no", "line_no")


def words_in_region(spark: SparkSession, d: str) -> DataFrame:
    return layout.words_in_regions(_regions(spark, d), _lines(spark, d)).select("page_id", "region_no", "line_no")


def reading_order(spark: SparkSession, d: str) -> DataFrame:
    return layout.reading_order(layout.lines_in_regions(_regions(spark, d), _lines(spark, d)), ["page_id", "region_no"]).select("page_id", "region_no", "line_no", "column_no", "reading_no")


def region_snippets(spark: SparkSession, d: str) -> DataFrame:
    ordered = layout.reading_order(layout.lines_in_regions(_regions(spark, d), _lines(spark, d)), ["page_id", "region_no"])
    return layout.snippets(ordered, ["page_id", "region_no"])


def tiled_layout(spark: SparkSession, d: str) -> DataFrame:
    """For each page of embeddings a token sequence of 2 x 3 tiles of four patches, then a global view of four."""
    pages = _patches(spark, d).select("page_id").distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(34))))
    run, inside = F.floor(F.col("k") / 5), F.col("k") % 5
    marker = F.when(run < 6, F.format_string("<row_%d_col_%d>", (F.floor(run / 3) + 1).cast("int"), (run % 3 + 1).cast("int"))).otherwise("<global>")
    tokens = pages.select("page_id", F.col("k").alias("pos"), F.when(inside == 0, marker).otherwise("<image>").alias("token"))
    return layout.tiled_layout(layout.image_runs(tokens, F.col("token") == "<image>"))


# --- the log of outcomes: table manifest


def manifest_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return provenance.downloaded_entries(table(spark, d, "manifest"), ["logged_at", "record_id"])


def manifest_queries(spark: SparkSession, d: str) -> DataFrame:
    return provenance.distinct_queries(provenance.downloaded_entries(table(spark, d, "manifest"), ["logged_at", "record_id"]))


def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return provenance.status_counts(table(spark, d, "manifest"))


def run_cost(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "manifest").where("usage IS NOT NULL").select("record_id", "usage.wall_seconds", "usage.cpu_seconds").distinct()
    return provenance.run_cost(rows).select("record_id", "cpu_percent")


def latest_delivery(spark: SparkSession, d: str) -> DataFrame:
    return provenance.latest_by_key(table(spark, d, "manifest").select("record_id", "status", "received_at"), ["record_id"], ["received_at"])


def index_resume(spark: SparkSession, d: str) -> DataFrame:
    """Works of table paper that no record of table manifest names."""
    stored = table(spark, d, "manifest").where("paper.doi IS NOT NULL").select(F.col("paper.doi").alias("key")).distinct()
    return provenance.not_indexed(table(spark, d, "paper").select("key").where("key IS NOT NULL").distinct(), stored, ["key"])


def upsert_papers(spark: SparkSession, d: str) -> DataFrame:
    """The earlier half of a store replaced by the later records of the same identifiers: papers by key, split by rank."""
    rows = provenance.latest_by_key(table(spark, d, "paper").where("key IS NOT NULL").select("key", "paper_id", "rank"), ["key"], ["paper_id"])
    old = rows.select("key", "paper_id")
    new = rows.where("rank <= 5").select("key", (-F.col("paper_id")).alias("paper_id"))
    return provenance.upsert(old, new, "key")


def files_there(spark: SparkSession, d: str) -> DataFrame:
    """Works of table paper of which the log's files hold a copy, under the name of any address; the paper's DOI stands in for its titles in the names."""
    log = table(spark, d, "manifest").where("path IS NOT NULL AND paper.doi IS NOT NULL").select(F.concat(F.md5("paper.doi"), F.lit(".pdf")).alias("path"))
    names = table(spark, d, "paper").where("doi IS NOT NULL").select("paper_id", F.array(F.concat(F.md5("key"), F.lit(".pdf")), F.concat(F.md5("doi"), F.lit(".pdf"))).alias("names"))
    return provenance.already_there(names, log, "paper_id", "names")


def files_with_entries(spark: SparkSession, d: str) -> DataFrame:
    """Every path of the log with the last downloaded entry of its file name."""
    log = table(spark, d, "manifest")
    files = log.where("path IS NOT NULL AND path <> ''").select("path").distinct()
    return provenance.with_entries(files, provenance.downloaded_entries(log, ["logged_at", "record_id"])).select("path", "query", "doi")


def published_records(spark: SparkSession, d: str) -> DataFrame:
    """The resolution and run blocks of the records of table manifest that have a paper."""
    rows = table(spark, d, "manifest").where("paper IS NOT NULL")
    rows = rows.select("record_id", records.resolution(rows).alias("r"), records.run_metadata().alias("m"))
    return rows.select("record_id", "r.pdf_url", "r.confidence", "r.source", F.size("r.alternatives").alias("n_alternatives"), "m.pool_size", "m.selection")


def download_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Downloads of table semantic_candidate: addresses on the mirror of polarlib end on its landing page's host, the ordinal gives the answer's status and size."""
    rows = table(spark, d, "semantic_candidate").where("pdf_url IS NOT NULL")
    body = F.encode(F.concat(F.when(F.col("ordinal") % 3 == 0, "<html>").otherwise("%PDF-1.7"), F.repeat(F.lit("x"), F.when(F.col("ordinal") % 2 == 0, 2000).otherwise(100))), "utf-8")
    landed = F.when(T.host("pdf_url") == "mirror.polarlib.example", F.col("landing_url")).otherwise(F.col("pdf_url"))
    outcome = files.download_outcome(F.col("pdf_url"), landed, F.when(F.col("ordinal") % 7 == 0, 404).otherwise(200), body, lambda u: ~T.host(u).rlike("gatewire"))
    return rows.select("cand_id", outcome.alias("reason"))


def fan_out(spark: SparkSession, d: str) -> DataFrame:
    """Jobs of every description with two variants at three sources."""
    asked = table(spark, d, "query_request").select("query_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("query_index"))
    return pool.fan_out(asked, ["openshelf", "crosscite", "scholarnet"])


def union_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of table semantic_candidate put in the order of their jobs again; jobs of gatewire count as failed."""
    results = table(spark, d, "semantic_candidate").withColumn("place", F.struct("ordinal", "cand_id"))
    key = ["query_id", "query_index", "source"]
    jobs = results.select(*key).where("query_index IS NOT NULL").distinct().withColumn("job", F.struct("query_index", "source"))
    errors = jobs.where("source = 'gatewire'").select(*key, F.lit("timeout").alias("error"))
    return pool.answers(jobs, results.drop("ordinal"), errors)[0].select("cand_id", "ordinal")


def model_pools(spark: SparkSession, d: str) -> DataFrame:
    return calibrate.model_pools(["small", "large"], table(spark, d, "query_request").select("query_id"))


def flat_layout(spark: SparkSession, d: str) -> DataFrame:
    """Pages of embeddings with one run of 12 or 16 patches or two of 5: a third announced as 3 x 4, a third a square, a third without a grid."""
    pages = _patches(spark, d).select("page_id").distinct()
    n = F.when(F.col("page_id") % 3 == 0, 12).when(F.col("page_id") % 3 == 1, 16).otherwise(5)
    runs = pages.select("page_id", F.lit(1).alias("start"), n.alias("length"), F.lit("<text>").alias("marker"))
    more = pages.where("page_id % 3 = 2").select("page_id", F.lit(9).alias("start"), F.lit(5).alias("length"), F.lit("<text>").alias("marker"))
    expected = pages.where("page_id % 3 = 0").select("page_id", F.lit(3).alias("rows"), F.lit(4).alias("cols"))
    runs = runs.unionByName(more)
    return layout.any_layout(layout.tiled_layout(runs), runs, expected)


def page_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of page lines in each region, by their own boxes."""
    return layout.words_in_regions(_regions(spark, d), layout.words_of_lines(_lines(spark, d))).groupBy("page_id", "region_no").agg(F.count("*").alias("n_words"))


# --- answers of services: payloads made of table semantic_candidate, read back


def _answers(spark: SparkSession, d: str, item: Column, wrap: str) -> DataFrame:
    rows = table(spark, d, "semantic_candidate").select("cand_id", F.to_json(item).alias("_i"))
    before, after = wrap.split("@")
    return rows.select("cand_id", F.concat(F.lit(before), F.col("_i"), F.lit(after)).alias("payload"))


def _read(df: DataFrame) -> DataFrame:
    return df.select("cand_id", "location_no", "title", "abstract", "doi", "pdf_url", "landing_url")


def parse_openalex(spark: SparkSession, d: str) -> DataFrame:
    place = F.struct(F.col("pdf_url"), F.col("landing_url").alias("landing_page_url"))
    item = F.struct(F.col("title").alias("display_name"), F.concat(F.lit("https://doi.org/"), F.trim("doi")).alias("doi"), place.alias("best_oa_location"), F.array(place).alias("locations"))
    return _read(payloads.openalex(_answers(spark, d, item, '{"results":[@]}')))


def parse_europepmc(spark: SparkSession, d: str) -> DataFrame:
    urls = F.array(F.struct(F.col("landing_url").alias("url"), F.lit("html").alias("documentStyle")), F.struct(F.col("pdf_url").alias("url"), F.lit("pdf").alias("documentStyle")))
    item = F.struct("title", F.col("abstract").alias("abstractText"), "doi", F.struct(urls.alias("fullTextUrl")).alias("fullTextUrlList"))
    return _read(payloads.europepmc(_answers(spark, d, item, '{"resultList":{"result":[@]}}')))


def parse_semantic_scholar(spark: SparkSession, d: str) -> DataFrame:
    item = F.struct("title", "abstract", F.struct(F.col("doi").alias("DOI")).alias("externalIds"), F.struct(F.col("pdf_url").alias("url")).alias("openAccessPdf"))
    return _read(payloads.semantic_scholar(_answers(spark, d, item, '{"data":[null,@]}')))


def parse_crossref(spark: SparkSession, d: str) -> DataFrame:
    link = F.struct(F.col("pdf_url").alias("URL"), F.lit("application/pdf").alias("content-type"))
    item = F.struct(F.array("title").alias("title"), "abstract", F.col("doi").alias("DOI"), F.col("landing_url").alias("URL"), F.array(link).alias("link"))
    return _read(payloads.crossref(_answers(spark, d, item, '{"message":{"items":[@]}}')))


def parse_unpaywall(spark: SparkSession, d: str) -> DataFrame:
    item = F.struct("title", "doi", F.struct(F.col("pdf_url").alias("url_for_pdf"), F.col("landing_url").alias("url_for_landing_page")).alias("best_oa_location"))
    return _read(payloads.unpaywall(_answers(spark, d, item, "@")))


def parse_arxiv(spark: SparkSession, d: str) -> DataFrame:
    def esc(c: str) -> Column:
        return F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    rows = table(spark, d, "semantic_candidate").where("title IS NOT NULL")
    xml = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>'), esc("landing_url"), F.lit("</id><title>"), esc("title"), F.lit('</title><link href="'), esc("pdf_url"), F.lit('" title="pdf"/></entry></feed>'))
    return payloads.arxiv(rows.select("cand_id", xml.alias("payload"))).select("cand_id", "pdf_url", "landing_url")


ALL = (
    semantic_topk, similarity_distribution, rag_topk, similarity_rank, rank_only_topk, fetchable_first_topk, score_distribution, floor_survivors, scored_pool, bench_report,
    dedup_works, merge_works, truncated_sources, first_errors, expanded_queries, normalize_titles, strip_markup, clean_queries, paper_texts, abstract_from_positions, slugs, point_ids, location_dois, chunks, display_texts,
    hosts, allowlist_semi, blocked_hosts, fetch_targets, alternate_hosts, url_promotion, result_json, stored_bytes, identity_scores, pick_best, alternatives, allowed_rerank, title_similarity_pairs,
    maxsim_argmax, maxsim_rank, heat_map, box_blur, hot_cells, hot_regions, lines_in_region, words_in_region, reading_order, region_snippets, tiled_layout,
    manifest_last_wins, manifest_queries, status_counts, run_cost, latest_delivery, index_resume, upsert_papers, files_there, files_with_entries, published_records, download_outcomes, fan_out, union_candidates, model_pools, flat_layout, page_words, parse_openalex, parse_europepmc, parse_semantic_scholar, parse_crossref, parse_unpaywall, parse_arxiv,
)
