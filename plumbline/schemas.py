"""Schemas, as DDL, of the records that are read from files."""

MANIFEST = (
    "query STRING, status STRING, path STRING, detail STRING, label STRING, "
    "resolution STRUCT<pdf_url: STRING, doi: STRING, work_doi: STRING, matched_title: STRING, confidence: DOUBLE, source: STRING, alternatives: ARRAY<STRUCT<pdf_url: STRING>>, errors: MAP<STRING, STRING>>, "
    "paper STRUCT<rank: INT, similarity_rank: INT, similarity: DOUBLE, confidence: DOUBLE, title: STRING, doi: STRING, abstract: STRING, title_only: BOOLEAN, pdf_url: STRING, pdf_urls: ARRAY<STRING>, landing_url: STRING, pdf_verified: BOOLEAN, retrieval_sources: ARRAY<STRING>, matched_queries: ARRAY<INT>>, "
    "run STRUCT<query_description: STRING, expanded_queries: ARRAY<STRING>, expansion_error: STRING, embedding_model: STRING, min_similarity: DOUBLE, selection: STRING, verified_window: INT, pool_size: INT, truncated_sources: ARRAY<STRING>, errors: MAP<STRING, STRING>>, "
    "usage STRUCT<wall_seconds: DOUBLE, cpu_seconds: DOUBLE, cpu_percent: DOUBLE, peak_rss_bytes: BIGINT, rss_bytes: BIGINT>"
)
POOL = (
    "description STRING, expanded_queries ARRAY<STRING>, "
    "papers ARRAY<STRUCT<key: STRING, title: STRING, abstract: STRING, doi: STRING, pdf_urls: ARRAY<STRING>, landing_url: STRING, retrieval_sources: ARRAY<STRING>, matched_queries: ARRAY<INT>>>"
)
