"""DuckDB SQL for the core's queries, each written from the definition of its result, not from the Spark plan."""

from __future__ import annotations

from plumbline.queries import ALLOWED, NAMESPACE

NORM = "trim(regexp_replace(lower(strip_accents({})), '[^a-z0-9]+', ' ', 'g'))"
HOST = "nullif(regexp_replace(regexp_extract(lower(trim({})), '^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@\\s]*@)?([^/:?#\\s]+)', 1), '^www\\.', ''), '')"
_ALLOWED = " OR ".join(f"h = '{a}' OR ends_with(h, '.{a}')" for a in ALLOWED)
_NS = NAMESPACE.replace("-", "")

_SIMILARITY = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, e.vec_id, list_cosine_similarity(q.v, e.v) AS cos, list_cosine_similarity(q.v, e.v) * CASE WHEN e.label % 3 = 0 THEN 0.85 ELSE 1 END AS score
      FROM e q CROSS JOIN e WHERE q.vec_id % 100 = 0)
"""


def _summary(rows: str, group: str, score: str) -> str:
    return f"""
      , r AS (SELECT {group} AS g, {score} AS x, count(*) OVER (PARTITION BY {group}) AS n, row_number() OVER (PARTITION BY {group} ORDER BY {score} DESC) - 1 AS k FROM {rows})
      SELECT g AS {group}, count(*) AS pool_size, round(max(x), 4) AS score_max, round(max(x) FILTER (WHERE k = least(n - 1, floor(0.1 * n))), 4) AS score_top10,
        round(max(x) FILTER (WHERE k = least(n - 1, floor(0.5 * n))), 4) AS score_median, round(min(x), 4) AS score_min FROM r GROUP BY g"""


_KEYS = f"""
WITH c AS (SELECT *, {NORM.format("title")} AS norm FROM semantic_candidate WHERE title IS NOT NULL),
k AS (SELECT *, coalesce(first_value(nullif(lower(trim(doi)), '')) OVER (PARTITION BY query_id, norm ORDER BY ordinal, cand_id), 'title:' || norm) AS key FROM c WHERE norm <> '')
"""


def _seen(value: str, name: str) -> str:
    return f"(SELECT query_id, key, list(v ORDER BY o, i) AS {name} FROM (SELECT query_id, key, {value} AS v, min(ordinal) AS o, arg_min(cand_id, (ordinal, cand_id)) AS i FROM k WHERE {value} IS NOT NULL GROUP BY ALL) GROUP BY ALL)"


_IDENTITY = """
WITH q AS (SELECT req_id, arg_min(doi, (coalesce(title, ''), coalesce(doi, ''))) AS x, min((title IS NOT NULL, title, doi IS NOT NULL, doi)) AS m FROM citation_request GROUP BY req_id),
asked AS (SELECT req_id, nullif(lower(trim(m[4])), '') AS asked FROM q),
s AS (SELECT i.*, coalesce(pdf_verified, false) AS ver, CASE WHEN asked IS NULL THEN coalesce(title_score, 0) WHEN asked = nullif(lower(trim(doi)), '') THEN 1.0 WHEN NOT coalesce(doi_keyed, false) THEN 0.0
  WHEN nullif(lower(trim(doi)), '') IS NULL THEN 0.9 ELSE coalesce(title_score, 0) END AS score FROM identity_candidate i JOIN asked USING (req_id))
"""
_POSITIONED = (
    _IDENTITY
    + f"""
, p AS (SELECT *, row_number() OVER (PARTITION BY req_id ORDER BY score DESC, ver DESC, ordinal, ident_id) AS pos, max(score) OVER (PARTITION BY req_id) AS top, {HOST.format("pdf_url")} AS h
  FROM s WHERE score >= 0.82 AND pdf_url IS NOT NULL),
b AS (SELECT *, row_number() OVER (PARTITION BY req_id ORDER BY score >= top - 1e-9 DESC, (score >= top - 1e-9 AND ver) DESC, pos) = 1 AS best FROM p)
"""
)

_MAXIMA = """
WITH RECURSIVE e AS (SELECT vec_id, vec_id // 25 AS page_id, vec_id % 25 AS patch_idx, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT e.page_id, q.vec_id // 100 AS tok, e.patch_idx, list_inner_product(q.v, e.v) AS x FROM e q CROSS JOIN e WHERE q.vec_id % 100 = 0),
m AS (SELECT page_id, tok, max(x) AS best, arg_max(patch_idx, (x, -patch_idx)) AS patch_idx FROM d GROUP BY ALL),
score AS (SELECT page_id, sum(best) AS score FROM m GROUP BY ALL),
top AS (SELECT * FROM score ORDER BY score DESC, page_id LIMIT 10),
hit AS (SELECT page_id, patch_idx AS cell, sum(best) AS v FROM m WHERE best > 0 GROUP BY ALL),
heat AS (SELECT page_id, CAST(cell AS INT) AS cell, coalesce(v, 0) AS v FROM (SELECT DISTINCT page_id FROM hit) CROSS JOIN range(25) AS r(cell) LEFT JOIN hit USING (page_id, cell)),
blur AS (SELECT a.page_id, a.cell, avg(b.v) AS v FROM heat a JOIN heat b ON a.page_id = b.page_id AND abs(a.cell // 5 - b.cell // 5) <= 1 AND abs(a.cell % 5 - b.cell % 5) <= 1 GROUP BY ALL),
mark AS (SELECT *, v >= avg(v) OVER w + 0.5 * stddev_pop(v) OVER w AND v > 0 AS h, row_number() OVER (PARTITION BY page_id ORDER BY v DESC, cell) = 1 AS is_first FROM blur WINDOW w AS (PARTITION BY page_id)),
hot AS (SELECT page_id, cell FROM (SELECT *, bool_or(h) OVER (PARTITION BY page_id) AS any_hot FROM mark) WHERE CASE WHEN any_hot THEN h ELSE is_first AND v > 0 END),
walk AS (SELECT page_id, cell AS seed, cell FROM hot
  UNION SELECT w.page_id, w.seed, h.cell FROM walk w JOIN hot h ON w.page_id = h.page_id AND abs(w.cell // 5 - h.cell // 5) + abs(w.cell % 5 - h.cell % 5) = 1),
part AS (SELECT page_id, cell, min(seed) AS component FROM walk GROUP BY ALL)
"""

_LINES = """
WITH l AS (SELECT doc_id AS page_id, CAST(k - 1 AS INT) AS line_no, trim(t[k]) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS t FROM documents) , unnest(range(1, len(t) + 1)) AS u(k) WHERE trim(t[k]) <> ''),
b AS (SELECT *, CASE WHEN line_no = 0 OR line_no % 2 = 1 THEN 50.0 ELSE 310.0 END AS x0, CASE WHEN line_no % 2 = 1 THEN 290.0 ELSE 550.0 END AS x1, ((line_no + 1) // 2) * 14.0 + 40.0 AS y0 FROM l),
lines AS (SELECT *, y0 + 12.0 AS y1 FROM b),
reg AS (SELECT * FROM (VALUES (1, 40.0, 0.0, 560.0, 100.0), (2, 300.0, 90.0, 560.0, 400.0)) AS t(region_no, rx0, ry0, rx1, ry1)),
hit AS (SELECT * FROM lines CROSS JOIN reg WHERE least(x1, rx1) > greatest(x0, rx0) AND least(y1, ry1) > greatest(y0, ry0)),
wide AS (SELECT *, x1 - x0 >= 0.7 * (max(x1) OVER w - min(x0) OVER w) AND max(x1) OVER w > min(x0) OVER w AS w FROM hit WINDOW w AS (PARTITION BY page_id, region_no)),
col AS (SELECT *, CASE WHEN w THEN 0 WHEN x0 < 300 THEN 1 ELSE 2 END AS side FROM wide),
num AS (SELECT *, CASE WHEN side = 0 THEN 0 ELSE dense_rank() OVER (PARTITION BY page_id, region_no, w ORDER BY side) END AS column_no FROM col),
ord AS (SELECT *, row_number() OVER (PARTITION BY page_id, region_no ORDER BY column_no, round(y0, 1), x0, line_no) AS reading_no FROM num)
"""

_ENTRIES = """
WITH r AS (SELECT *, regexp_extract(path, '([^/\\\\]+)$', 1) AS file FROM manifest WHERE status = 'downloaded' AND path IS NOT NULL AND path <> ''),
t AS (SELECT file, coalesce(query, '') AS query, coalesce(nullif(paper.title, ''), nullif(resolution.matched_title, ''), translate(regexp_replace(regexp_replace(file, '\\.[^.]+$', ''), '_[^_]*$', ''), '-', ' ')) AS title,
  coalesce(nullif(paper.doi, ''), resolution.doi) AS doi, logged_at, record_id FROM r),
e AS (SELECT file AS path, arg_max(struct_pack(q := query, t := title, d := doi), (logged_at, record_id)) AS z, arg_min(record_id, (logged_at, record_id)) AS first_seen FROM t GROUP BY file)
"""


def oracle_sql() -> dict[str, str]:
    answer = "SELECT cand_id, CAST(0 AS INT) AS location_no, title, {abstract} AS abstract, {doi} AS doi, {pdf} AS pdf_url, {landing} AS landing_url FROM semantic_candidate"
    plain = "nullif(trim(regexp_replace(regexp_replace(abstract, '<[^>]+>', ' ', 'g'), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g')), '')"
    return {
        "semantic_topk": _SIMILARITY
        + "SELECT query_id, vec_id, CAST(pos AS INT) AS similarity_rank, round(score, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS pos FROM s WHERE score >= 0.2) WHERE pos <= 5",
        "similarity_distribution": _SIMILARITY + _summary("s", "query_id", "score"),
        "rag_topk": _SIMILARITY
        + "SELECT query_id, vec_id, CAST(pos AS INT) AS place, round(1 - cos, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY 1 - cos, vec_id) AS pos FROM s) WHERE pos <= 3 AND 1 - cos <= 0.5",
        "similarity_rank": "SELECT query_id, paper_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, paper_id) AS INT) AS similarity_rank FROM paper WHERE similarity >= 0.70 AND NOT isnan(similarity)",
        "rank_only_topk": """SELECT query_id, paper_id, CAST(pos AS INT) AS rank, round(similarity * CASE WHEN coalesce(pdf_verified, false) THEN 1.0 ELSE 0.7 END, 3) AS confidence
            FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, paper_id) AS pos FROM paper WHERE similarity >= 0.70) WHERE pos <= 5""",
        "fetchable_first_topk": """
            WITH r AS (SELECT query_id, paper_id, similarity, coalesce(pdf_verified, false) AS ok, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, paper_id) AS sr, count(*) OVER (PARTITION BY query_id) AS n FROM paper WHERE similarity >= 0.70),
            c AS (SELECT *, sum(CASE WHEN ok AND sr <= 45 THEN 1 ELSE 0 END) OVER (PARTITION BY query_id ORDER BY sr) AS good FROM r),
            w AS (SELECT *, coalesce(least(least(n, 45), ceil(min(CASE WHEN ok AND sr <= 45 AND good = 5 THEN sr END) OVER (PARTITION BY query_id) / 15.0) * 15), least(n, 45)) AS win FROM c),
            v AS (SELECT *, ok AND sr <= win AS ver FROM w),
            p AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY ver DESC, sr) AS place FROM v)
            SELECT query_id, paper_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, ver DESC, sr) AS INT) AS rank, CAST(sr AS INT) AS similarity_rank, ver AS pdf_verified, CAST(win AS INT) AS verified_window FROM p WHERE place <= 5""",
        "score_distribution": "WITH p AS (SELECT * FROM paper)" + _summary("p", "query_id", "similarity"),
        "floor_survivors": "SELECT query_id, count(*) FILTER (WHERE similarity >= 0.70) AS n_low, count(*) FILTER (WHERE similarity >= 0.70 AND title_only) AS n_low_title_only, count(*) FILTER (WHERE similarity >= 0.75) AS n_high FROM paper GROUP BY query_id",
        "scored_pool": "SELECT query_id, count(*) AS pool_size, list(round(similarity, 4) ORDER BY similarity DESC) FILTER (WHERE similarity IS NOT NULL) AS scored FROM paper GROUP BY query_id",
        "bench_report": """
            WITH t AS (SELECT *, len(list_filter(regexp_split_to_array(concat_ws(' ', nullif(trim(title), ''), nullif(trim(abstract), '')), '[ \\t\\n\\r\\f\\x0B]+'), lambda w: w <> '')) AS words FROM paper),
            b AS (SELECT query_id, list(paper_id ORDER BY pos) AS top FROM (SELECT query_id, paper_id, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, paper_id) AS pos FROM paper WHERE similarity >= 0.70) WHERE pos <= 3 GROUP BY query_id)
            SELECT query_id, CAST(max(words) AS INT) AS longest_words, count(*) FILTER (WHERE words > 60) AS n_over_window, count(*) FILTER (WHERE title_only) AS n_title_only, any_value(top) AS top FROM t LEFT JOIN b USING (query_id) GROUP BY query_id""",
        "dedup_works": _KEYS + "SELECT query_id, key, count(*) AS n_candidates FROM k GROUP BY ALL",
        "merge_works": _KEYS
        + f""", g AS (SELECT query_id, key, arg_min(title, (ordinal, cand_id)) AS title, arg_max(abstract, (length(abstract), -ordinal, -cand_id)) FILTER (WHERE length(abstract) > 0) AS abstract,
                arg_min(doi, (ordinal, cand_id)) FILTER (WHERE doi <> '') AS doi, arg_min(landing_url, (ordinal, cand_id)) FILTER (WHERE landing_url <> '') AS landing_url,
                list_sort(list(DISTINCT query_index) FILTER (WHERE query_index IS NOT NULL)) AS matched_queries, count(*) AS n_candidates FROM k GROUP BY ALL)
            SELECT g.*, coalesce(pdf_urls, []) AS pdf_urls, coalesce(retrieval_sources, []) AS retrieval_sources FROM g LEFT JOIN {_seen("nullif(pdf_url, '')", "pdf_urls")} USING (query_id, key) LEFT JOIN {_seen("source", "retrieval_sources")} USING (query_id, key)""",
        "truncated_sources": "SELECT query_id, list_sort(list(DISTINCT source)) AS truncated_sources FROM (SELECT query_id, source, query_index FROM semantic_candidate GROUP BY ALL HAVING count(*) >= 3) GROUP BY query_id",
        "first_errors": """
            WITH j AS (SELECT query AS query_id, record_id, unnest(map_entries(run.errors)) AS e FROM manifest WHERE run.errors IS NOT NULL AND query IS NOT NULL),
            f AS (SELECT query_id, e.key AS source, arg_min(e.value, record_id) AS error FROM j WHERE e.value IS NOT NULL GROUP BY ALL)
            SELECT query_id, list(source || '=' || error ORDER BY source) AS errors FROM f GROUP BY query_id""",
        "expanded_queries": """
            WITH x AS (SELECT query AS query_id, record_id, k, run.expanded_queries[k] AS text FROM manifest, unnest(range(1, len(run.expanded_queries) + 1)) AS u(k) WHERE query IS NOT NULL),
            f AS (SELECT query_id, text, min((record_id, k)) AS pos FROM x WHERE text IS NOT NULL AND trim(text) <> '' GROUP BY ALL),
            o AS (SELECT *, row_number() OVER (PARTITION BY query_id, lower(text) ORDER BY pos) AS n FROM f)
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY pos) - 1 AS INT) AS query_index, text FROM o WHERE n = 1""",
        "normalize_titles": f"SELECT cand_id, {NORM.format('title')} AS norm FROM semantic_candidate WHERE title IS NOT NULL",
        "strip_markup": f"SELECT cand_id, {plain} AS abstract FROM semantic_candidate",
        "clean_queries": """SELECT query_id, trim(regexp_replace(regexp_replace(description, '["''()\\[\\]:+^~]', ' ', 'g'), '\\s+', ' ', 'g')) AS cleaned,
            trim(regexp_replace(regexp_replace(regexp_replace(description, '[-_/"''`]', ' ', 'g'), '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '\\s+', ' ', 'g')) AS words FROM query_request""",
        "paper_texts": "SELECT paper_id, concat_ws(chr(10), nullif(trim(title), ''), nullif(trim(abstract), '')) AS text FROM paper",
        "abstract_from_positions": "SELECT query_id, array_to_string(list_filter(regexp_split_to_array(description, '\\s+'), lambda w: w <> ''), ' ') AS text FROM query_request",
        "slugs": """
            WITH f AS (SELECT ident_id, regexp_replace(substring(regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80), '-+$', '') AS t,
              regexp_replace(substring(regexp_replace(regexp_replace(lower(coalesce(nullif(location_doi, ''), doi, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 40), '-+$', '') AS i, pdf_url, title FROM identity_candidate)
            SELECT ident_id, concat_ws('_', nullif(t, ''), coalesce(nullif(i, ''), substring(sha1(coalesce(pdf_url, '')), 1, 8))) AS citation_slug, concat_ws('_', nullif(t, ''), substring(sha256(coalesce(nullif(pdf_url, ''), title, '')), 1, 10)) AS semantic_slug FROM f""",
        "point_ids": f"""
            WITH h AS (SELECT doc_id, sha1(unhex('{_NS}') || encode(concat_ws(':', sha256(text), CAST(doc_id AS VARCHAR), 'page-model'))) AS h FROM documents)
            SELECT doc_id, substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-5' || substring(h, 14, 3) || '-' || substring('89ab', (instr('0123456789abcdef', substring(h, 17, 1)) - 1) % 4 + 1, 1) || substring(h, 18, 3) || '-' || substring(h, 21, 12) AS point_id FROM h""",
        "location_dois": """
            WITH u AS (SELECT ident_id, doi, regexp_replace(pdf_url, '^https://[^/]+/abs/(\\d{4})\\.(\\d{5})\\d*', 'https://arxiv.org/abs/\\1.\\2v2') AS u FROM identity_candidate)
            SELECT ident_id, CASE WHEN u LIKE 'https://arxiv.org/abs/%' THEN '10.48550/arXiv.' || regexp_extract(u, 'abs/(\\d{4}\\.\\d{4,5})', 1) ELSE doi END AS location_doi FROM u""",
        "chunks": """
            WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\x0B]+'), lambda x: x <> '') AS w FROM documents),
            c AS (SELECT doc_id, k, w[k * 412 + 1:k * 412 + 512] AS p FROM w, unnest(range(0, greatest(1, CAST(ceil((len(w) - 100) / 412.0) AS BIGINT)))) AS u(k) WHERE len(w) > 0)
            SELECT doc_id, CAST(k AS INT) AS chunk_no, CAST(len(p) AS INT) AS n_words, md5(array_to_string(p, ' ')) AS digest FROM c""",
        "display_texts": """
            WITH u AS (SELECT DISTINCT record_id, usage.peak_rss_bytes AS b, floor(usage.wall_seconds) AS s FROM manifest WHERE usage IS NOT NULL)
            SELECT record_id, CASE WHEN b IS NULL THEN 'n/a' WHEN b < 1024 THEN printf('%.0f B', b::DOUBLE) WHEN b < 1048576 THEN printf('%.1f KB', round(b / 1024.0, 1)) WHEN b < 1073741824 THEN printf('%.1f MB', round(b / 1048576.0, 1)) ELSE printf('%.2f GB', round(b / 1073741824.0, 2)) END AS peak,
              CASE WHEN s IS NULL THEN 'n/a' WHEN s < 60 THEN printf('%.1fs', s::DOUBLE) ELSE printf('%dm %02ds', CAST(floor(s / 60) AS BIGINT), CAST(s AS BIGINT) % 60) END AS wall FROM u""",
        "hosts": f"SELECT {HOST.format('pdf_url')} AS host, count(*) AS n FROM semantic_candidate GROUP BY 1",
        "allowlist_semi": f"SELECT cand_id, pdf_url FROM (SELECT *, {HOST.format('pdf_url')} AS h FROM semantic_candidate WHERE pdf_url IS NOT NULL) WHERE {_ALLOWED}",
        "blocked_hosts": f"SELECT query_id, string_agg(DISTINCT h, ', ' ORDER BY h) AS detail FROM (SELECT *, {HOST.format('pdf_url')} AS h FROM semantic_candidate WHERE pdf_url IS NOT NULL) WHERE NOT ({_ALLOWED}) GROUP BY query_id",
        "fetch_targets": f"""
            WITH u AS (SELECT paper_id, k, pdf_urls[k] AS url, {HOST.format("pdf_urls[k]")} AS h FROM paper, unnest(range(1, len(pdf_urls) + 1)) AS u(k))
            SELECT paper_id, arg_min(url, k) AS url FROM u WHERE trim(url) <> '' AND ({_ALLOWED}) GROUP BY paper_id""",
        "alternate_hosts": f"""
            WITH u AS (SELECT paper_id, k, pdf_urls[k] AS url, {HOST.format("pdf_urls[k]")} AS h FROM paper, unnest(range(1, len(pdf_urls) + 1)) AS u(k) WHERE trim(pdf_urls[k]) <> ''),
            o AS (SELECT *, NOT regexp_matches(h, 'datadepot|coastcat|gatewire') AS ok FROM u)
            SELECT paper_id, arg_min(url, k) FILTER (WHERE ok) AS url, CASE WHEN bool_or(ok) THEN NULL ELSE string_agg('refused by ' || h, '; ' ORDER BY k) END AS detail FROM o GROUP BY paper_id""",
        "url_promotion": f"""
            WITH u AS (SELECT paper_id, list_filter(pdf_urls, lambda u: trim(u) <> '') AS us FROM paper WHERE pdf_urls IS NOT NULL),
            o AS (SELECT paper_id, list_concat(list_filter(us, lambda u: {HOST.format("u")} IN {ALLOWED}), list_filter(us, lambda u: NOT coalesce({HOST.format("u")} IN {ALLOWED}, false))) AS urls FROM u)
            SELECT paper_id, urls, urls[2:4] AS alternatives FROM o""",
        "result_json": """
            WITH t AS (SELECT query_id, paper_id, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, paper_id) AS pos, key FROM paper WHERE similarity >= 0.70)
            SELECT query_id, '{"query_id":' || query_id || ',"papers":[' || string_agg('{"paper_id":' || paper_id || ',"similarity_rank":' || pos || CASE WHEN key IS NULL THEN '' ELSE ',"key":' || CAST(to_json(key) AS VARCHAR) END || '}', ',' ORDER BY pos) || ']}' AS json
            FROM t WHERE pos <= 5 GROUP BY query_id""",
        "stored_bytes": "SELECT vec_id // 25 AS page_id, count(*) AS n_vectors, CAST(sum(len(embedding)) * 4 AS BIGINT) AS n_bytes FROM embeddings GROUP BY 1",
        "identity_scores": _IDENTITY + "SELECT ident_id, round(score, 4) AS score, round(score * CASE WHEN ver THEN 1.0 ELSE 0.7 END, 3) AS confidence FROM s",
        "pick_best": _POSITIONED + "SELECT req_id, ident_id, CAST(pos AS INT) AS pos FROM b WHERE best",
        "alternatives": _POSITIONED
        + "SELECT req_id, list(pdf_url ORDER BY f) AS alternatives FROM (SELECT *, row_number() OVER (PARTITION BY req_id ORDER BY best DESC, pos) AS f FROM b) WHERE f BETWEEN 2 AND 4 GROUP BY req_id",
        "allowed_rerank": _POSITIONED
        + f""", a AS (SELECT *, coalesce({_ALLOWED}, false) AS ok FROM p),
            t AS (SELECT *, max(CASE WHEN ok THEN score END) OVER (PARTITION BY req_id) AS best_ok FROM a),
            n AS (SELECT *, row_number() OVER (PARTITION BY req_id ORDER BY ok DESC, score >= best_ok - 1e-9 DESC, (score >= best_ok - 1e-9 AND ver) DESC, pos) = 1 AND ok AS chosen FROM t)
            SELECT req_id, ident_id, ok AS allowed, CAST(row_number() OVER (PARTITION BY req_id ORDER BY chosen DESC, ok DESC, pos) AS INT) AS final_pos FROM n""",
        "maxsim_argmax": _MAXIMA + "SELECT page_id, CAST(tok AS INT) AS tok, CAST(patch_idx AS INT) AS patch_idx, round(best, 5) AS best FROM m",
        "maxsim_rank": _MAXIMA + "SELECT page_id, round(score, 4) AS score FROM top",
        "heat_map": _MAXIMA + "SELECT page_id, cell, round(v, 4) AS v FROM heat",
        "box_blur": _MAXIMA + "SELECT page_id, cell, round(v, 4) AS v FROM blur",
        "hot_cells": _MAXIMA + "SELECT page_id, cell FROM hot",
        "hot_regions": _MAXIMA
        + """, box AS (SELECT page_id, component, count(*) AS cells, min(cell % 5) * 120.0 AS x0, min(cell // 5) * 160.0 AS y0, (max(cell % 5) + 1) * 120.0 AS x1, (max(cell // 5) + 1) * 160.0 AS y1, sum(v) AS weight
              FROM part JOIN heat USING (page_id, cell) JOIN top USING (page_id) GROUP BY ALL)
            SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY weight DESC, component) AS INT) AS region_no, component, cells, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, round(weight / score, 4) AS share
            FROM box JOIN top USING (page_id) WHERE score > 0""",
        "lines_in_region": _LINES + "SELECT page_id, region_no, line_no FROM hit",
        "words_in_region": _LINES + "SELECT page_id, region_no, line_no FROM hit WHERE (least(x1, rx1) - greatest(x0, rx0)) * (least(y1, ry1) - greatest(y0, ry0)) / ((x1 - x0) * (y1 - y0)) >= 0.3",
        "reading_order": _LINES + "SELECT page_id, region_no, line_no, CAST(column_no AS INT) AS column_no, CAST(reading_no AS INT) AS reading_no FROM ord",
        "region_snippets": _LINES
        + "SELECT page_id, region_no, CASE WHEN length(s) > 300 THEN rtrim(substring(s, 1, 300)) || '...' ELSE s END AS snippet FROM (SELECT page_id, region_no, string_agg(text, ' ' ORDER BY reading_no) AS s FROM ord GROUP BY ALL)",
        "tiled_layout": """
            SELECT page_id, CAST(4 AS INT) AS grid_rows, CAST(6 AS INT) AS grid_cols, CAST(cell AS INT) AS cell, CAST(((cell // 12) * 3 + (cell % 6) // 2) * 5 + 1 + ((cell // 6) % 2) * 2 + cell % 2 AS INT) AS patch_idx
            FROM (SELECT DISTINCT vec_id // 25 AS page_id FROM embeddings) CROSS JOIN range(24) AS r(cell)""",
        "files_there": """
            WITH f AS (SELECT DISTINCT paper.doi AS doi FROM manifest WHERE path IS NOT NULL AND paper.doi IS NOT NULL)
            SELECT paper_id, coalesce(min(CASE WHEN f.doi = key THEN md5(f.doi) || '.pdf' END), min(md5(f.doi) || '.pdf')) AS path FROM paper p JOIN f ON f.doi = p.key OR f.doi = p.doi WHERE p.doi IS NOT NULL GROUP BY paper_id""",
        "files_with_entries": _ENTRIES
        + """SELECT DISTINCT f.path, z.q AS query, z.d AS doi FROM manifest f LEFT JOIN e ON e.path = regexp_extract(f.path, '([^/\\\\]+)$', 1) WHERE f.path IS NOT NULL AND f.path <> ''""",
        "published_records": """
            SELECT record_id, paper.pdf_url AS pdf_url, paper.confidence AS confidence, nullif(array_to_string(list_filter(paper.retrieval_sources, lambda s: s IS NOT NULL), '+'), '') AS source,
              CAST(coalesce(len(paper.pdf_urls[2:4]), 0) AS INT) AS n_alternatives, run.pool_size AS pool_size, run.selection AS selection FROM manifest WHERE paper IS NOT NULL""",
        "download_outcomes": f"""
            WITH u AS (SELECT cand_id, ordinal, {HOST.format("pdf_url")} AS h, {HOST.format("landing_url")} AS l FROM semantic_candidate WHERE pdf_url IS NOT NULL),
            e AS (SELECT *, CASE WHEN h = 'mirror.polarlib.example' AND l IS NOT NULL THEN l ELSE h END AS dest FROM u)
            SELECT cand_id, CASE WHEN coalesce(dest LIKE '%gatewire%', true) THEN 'redirected off-allowlist to ' || coalesce(dest, '') WHEN ordinal % 7 = 0 THEN 'status 404' WHEN ordinal % 3 = 0 THEN 'response is not a PDF'
              WHEN ordinal % 2 <> 0 THEN 'file too small (108 bytes)' END AS reason FROM e""",
        "fan_out": "SELECT query_id, CAST(i AS INT) AS query_index, s AS source, CAST(i * 3 + n AS INT) AS job FROM query_request, range(2) AS a(i), (VALUES (0, 'openshelf'), (1, 'crosscite'), (2, 'scholarnet')) AS b(n, s)",
        "union_candidates": """
            SELECT cand_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY query_index, source, ordinal, cand_id) - 1 AS INT) AS ordinal FROM semantic_candidate
            WHERE source <> 'gatewire' AND query_id IS NOT NULL AND query_index IS NOT NULL""",
        "model_pools": "SELECT query_id, m AS model FROM query_request, (VALUES ('small'), ('large')) AS t(m)",
        "flat_layout": """
            WITH p AS (SELECT DISTINCT vec_id // 25 AS page_id FROM embeddings)
            SELECT page_id, CAST([3, 4, 0][page_id % 3 + 1] AS INT) AS grid_rows, CAST([4, 4, 0][page_id % 3 + 1] AS INT) AS grid_cols, CAST(c AS INT) AS cell, CAST(CASE WHEN page_id % 3 = 2 AND c >= 5 THEN c + 4 ELSE c + 1 END AS INT) AS patch_idx,
              page_id % 3 <> 2 AS grid_ok FROM p, range(16) AS r(c) WHERE c < [12, 16, 10][page_id % 3 + 1]""",
        "page_words": _LINES
        + """, w AS (SELECT page_id, line_no, x0, x1, y0, y1, length(text) AS n, string_split(text, ' ') AS ws FROM lines WHERE length(text) > 0),
            e AS (SELECT page_id, y0, y1, x0 + (x1 - x0) * a / n AS wx0, x0 + (x1 - x0) * (a + length(ws[k])) / n AS wx1 FROM (SELECT *, CASE WHEN k > 1 THEN length(array_to_string(ws[1:k - 1], ' ')) + 1 ELSE 0 END AS a FROM w, unnest(range(1, len(ws) + 1)) AS u(k)) WHERE ws[k] <> '')
            SELECT page_id, region_no, count(*) AS n_words FROM e CROSS JOIN reg WHERE greatest(0, least(wx1, rx1) - greatest(wx0, rx0)) * greatest(0, least(y1, ry1) - greatest(y0, ry0)) / ((wx1 - wx0) * (y1 - y0)) >= 0.3 GROUP BY ALL""",
        "manifest_last_wins": _ENTRIES + "SELECT path, z.q AS query, z.t AS title, z.d AS doi, first_seen FROM e",
        "manifest_queries": _ENTRIES + "SELECT z.q AS query, min(first_seen) AS first_seen, count(*) AS n_files FROM e GROUP BY 1",
        "status_counts": "SELECT status, count(*) AS n FROM manifest GROUP BY status",
        "run_cost": "SELECT DISTINCT record_id, CASE WHEN usage.wall_seconds > 0 THEN round(100 * usage.cpu_seconds / usage.wall_seconds, 1) END AS cpu_percent FROM manifest WHERE usage IS NOT NULL",
        "latest_delivery": "SELECT record_id, arg_max(status, received_at) AS status, max(received_at) AS received_at FROM manifest GROUP BY record_id",
        "index_resume": "SELECT DISTINCT key FROM paper WHERE key IS NOT NULL AND key NOT IN (SELECT paper.doi FROM manifest WHERE paper.doi IS NOT NULL)",
        "upsert_papers": "WITH r AS (SELECT key, max(paper_id) AS paper_id, arg_max(rank, paper_id) AS r FROM paper WHERE key IS NOT NULL GROUP BY key) SELECT key, CASE WHEN r <= 5 THEN -paper_id ELSE paper_id END AS paper_id FROM r",
        "parse_openalex": answer.replace("location_no, title", "location_no, nullif(title, '') AS title").format(abstract="CAST(NULL AS VARCHAR)", doi="nullif(trim(doi), '')", pdf="nullif(pdf_url, '')", landing="landing_url"),
        "parse_europepmc": answer.format(abstract="abstract", doi="doi", pdf="nullif(pdf_url, '')", landing="coalesce(nullif(landing_url, ''), nullif(pdf_url, ''))"),
        "parse_semantic_scholar": answer.format(abstract="abstract", doi="doi", pdf="nullif(pdf_url, '')", landing="CAST(NULL AS VARCHAR)"),
        "parse_crossref": answer.format(abstract=plain, doi="doi", pdf="pdf_url", landing="landing_url"),
        "parse_arxiv": "SELECT cand_id, coalesce(pdf_url, '') AS pdf_url, coalesce(landing_url, '') AS landing_url FROM semantic_candidate WHERE title IS NOT NULL",
        "parse_unpaywall": answer.format(abstract="CAST(NULL AS VARCHAR)", doi="doi", pdf="nullif(pdf_url, '')", landing="nullif(landing_url, '')"),
    }
