import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from plumbline.operators import attribution, calibrate, chunking, identity, layout, pool, provenance, rank
from plumbline.sources import files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- selection


def probe_loop(ok, k, most=45):
    """Widening probes one by one, as a loop would do it."""
    n, seen, at = min(len(ok), most), 0, 0
    while at < n and seen < k:
        step = ok[at : min(n, at + 3 * k)]
        seen, at = seen + sum(step), at + len(step)
    verified = [i for i in range(len(ok)) if i < at and ok[i]]
    rest = [i for i in range(len(ok)) if i not in verified]
    return set((verified + rest)[:k]), at


def test_fetchable_first_equals_the_loop(spark):
    rnd, data, expected = random.Random(7), [], {}
    for q in range(60):
        n, p = rnd.choice([0, 1, 3, 7, 20, 50, 80]), rnd.random()
        ok = [rnd.random() < p for _ in range(n)]
        expected[q] = probe_loop(ok, 5)
        data += [(q, i, 0.99 - i / 1000, ok[i], i + 1) for i in range(n)]
    df = spark.createDataFrame(data, "query_id int, paper_id int, similarity double, ok boolean, similarity_rank int")
    got = rank.fetchable_first(df, "query_id", "similarity", "ok").collect()
    for q, (kept, window) in expected.items():
        own = [r for r in got if r.query_id == q]
        assert {r.paper_id for r in own} == kept
        assert all(r.verified_window == window for r in own)
        assert [r.paper_id for r in sorted(own, key=lambda r: r.rank)] == sorted(kept)
        assert all(r.pdf_verified == (r.ok and r.paper_id < window) for r in own)


def test_equal_similarity_puts_fetchable_first(spark):
    df = spark.createDataFrame([(1, i, 0.8, i == 2, i + 1) for i in range(4)], "query_id int, paper_id int, similarity double, ok boolean, similarity_rank int")
    got = rank.fetchable_first(df, "query_id", "similarity", "ok", k=3).orderBy("rank").collect()
    assert [r.paper_id for r in got] == [2, 0, 1]


def test_floor_is_inclusive_and_ties_keep_order(spark):
    df = spark.createDataFrame([(1, 3, 0.70), (1, 1, 0.70), (1, 2, 0.699)], "q int, o int, s double")
    assert [(r.o, r.similarity_rank) for r in rank.ranked(df, "q", "s", "o").orderBy("similarity_rank").collect()] == [(1, 1), (3, 2)]


def test_score_summary_picks_by_index(spark):
    rnd, data = random.Random(1), []
    for g in range(30):
        data += [(g, rnd.random()) for _ in range(rnd.randint(1, 40))]
    got = {r.g: r for r in calibrate.score_summary(spark.createDataFrame(data, "g int, s double"), "g", "s").collect()}
    for g in range(30):
        s = sorted((x for k, x in data if k == g), reverse=True)
        n = len(s)
        assert got[g].score_median == round(s[min(n - 1, int(0.5 * n))], 4) and got[g].score_top10 == round(s[min(n - 1, int(0.1 * n))], 4)


# --- pools


def fold_works(candidates):
    """The sequential merge: the first candidate of a title fixes its key."""
    keys, works = {}, {}
    for ordinal, title, doi, abstract, source in candidates:
        norm = " ".join("".join(c if c.isalnum() else " " for c in (title or "").lower()).split())
        if not norm:
            continue
        key = keys.setdefault(norm, ((doi or "").strip().lower() or None) or f"title:{norm}")
        w = works.setdefault(key, {"title": title, "abstract": None, "sources": []})
        if abstract and len(abstract) > len(w["abstract"] or ""):
            w["abstract"] = abstract
        if source not in w["sources"]:
            w["sources"].append(source)
    return works


def test_merge_equals_the_fold(spark):
    rnd = random.Random(5)
    titles, dois, abstracts = ["A b", "a  B!", "C", "D e f", None, "--"], [None, "10.1/x", " 10.1/X", "10.1/y", ""], [None, "", "short", "a longer one", "another one!"]
    data, expected = [], {}
    for q in range(40):
        own = [(o, rnd.choice(titles), rnd.choice(dois), rnd.choice(abstracts), rnd.choice("xyz")) for o in range(rnd.randint(0, 12))]
        expected[q] = fold_works(own)
        data += [(q, o, 100 * q + o, s, o % 3, t, a, d, None, None) for o, t, d, a, s in own]
    df = spark.createDataFrame(data, "query_id int, ordinal int, cand_id int, source string, query_index int, title string, abstract string, doi string, pdf_url string, landing_url string")
    got = {}
    for r in pool.merge_works(df).collect():
        got.setdefault(r.query_id, {})[r.key] = {"title": r.title, "abstract": r.abstract, "sources": r.retrieval_sources}
    assert got == {q: w for q, w in expected.items() if w}
    assert pool.merge_works(df.limit(0)).count() == 0


def test_truncated_errors_and_expansion(spark):
    c = spark.createDataFrame([(1, "a", 0)] * 3 + [(1, "a", 1)] * 2 + [(1, "b", 0)] * 2 + [(2, "b", 0)] * 4, "query_id int, source string, query_index int")
    assert rows(pool.truncated_sources(c, 3)) == [(1, ["a"]), (2, ["b"])]
    e = spark.createDataFrame([(1, "a", None, 0), (1, "a", "late", 2), (1, "a", "first", 1), (1, "b", "x", 5)], "query_id int, source string, error string, ordinal int")
    assert pool.first_errors(e).first().errors == {"a": "first", "b": "x"}
    x = spark.createDataFrame([(1, 0, "A b"), (1, 1, "a B"), (1, 2, "c"), (1, 3, ""), (1, 4, None)], "query_id int, pos int, text string")
    assert [(r.query_index, r.text) for r in pool.expanded_queries(x).orderBy("query_index").collect()] == [(0, "A b"), (1, "c")]


def test_pick_best(spark):
    data = [(1, 0, 0.9, False), (1, 1, 0.9, True), (1, 2, 0.85, True), (2, 0, 1.0, False), (2, 1, 0.9, True), (3, 0, 0.83, False)]
    df = identity.candidate_order(spark.createDataFrame(data, "req_id int, ordinal int, score double, ok boolean"), "req_id", "score", "ok", ["ordinal"])
    best = identity.pick_best(df, "req_id", "score", "ok")
    assert rows(best.where("is_best").select("req_id", "ordinal")) == [(1, 1), (2, 0), (3, 0)]
    assert [r.ordinal for r in identity.best_first(best, "req_id").where("req_id = 1").orderBy("final_pos").collect()] == [1, 0, 2]


# --- late interaction


def test_maxsim_and_ties(spark):
    patches = spark.createDataFrame([(1, 0, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (1, 2, [0.0, 2.0]), (2, 0, [3.0, 0.0]), (3, 0, [])], "page_id long, patch_idx int, vec array<float>")
    tokens = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "tok int, vec array<float>")
    got = attribution.token_maxima(patches, tokens)
    assert rows(got) == rows(spark.createDataFrame([(1, 0, 1.0, 0), (1, 1, 2.0, 2), (2, 0, 3.0, 0), (2, 1, 0.0, 0)], "p long, t int, b double, i int"))
    assert [tuple(r) for r in attribution.top_pages(attribution.page_scores(got), 1).collect()] == [(1, 3.0)]
    assert attribution.token_maxima(patches, tokens.limit(0)).count() == 0
    assert rows(attribution.token_maxima(patches, tokens, block=1)) == rows(got)


def test_heat_blur_components_regions(spark):
    r, c = 12, 16
    heat = {(p, i): 0.0 for p in (1, 2) for i in range(r * c)}
    heat[1, 0] = 5.0
    heat[2, 0], heat[2, r * c - 1] = 5.0, 4.0
    h = spark.createDataFrame([(p, i, v) for (p, i), v in heat.items()], "page_id long, cell int, v double")
    grids = spark.createDataFrame([(1, r, c, True, 160.0, 120.0), (2, r, c, True, 160.0, 120.0)], "page_id long, grid_rows int, grid_cols int, grid_ok boolean, width_pt double, height_pt double")
    smooth = attribution.blurred(h, grids)
    corner = smooth.where("page_id = 1 AND cell = 0").first().v
    assert corner == pytest.approx(5.0 / 4) and smooth.where("page_id = 1 AND cell = 1").first().v == pytest.approx(5.0 / 6)
    parts = attribution.components(attribution.hot_cells(smooth), grids)
    scores = spark.createDataFrame([(1, 10.0), (2, 10.0)], "page_id long, score double")
    found = [(x.page_id, x.region_no, x.component, round(x.share, 3)) for x in attribution.regions(parts, h, scores, grids).orderBy("page_id", "region_no").collect()]
    assert found[0][:3] == (1, 1, 0) and found[0][3] == 0.5
    assert [(p, n) for p, n, *_ in found] == [(1, 1), (2, 1), (2, 2)] and found[2][3] == 0.4


def test_hot_cells_against_formula(spark):
    rnd, data = random.Random(9), []
    for p in range(20):
        data += [(p, i, rnd.choice([0.0, 0.0, rnd.random()])) for i in range(25)]
    got = {(r.page_id, r.cell) for r in attribution.hot_cells(spark.createDataFrame(data, "page_id int, cell int, v double")).where("hot").collect()}
    for p in range(20):
        v = [x for q, _, x in data if q == p]
        limit = statistics.fmean(v) + 0.5 * statistics.pstdev(v)
        sure = {i for i, x in enumerate(v) if x > 0 and x >= limit + 1e-9}
        assert sure <= {c for q, c in got if q == p} <= {i for i, x in enumerate(v) if x > 0 and x >= limit - 1e-9}


# --- layout


def greedy_columns(lines):
    left, right = min(x[1] for x in lines), max(x[3] for x in lines)
    wide = [x for x in lines if right > left and x[3] - x[1] >= 0.7 * (right - left)]
    columns = [sorted(wide, key=lambda x: (round(x[2], 1), x[1], x[0]))] if wide else []
    spans, groups = [], []
    for line in sorted((x for x in lines if x not in wide), key=lambda x: (x[1], x[0])):
        for i, (a, b) in enumerate(spans):
            if min(line[3], b) > max(line[1], a):
                groups[i].append(line)
                spans[i] = (min(a, line[1]), max(b, line[3]))
                break
        else:
            groups.append([line])
            spans.append((line[1], line[3]))
    return [x[0] for g in columns + [sorted(g, key=lambda x: (round(x[2], 1), x[1], x[0])) for g in groups] for x in g]


def test_reading_order_equals_greedy_grouping(spark):
    rnd, data, expected = random.Random(3), [], {}
    for p in range(60):
        own = [(k, float(x := rnd.randint(0, 400)), float(rnd.randint(0, 9) * 10), x + float(rnd.randint(5, 200))) for k in range(rnd.randint(1, 9))]
        expected[p] = greedy_columns(own)
        data += [(p, k, x0, y0, x1, y0 + 8, f"t{k}") for k, x0, y0, x1 in own]
    df = spark.createDataFrame(data, "page_id int, line_no int, x0 double, y0 double, x1 double, y1 double, text string")
    got = {}
    for r in layout.reading_order(df, ["page_id"]).orderBy("page_id", "reading_no").collect():
        got.setdefault(r.page_id, []).append(r.line_no)
    assert got == expected
    text = layout.snippets(layout.reading_order(df, ["page_id"]), ["page_id"]).where("page_id = 0").first().snippet
    assert text == " ".join(f"t{k}" for k in expected[0])


def test_tiled_layout(spark):
    def tokens(page, tiles, per):
        out = []
        for name in tiles:
            out += [name, *["<image>"] * per]
        return [(page, k, t) for k, t in enumerate(out)]

    good = tokens(1, ["<row_1_col_1>", "<row_1_col_2>", "<row_2_col_1>", "<row_2_col_2>", "<global>"], 4)
    missing = tokens(2, ["<row_1_col_1>", "<row_2_col_2>"], 4)
    ragged = tokens(3, ["<row_1_col_1>"], 4) + [(3, 5, "<row_1_col_2>"), (3, 6, "<image>")]
    oblong = tokens(4, ["<row_1_col_1>"], 3)
    df = spark.createDataFrame(good + missing + ragged + oblong, "page_id int, pos int, token string")
    got = layout.tiled_layout(layout.image_runs(df, F.col("token") == "<image>")).orderBy("page_id", "cell").collect()
    assert {(r.page_id, r.grid_rows, r.grid_cols) for r in got} == {(1, 4, 4)}
    assert [r.patch_idx for r in got] == [1, 2, 6, 7, 3, 4, 8, 9, 11, 12, 16, 17, 13, 14, 18, 19]


# --- the log


def test_log(spark):
    data = [(1, "q1", "downloaded", "a\\x-y_1.pdf", None), (2, "q2", "downloaded", "b.pdf", "T"), (3, "q3", "downloaded", "c/x-y_1.pdf", "New"), (4, "q1", "failed", "z.pdf", None), (5, None, "downloaded", None, None)]
    schema = "record_id int, query string, status string, path string, title string"
    df = spark.createDataFrame(data, schema).selectExpr("*", "named_struct('title', title, 'doi', CAST(NULL AS STRING)) AS paper", "named_struct('matched_title', CAST(NULL AS STRING), 'doi', '10.1/r') AS resolution")
    got = provenance.downloaded_entries(df, ["record_id"])
    assert rows(got) == [("b.pdf", "q2", "T", "10.1/r", 2), ("x-y_1.pdf", "q3", "New", "10.1/r", 1)]
    with pytest.raises(ValueError):
        provenance.resolve_query(got)
    assert provenance.resolve_query(got, 0) == "q3" and provenance.resolve_query(got, 1) == "q2"
    assert rows(provenance.status_counts(df)) == [("downloaded", 4), ("failed", 1)]
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert rows(provenance.upsert(old, new, "k")) == [(1, "a"), (2, "c"), (3, "d")]
    tries = spark.createDataFrame([(1, "u1", 0, False, "r1"), (1, "u2", 1, True, None), (2, "u3", 1, False, "r3"), (2, "u4", 0, False, "r4")], "p int, url string, pos int, ok boolean, reason string")
    assert rows(provenance.first_success(tries, ["p"])) == [(1, "u2", None), (2, None, "r4; r3")]


def test_chunks(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(1000)))), (2, "a b"), (3, ""), (4, None), (5, " ".join(["w"] * 512))], "id int, t string")
    got = {(r.ident, r.chunk_no): r for r in chunking.chunk_documents(df, "id", "t").collect()}
    assert sorted(got) == [(1, 0), (1, 1), (1, 2), (2, 0), (5, 0)]
    assert got[1, 1].text.split()[0] == "412" and got[1, 2].n_words == 1000 - 824
    assert math.isclose(sum(got[1, k].n_words for k in range(3)), 1000 + 2 * 100)


def test_hot_query_is_ranked_and_summed_in_steps(spark):
    rnd = random.Random(6)
    data = [(1, k, rnd.choice([0.71, 0.75, rnd.random()])) for k in range(900)] + [(k % 40, 1000 + k, rnd.random()) for k in range(600)] + [(3, 5000, None), (4, 5001, float("nan")), (77, 5002, None)]
    df = spark.createDataFrame(data, "query_id long, paper_id long, similarity double")
    got = {(r.query_id, r.paper_id): r.similarity_rank for r in rank.ranked(df, "query_id", "similarity", "paper_id").collect()}
    expected = {}
    for q in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == q and r[2] is not None and not r[2] < rank.FLOOR), key=lambda r: (-(r[2] if r[2] == r[2] else 9), r[1]))
        expected |= {(q, r[1]): k + 1 for k, r in enumerate(own)}
    assert got == expected
    assert {(r.query_id, r.paper_id): r.similarity_rank for r in rank.best_ranked(df, "query_id", "similarity", "paper_id", 5).collect()} == {k: v for k, v in expected.items() if v <= 5}
    for r in calibrate.score_summary(df, "query_id", "similarity").collect():
        own = sorted((x[2] for x in data if x[0] == r.query_id and x[2] is not None), key=lambda x: -(x if x == x else 9))
        n = sum(x[0] == r.query_id for x in data)
        own += [None] * (n - len(own))
        assert r.pool_size == n
        for share, value in ((0.1, r.score_top10), (0.5, r.score_median)):
            want = own[min(n - 1, int(share * n))]
            assert value == want if want is None else abs(value - want) < 1e-4 or value != value


def test_tokens_in_blocks(spark):
    patches = spark.createDataFrame([(p, i, [float((p * 7 + i * 3 + k) % 5) for k in range(3)]) for p in range(3) for i in range(4)], "page_id long, patch_idx int, vec array<double>")
    tokens = spark.createDataFrame([(t, [float((t * k) % 7 - 3) for k in range(1, 4)]) for t in range(11)], "tok int, vec array<double>")
    whole, blocks = (sorted(map(tuple, attribution.token_maxima(patches, tokens, n).collect())) for n in (4096, 4))
    assert whole == blocks and len(whole) == 33


def test_jobs_and_answers(spark):
    jobs = pool.fan_out(spark.createDataFrame([(1, 0), (1, 1)], "query_id long, query_index int"), ["a", "b"])
    assert sorted(map(tuple, jobs.collect())) == [(1, 0, "a", 0), (1, 0, "b", 1), (1, 1, "a", 2), (1, 1, "b", 3)]
    results = spark.createDataFrame([(1, 1, "a", 0, "z"), (1, 0, "b", 1, "y"), (1, 0, "b", 0, "x"), (1, 0, "a", 0, "lost")], "query_id long, query_index int, source string, place int, title string")
    errors = spark.createDataFrame([(1, 0, "a", "timeout")], "query_id long, query_index int, source string, error string")
    found, failed = pool.answers(jobs, results, errors)
    assert sorted((r.ordinal, r.title) for r in found.collect()) == [(0, "x"), (1, "y"), (2, "z")]
    assert [(r.job, r.error) for r in failed.collect()] == [(0, "timeout")]


def test_downloads_are_guarded_and_stored_whole(spark, tmp_path):
    ok, small, page = b"%PDF-1.7" + b"x" * 2000, b"%PDF-1.7", b"<html>" + b"x" * 2000
    rows = [("a.pdf", "http://h.example/a", "http://h.example/a", 200, ok), ("b.pdf", "http://h.example/b", "http://evil.example/b", 200, ok), ("c.pdf", "http://h.example/c", None, 200, small), ("d.pdf", "http://h.example/d", None, 200, page), ("e.pdf", "http://h.example/e", None, 404, ok), ("f.pdf", "http://h.example/f", None, 200, None)]
    df = spark.createDataFrame(rows, "name string, url string, landed string, status int, content binary")
    reason = files.download_outcome(F.col("url"), F.col("landed"), F.col("status"), F.col("content"), lambda u: F.contains(u, F.lit("//h.example")))
    out = df.withColumn("reason", reason)
    assert {r.name: r.reason for r in out.collect()} == {"a.pdf": None, "b.pdf": "redirected off-allowlist to evil.example", "c.pdf": "file too small (8 bytes)", "d.pdf": "response is not a PDF", "e.pdf": "status 404", "f.pdf": "response is not a PDF"}
    stored = files.store_files(out.where("reason IS NULL"), str(tmp_path / "pdf")).collect()
    assert [r.name for r in stored] == ["a.pdf"] and [p.name for p in (tmp_path / "pdf").iterdir()] == ["a.pdf"]
    assert files.missing_paths(spark, str(tmp_path / "pdf"), str(tmp_path / "no"), str(tmp_path / "ab")) == sorted([str(tmp_path / "no"), str(tmp_path / "ab")])
