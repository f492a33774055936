import json

import pytest
from pyspark.sql import functions as F

from plumbline import api
from plumbline.sources import files, live, payloads
from plumbline.streaming import log


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_lists(spark, tmp_path):
    p = tmp_path / "allow.txt"
    p.write_text("# hosts\nhttps://www.Example.org/x\n\nOther.net # note\n")
    assert rows(files.allowlist(spark, str(p))) == [("example.org",), ("other.net",)]
    p = tmp_path / "cite.txt"
    p.write_text("A Title\n# no\n\ndoi:10.1/x\n10.1234/abc\nT | doi:10.2/y\nT2 |\n")
    assert rows(files.citations(spark, str(p))) == sorted([("A Title", None), (None, "10.1/x"), (None, "10.1234/abc"), ("T", "10.2/y"), ("T2", None)], key=repr)
    p = tmp_path / "desc.txt"
    p.write_text("one\n\n# c\n two \n")
    assert rows(files.descriptions(spark, str(p))) == [("one",), ("two",)]


def test_json_lines(spark, tmp_path):
    p = tmp_path / "manifest.jsonl"
    p.write_text(json.dumps({"query": "q", "status": "downloaded", "path": "d\\a.pdf", "paper": {"title": "T", "rank": 1}}) + "\nnot json\n\n" + json.dumps({"query": "q2", "status": "failed"}) + "\n")
    got = files.manifest(spark, str(p))
    assert [(r.query, r.status) for r in got.orderBy("line_no").collect()] == [("q", "downloaded"), ("q2", "failed")]
    there = spark.createDataFrame([("/x/a.pdf",)], "path string")
    assert files.manifest(spark, str(p), there).count() == 1
    files.append_manifest(got.drop("line_no"), str(tmp_path / "out"))
    files.append_manifest(got.drop("line_no"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 4


def test_pools(spark, tmp_path):
    p = tmp_path / "pool.jsonl"
    p.write_text(json.dumps({"description": "d", "papers": [{"key": "k", "title": "T", "abstract": " "}, {"key": "j", "abstract": "x", "pdf_urls": ["u"]}]}) + "\n{bad\n")
    good, bad = files.pools(spark, str(p))
    assert good.count() == 1 and bad.count() == 1
    papers = files.pool_papers(good)
    assert [(r.key, r.title_only, r.pdf_urls) for r in papers.orderBy("pool_ordinal").collect()] == [("k", True, []), ("j", False, ["u"])]
    files.dump_pools(papers, str(tmp_path / "dump"))
    again = files.pools(spark, str(tmp_path / "dump"))[0]
    assert [r.key for r in files.pool_papers(again).orderBy("pool_ordinal").collect()] == ["k", "j"]


def test_pdf_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4" + b"x" * 2000)
    (tmp_path / "b.pdf").write_bytes(b"<html>" + b"x" * 2000)
    (tmp_path / "c.pdf").write_bytes(b"%PDF-")
    (tmp_path / "d.txt").write_bytes(b"%PDF-")
    got = {r.path[-5:]: r.is_pdf for r in files.pdf_files(spark, str(tmp_path)).collect()}
    assert got == {"a.pdf": True, "b.pdf": False, "c.pdf": False}


def answer(spark, value):
    return spark.createDataFrame([(1, json.dumps(value) if not isinstance(value, str) else value)], "query_id int, payload string")


def test_readers(spark):
    place = lambda u: {"pdf_url": u, "landing_page_url": f"l:{u}"}
    works = {"results": [{"display_name": "A", "doi": "https://doi.org/10.1/a", "abstract_inverted_index": {"b": [1], "a": [0]}, "best_oa_location": place("u1"), "primary_location": place("u1"), "locations": [place("u2"), place(None), place("u1")]}, {"title": "B", "best_oa_location": place(None)}]}
    got = payloads.openalex(answer(spark, works)).orderBy("item_no", "location_no").collect()
    assert [(r.title, r.pdf_url, r.landing_url, r.abstract) for r in got] == [("A", "u1", "l:u1", "a b"), ("A", "u2", "l:u2", "a b"), ("B", None, "l:None", None)]
    single = {"results": [{"title": "B", "open_access": {"oa_url": "oa"}}]}
    assert payloads.openalex_citation(answer(spark, single)).first().pdf_url == "oa"
    pmc = {"resultList": {"result": [{"title": "A", "abstractText": "x", "fullTextUrlList": {"fullTextUrl": [{"url": "h", "documentStyle": "html"}, {"url": "p", "documentStyle": "pdf"}]}}, {"title": "B"}]}}
    assert [(r.pdf_url, r.landing_url) for r in payloads.europepmc(answer(spark, pmc)).orderBy("item_no").collect()] == [("p", "h"), (None, None)]
    s2 = {"data": [None, {"title": "A", "openAccessPdf": {"url": "https://doi.org/10.1/x"}, "externalIds": {"DOI": "10.1/x"}}, {"title": "B", "openAccessPdf": None, "externalIds": {"ArXiv": "1706.03762"}}, {"title": "C", "openAccessPdf": {"url": "https://x.org/p.pdf"}}]}
    assert [(r.title, r.pdf_url, r.landing_url) for r in payloads.semantic_scholar(answer(spark, s2)).orderBy("item_no").collect()] == [("A", None, "https://doi.org/10.1/x"), ("B", "https://arxiv.org/pdf/1706.03762", None), ("C", "https://x.org/p.pdf", None)]
    assert payloads.semantic_scholar(answer(spark, s2), False).orderBy("item_no").first().pdf_url == "https://doi.org/10.1/x"
    cr = {"message": {"items": [{"title": ["A"], "abstract": "<jats:p>x  y</jats:p>", "DOI": "d", "URL": "u", "link": [{"URL": "h", "content-type": "text/html"}, {"URL": "p", "content-type": "application/pdf"}]}, {"title": []}]}}
    assert [(r.title, r.abstract, r.pdf_url) for r in payloads.crossref(answer(spark, cr)).orderBy("item_no").collect()] == [("A", "x y", "p"), (None, None, None)]
    up = {"title": "A", "doi": "d", "best_oa_location": {"url_for_pdf": "p", "url_for_landing_page": "l"}}
    assert payloads.unpaywall(answer(spark, up)).first().pdf_url == "p" and payloads.unpaywall(answer(spark, {"doi": "d"})).count() == 0
    xml = '<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom"><entry><id>i</id><title> T </title><summary> S </summary><arxiv:doi>d</arxiv:doi><link href="h" rel="alternate"/><link href="p" title="pdf"/></entry></feed>'
    r = payloads.arxiv(answer(spark, xml)).first()
    assert (r.title, r.abstract, r.doi, r.pdf_url, r.landing_url) == ("T", "S", "d", "p", "i")
    oa = '<OA><records><record><link format="tgz" href="ftp://a/t"/><link format="pdf" href="ftp://a/p.pdf"/></record></records></OA>'
    assert payloads.pmc_link(answer(spark, oa)).first().pdf_url == "https://a/p.pdf"


def test_pubmed(spark):
    search = spark.createDataFrame([(1, json.dumps({"esearchresult": {"idlist": ["1", "2", "3"]}})), (2, json.dumps({"esearchresult": {"idlist": ["3"]}}))], "req_id int, payload string")
    summaries = spark.createDataFrame([("1", "Other title", "10.1/A"), ("2", "Deep learning", "10.1/b"), ("3", "Deep learning", None)], "uid string, title string, doi string")
    requests = spark.createDataFrame([(1, "Deep learning", "10.1/a"), (2, None, "10.1/a")], "req_id int, title string, doi string")
    assert rows(payloads.pubmed(search, summaries, requests).select("req_id", "uid")) == [(1, "1"), (1, "3")]


def test_expander_answers(spark):
    cases = [('{"queries": ["a_b", "", "cD e"]}', ["a b", "c D e"], None), ('["x"]', ["x"], None), ('{"other": ["y", 3]}', ["y"], None), ('{"a": ["x"], "b": ["y"]}', [], "unexpected JSON shape"), ("nope{", [], "unparseable response"), ('{"queries": []}', [], "model returned no usable queries"), ('["1","2","3","4"]', ["1", "2", "3"], None), ('"text"', [], "unexpected JSON shape")]
    df = spark.createDataFrame([(i, p, 3) for i, (p, *_) in enumerate(cases)], "i int, payload string, variants int")
    got = payloads.expander_answers(df).orderBy("i").collect()
    assert [(r.queries, r.error) for r in got] == [(q, e) for _, q, e in cases]


def test_live_shells(spark):
    calls = []

    def get(url):
        calls.append(url)
        return (503, {"Retry-After": "7"}, b"") if len(calls) < 3 else (200, {"Content-Type": "x"}, b"%PDF-1")

    waits = []
    assert live.fetch(get, "u", waits.append)[0] == 200 and waits == [7.0, 7.0]

    def local(url):
        return {"a": (200, {"Content-Type": "application/pdf"}, b"x"), "b": (404, {"Content-Type": "application/pdf"}, b""), "c": (200, {}, b"%PDF-1.4")}[url[-1]]

    urls = spark.createDataFrame([(f"https://h{k}.org/{k}",) for k in "abc"], "url string")
    ok = live.is_fetchable(live.fetched(urls, local))
    assert rows(ok) == [("https://ha.org/a", True), ("https://hb.org/b", False), ("https://hc.org/c", True)]
    papers = spark.createDataFrame([(1, "https://ha.org/a"), (2, None), (3, "https://z.org/z")], "p int, url string")
    assert [r.pdf_verified for r in live.mark_verified(papers, ok).orderBy("p").collect()] == [True, False, False]


def test_stream(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.createDataFrame([("q", "downloaded", "a.pdf"), ("q", "failed", "b.pdf"), ("q", "failed", "b.pdf")], "query string, status string, path string").coalesce(1).write.json(src)
    for _ in range(2):
        log.append_new(log.log_stream(spark, src).select("query", "status", "path"), out, "path", ck).awaitTermination()
    spark.createDataFrame([("q", "failed", "a.pdf"), ("q", "failed", "c.pdf")], "query string, status string, path string").coalesce(1).write.mode("append").json(src)
    log.append_new(log.log_stream(spark, src).select("query", "status", "path"), out, "path", ck).awaitTermination()
    assert sorted(r.path for r in spark.read.parquet(out).collect()) == ["a.pdf", "b.pdf", "c.pdf"]


def test_api(spark):
    req = spark.createDataFrame([(1, "Deep learning", None), (1, "Deep learning", None)], "req_id int, title string, doi string")
    cand = spark.createDataFrame([(1, 0, "Deep learning", None, "https://a.org/1", False, False), (1, 1, "Deep Learning!", None, "https://b.org/2", True, False), (1, 2, "Other", None, "https://b.org/3", True, False)], "req_id int, ordinal int, title string, doi string, pdf_url string, pdf_verified boolean, doi_keyed boolean")
    assert [r.ordinal for r in api.resolve_citations(req, cand).orderBy("final_pos").collect()] == [1, 0]
    hosts = spark.createDataFrame([("a.org",)], "host string")
    assert [r.ordinal for r in api.resolve_citations(req, cand, hosts).orderBy("final_pos").collect()] == [0, 1]
    works = spark.createDataFrame([(i, [1.0, i / 10], i == 0, f"u{i}") for i in range(8)], "work_id long, vec array<double>, title_only boolean, url string")
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vec array<double>")
    assert [r.work_id for r in api.rank_descriptions(asked, works, k=2).orderBy("rank").collect()] == [1, 2]
    probes = spark.createDataFrame([("u4", True)], "url string, ok boolean")
    assert {r.work_id for r in api.rank_descriptions(asked, works, k=2, probes=probes).collect()} == {1, 4}
    patches = spark.createDataFrame([(1, 0, [1.0]), (1, 1, [0.5]), (2, 0, [0.1])], "page_id long, patch_idx int, vec array<float>")
    tokens = spark.createDataFrame([(0, [1.0])], "tok int, vec array<float>")
    grids = spark.createDataFrame([(1, 1, 2, True, 10.0, 10.0), (2, 1, 1, True, 10.0, 10.0)], "page_id long, grid_rows int, grid_cols int, grid_ok boolean, width_pt double, height_pt double")
    cells = patches.select("page_id", F.col("patch_idx").alias("cell"), "patch_idx")
    top, regions = api.search_pages(patches, tokens, grids, cells, k=1)
    assert [r.page_id for r in top.collect()] == [1] and regions.count() == 1


def test_entry(spark):
    import __spark_entry__

    q, o = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(o) <= set(q) and len(q) > 50
    with pytest.raises(KeyError):
        q["nothing"]
