"""Answers of bibliographic services as candidate rows; each reader takes a table with ``payload`` and keeps its other columns.

All readers give ``source, title, abstract, doi, pdf_url, landing_url`` and ``item_no, location_no`` for the order of the answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import from_positions, host, strip_markup

COLUMNS = ("source", "item_no", "location_no", "title", "abstract", "doi", "pdf_url", "landing_url")


def _some(c: Column) -> Column:
    """Null instead of an empty string."""
    return F.nullif(c, F.lit(""))


def _items(df: DataFrame, schema: str, path: str) -> DataFrame:
    parsed = df.withColumn("_answer", F.from_json("payload", schema))
    return parsed.select(*df.columns, F.posexplode(F.col(f"_answer.{path}")).alias("item_no", "_item")).where("_item IS NOT NULL")


def _out(df: DataFrame, kept: list[str], source: str, **values: Column) -> DataFrame:
    at = values.pop("location_no", F.lit(0))
    named = {c: values.get(c, F.lit(None).cast("string")) for c in COLUMNS[3:]}
    return df.select(*kept, F.lit(source).alias("source"), "item_no", at.cast("int").alias("location_no"), *[v.alias(c) for c, v in named.items()])


def openalex(df: DataFrame) -> DataFrame:
    """One row for each distinct open copy: best, primary, then all locations; a work without a copy gives one row."""
    place = "struct<pdf_url:string,landing_page_url:string>"
    item = f"display_name:string,title:string,doi:string,abstract_inverted_index:string,best_oa_location:{place},primary_location:{place},locations:array<{place}>"
    rows = _items(df, f"results array<struct<{item}>>", "results")
    places = F.concat(F.array("_item.best_oa_location", "_item.primary_location"), F.coalesce("_item.locations", F.array().cast(f"array<{place}>")))
    open_ones = F.filter(places, lambda p: _some(p["pdf_url"]).isNotNull())
    urls = F.array_distinct(F.transform(open_ones, lambda p: p["pdf_url"]))
    rows = rows.withColumn("_open", open_ones).select("*", F.posexplode_outer(urls).alias("_k", "_url"))
    of_url = F.element_at(F.filter("_open", lambda p: p["pdf_url"] == F.col("_url")), 1)
    landing = F.when(F.col("_url").isNull(), F.col("_item.best_oa_location.landing_page_url")).otherwise(of_url["landing_page_url"])
    return _out(
        rows, df.columns, "openalex", location_no=F.coalesce("_k", F.lit(0)), title=F.coalesce(_some(F.col("_item.display_name")), F.col("_item.title")), abstract=from_positions("_item.abstract_inverted_index"),
        doi=_some(F.regexp_replace("_item.doi", "https://doi.org/", "")), pdf_url=F.col("_url"), landing_url=landing,
    )


def openalex_citation(df: DataFrame) -> DataFrame:
    """As ``openalex``, but a work without a location falls back to its one open address."""
    schema = "results array<struct<open_access:struct<oa_url:string>>>"
    fallback = df.select(*df.columns, F.posexplode(F.from_json("payload", schema)["results"]).alias("item_no", "_w")).select("payload", "item_no", F.col("_w.open_access.oa_url").alias("_oa"))
    rows = openalex(df).join(fallback.distinct(), ["payload", "item_no"], "left")
    return rows.withColumn("pdf_url", F.coalesce("pdf_url", "_oa")).drop("_oa")


def europepmc(df: DataFrame) -> DataFrame:
    """Only addresses of style pdf are copies; the first address of any style is the landing page."""
    rows = _items(df, "resultList struct<result:array<struct<title:string,abstractText:string,doi:string,fullTextUrlList:struct<fullTextUrl:array<struct<url:string,documentStyle:string>>>>>>", "resultList.result")
    urls = F.col("_item.fullTextUrlList.fullTextUrl")
    pdfs = F.transform(F.filter(urls, lambda u: (u["documentStyle"] == "pdf") & _some(u["url"]).isNotNull()), lambda u: u["url"])
    landing = F.try_element_at(F.filter(urls, lambda u: _some(u["url"]).isNotNull()), F.lit(1))["url"]
    rows = rows.select("*", F.posexplode_outer(pdfs).alias("_k", "_url"))
    return _out(rows, df.columns, "europepmc", location_no=F.coalesce("_k", F.lit(0)), title=F.col("_item.title"), abstract=F.col("_item.abstractText"), doi=F.col("_item.doi"), pdf_url=F.col("_url"), landing_url=landing)


def semantic_scholar(df: DataFrame, resolver_is_landing: bool = True) -> DataFrame:
    """A DOI resolver's address is a landing page, not a copy (unless told otherwise); an arXiv identifier stands in for a missing copy."""
    rows = _items(df, "data array<struct<title:string,abstract:string,externalIds:struct<DOI:string,ArXiv:string>,openAccessPdf:struct<url:string>>>", "data")
    pdf, arxiv = _some(F.col("_item.openAccessPdf.url")), _some(F.col("_item.externalIds.ArXiv"))
    resolver = F.coalesce(F.endswith(host(pdf), F.lit("doi.org")), F.lit(False)) if resolver_is_landing else F.lit(False)
    copy = F.coalesce(F.when(~resolver, pdf), F.concat(F.lit("https://arxiv.org/pdf/"), arxiv))
    return _out(rows, df.columns, "semantic_scholar", title=F.col("_item.title"), abstract=F.col("_item.abstract"), doi=F.col("_item.externalIds.DOI"), pdf_url=copy, landing_url=F.when(resolver, pdf))


def crossref(df: DataFrame) -> DataFrame:
    """The first link of type application/pdf; markup is taken out of the abstract."""
    rows = _items(df, "message struct<items:array<struct<title:array<string>,abstract:string,DOI:string,URL:string,link:array<struct<URL:string,`content-type`:string>>>>>", "message.items")
    pdf = F.try_element_at(F.filter("_item.link", lambda x: x["content-type"] == "application/pdf"), F.lit(1))["URL"]
    return _out(rows, df.columns, "crossref", title=F.try_element_at("_item.title", F.lit(1)), abstract=strip_markup("_item.abstract"), doi=F.col("_item.DOI"), pdf_url=pdf, landing_url=F.col("_item.URL"))


def unpaywall(df: DataFrame) -> DataFrame:
    """The best open location of one DOI."""
    a = F.from_json("payload", "title string, doi string, best_oa_location struct<url_for_pdf:string,url:string,url_for_landing_page:string>")
    rows = df.withColumn("_a", a).withColumn("item_no", F.lit(0)).where("_a.best_oa_location IS NOT NULL")
    best = F.col("_a.best_oa_location")
    return _out(rows, df.columns, "unpaywall", title=F.col("_a.title"), doi=F.col("_a.doi"), pdf_url=_some(best["url_for_pdf"]), landing_url=F.coalesce(_some(best["url_for_landing_page"]), best["url"]))


def arxiv(df: DataFrame) -> DataFrame:
    """Entries of an Atom feed; the copy is the link titled pdf."""
    entry = "struct<title:string,summary:string,id:string,doi:string,link:array<struct<_href:string,_title:string>>>"
    clean = F.regexp_replace(F.regexp_replace("payload", r"<(/?)[A-Za-z]+:", "<$1"), r'\sxmlns(:\w+)?="[^"]*"', "")
    rows = df.select(*df.columns, F.posexplode(F.from_xml(clean, f"entry array<{entry}>")["entry"]).alias("item_no", "_item"))
    pdf = F.try_element_at(F.filter("_item.link", lambda x: x["_title"] == "pdf"), F.lit(1))["_href"]
    return _out(rows, df.columns, "arxiv", title=F.trim("_item.title"), abstract=_some(F.trim("_item.summary")), doi=F.col("_item.doi"), pdf_url=pdf, landing_url=F.col("_item.id"))


def pmc_link(df: DataFrame) -> DataFrame:
    """``pdf_url`` of an open-access answer: the first link of format pdf, file-transfer addresses as web addresses."""
    links = F.from_xml("payload", "records struct<record:array<struct<link:array<struct<_format:string,_href:string>>>>>")["records"]["record"]
    flat = F.flatten(F.transform(links, lambda r: r["link"]))
    first = F.try_element_at(F.filter(flat, lambda x: x["_format"] == "pdf"), F.lit(1))["_href"]
    return df.withColumn("pdf_url", F.regexp_replace(first, "^ftp://", "https://"))


def pubmed(search: DataFrame, summaries: DataFrame, requests: DataFrame) -> DataFrame:
    """Found identifiers joined with their summaries, kept where the DOI, or else the title, is the requested one.

    ``search``: ``req_id, payload``; ``summaries``: ``uid, title, doi``; ``requests``: ``req_id, title, doi``. Two DOIs are compared alone; without a DOI on
    either side the title decides; without a title the record is dropped.
    """
    from plumbline.operators.identity import THRESHOLD, title_similarity

    ids = search.select("req_id", F.posexplode(F.from_json("payload", "esearchresult struct<idlist:array<string>>")["esearchresult"]["idlist"]).alias("item_no", "uid"))
    asked = requests.select("req_id", F.col("title").alias("asked_title"), F.nullif(F.lower(F.trim("doi")), F.lit("")).alias("asked_doi"))
    rows = ids.join(summaries.withColumn("has_doi", F.nullif(F.lower(F.trim("doi")), F.lit(""))), "uid").join(asked, "req_id")
    like = title_similarity("asked_title", "title")
    keep = F.when(F.col("asked_doi").isNotNull() & F.col("has_doi").isNotNull(), F.col("asked_doi") == F.col("has_doi")).otherwise(F.coalesce(like >= THRESHOLD, F.lit(False)))
    return rows.where(keep).select("req_id", "item_no", "uid", "title", "doi")


READERS = {"openalex": openalex, "europepmc": europepmc, "semantic_scholar": semantic_scholar, "crossref": crossref, "unpaywall": unpaywall, "arxiv": arxiv}


def expander_answers(df: DataFrame, limit_column: str = "variants") -> DataFrame:
    """``queries, error`` of model answers: a list under ``queries``, the only list under another key, or a bare list.

    Anything else is an error, not an exception. Queries are made plain words, blank ones dropped, and cut to ``limit_column`` before any duplicates go.
    """
    from plumbline.functions.text import split_compounds

    v = F.try_parse_json("payload")
    as_map = F.from_json("payload", "map<string,string>")
    named = F.when(F.trim("payload").startswith("{"), as_map["queries"])
    lists = F.map_values(F.map_filter(as_map, lambda _, x: F.trim(x).startswith("[")))
    raw = F.when(F.trim("payload").startswith("["), F.col("payload")).otherwise(F.coalesce(named, F.when(F.size(lists) == 1, lists[0])))
    found = F.when(F.trim(raw).startswith("["), F.from_json(raw, "array<string>"))
    # a number or an object within the list is no query; JSON text of a string element begins with a quote
    typed = F.from_json(F.regexp_replace(raw, r"(?<=[\[,])\s*(-?[0-9.]+|true|false|null|\{[^}]*\})\s*(?=[,\]])", "null"), "array<string>")
    plain = F.filter(F.transform(F.filter(F.coalesce(typed, found), lambda q: q.isNotNull()), split_compounds), lambda q: q != "")
    shaped = found.isNotNull()
    error = F.when(v.isNull(), "unparseable response").when(~shaped, "unexpected JSON shape").when(F.size(plain) == 0, "model returned no usable queries")
    return df.withColumn("queries", F.when(error.isNull(), F.slice(plain, F.lit(1), F.col(limit_column))).otherwise(F.array().cast("array<string>"))).withColumn("error", error)
