import difflib
import hashlib
import random
import unicodedata
import uuid

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text as T
from plumbline.functions.vectors import cosine, dot, products
from plumbline.operators import identity


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


def test_normalize_title(spark):
    got = column(spark, ["Attention Is All You Need!", "  Éfïcient – Ünits ", "ﬁne", "ＡＢ１", "é", None, "—", "a_b"], T.normalize_title("x"))
    assert got == ["attention is all you need", "efficient units".replace("ffi", "fi"), "fine", "ab1", "e", None, "", "a b"]


def test_strip_markup_and_queries(spark):
    assert column(spark, ["<p>a <i>b</i></p>", "<br/>", None, "x"], T.strip_markup("x")) == ["a b", None, None, "x"]
    assert column(spark, ['ti:"a b" (c)~2'], T.clean_query("x")) == ["ti a b c 2"]
    assert column(spark, ["neural_networksFocus-selection", 'say "x"'], T.split_compounds("x")) == ["neural networks Focus selection", "say x"]


def test_hosts(spark):
    urls = ["https://www.Example.org/a", "example.org", "http://user@pdf.example.org:80/x?y", None, "", "ftp://a.b/c"]
    assert column(spark, urls, T.host("x")) == ["example.org", "example.org", "pdf.example.org", None, None, "a.b"]


def test_allowlist(spark):
    hosts = spark.createDataFrame([("www.example.org",), ("pdf.other.net",)], "host string")
    urls = spark.createDataFrame([("https://example.org/1",), ("https://a.example.org/2",), ("https://notexample.org/3",), ("https://example.org.evil.com/4",), ("https://other.net/5",), ("https://pdf.other.net/6",), (None,)], "url string")
    assert sorted(r.url[-1] for r in identity.allowed_urls(urls, hosts).collect()) == ["1", "2", "6"]


def test_location_doi(spark):
    urls = ["https://arxiv.org/pdf/1706.03762v5", "https://arxiv.org/abs/cs.CL/0102003", "https://x.org/a.pdf", None]
    assert column(spark, urls, T.location_doi("x", F.lit("10.1/w"))) == ["10.48550/arXiv.1706.03762", "10.48550/arXiv.cs.CL/0102003", "10.1/w", "10.1/w"]


def test_uuid5(spark):
    names = ["abc:1:m", "", "ü"]
    assert column(spark, names, T.uuid5(str(uuid.NAMESPACE_URL), "x")) == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


def test_slugs(spark):
    long = "A Very " * 20
    got = column(spark, ["Attention Is All!", long, None], T.semantic_slug("x", F.lit("http://a/b")))
    digest = hashlib.sha256(b"http://a/b").hexdigest()[:10]
    assert got[0] == f"attention-is-all_{digest}" and got[2] == digest and len(got[1].split("_")[0]) <= 80
    assert column(spark, ["T"], T.citation_slug("x", F.lit("10.1/Ab"), F.lit("u"))) == ["t_10-1-ab"]
    assert column(spark, ["T"], T.citation_slug("x", F.lit(None).cast("string"), F.lit("u"))) == ["t_" + hashlib.sha1(b"u").hexdigest()[:8]]


def test_small_texts(spark):
    assert column(spark, ['{"b":[1],"a":[0,2]}', "{}", None], T.from_positions("x")) == ["a b a", None, None]
    assert column(spark, ["a\\b\\c-d_12.pdf", "x/y.pdf"], T.title_from_path("x")) == ["c d", "y"]
    assert column(spark, ["x" * 10, "ab  cdef"], T.snippet("x", 4)) == ["xxxx...", "ab..."]
    assert column(spark, [5.0, 125.0, None], T.seconds_text("x"), "double") == ["5.0s", "2m 05s", "n/a"]
    assert column(spark, [10, 2048, None], T.bytes_text("x"), "long") == ["10 B", "2.0 KB", "n/a"]


PAIRS = [("deep learning for images", "Deep Learning for Images!", 1.0), ("attention is all you need in practice", "attention is all you need", 0.95), ("deep learning for image recognition", "deep learning", None), ("attention is all you need", "not all attention is all you need", 0.81), ("x", None, 0.0), (None, "x", 0.0), ("", "", 0.0), ("tide", "diet", None), ("diet", "tide", None)]


def test_title_similarity(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(PAIRS)], "i int, a string, b string")
    got = [r.y for r in df.select("i", identity.title_similarity("a", "b").alias("y")).orderBy("i").collect()]
    for (a, b, expected), y in zip(PAIRS, got):
        assert y == pytest.approx(difflib.SequenceMatcher(None, a, b).ratio() if expected is None else expected)


def test_identity_score(spark):
    rows = [(0, None, "10.1/a", False, 0.9, 0.9), (1, " 10.1/A", "10.1/a ", False, None, 1.0), (2, "10.1/a", "10.1/b", False, 0.99, 0.0), (3, "10.1/a", None, True, 0.1, 0.9), (4, "10.1/a", "10.1/b", True, 0.85, 0.85), (5, "10.1/a", "10.1/b", True, None, 0.0)]
    df = spark.createDataFrame(rows, "i int, asked string, doi string, keyed boolean, s double, e double")
    got = df.select(identity.identity_score("asked", "doi", "keyed", "s").alias("y"), "e").collect()
    assert all(r.y == r.e for r in got)


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([], []), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(cosine("a", "b")).collect()] == [1.0, 0.0, 0.0, 0.0, 0.0]
    assert df.select(dot("a", "b")).first()[0] == 1.0


def test_products_in_blocks(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(60)] + [(99, None), (98, [])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    asked = df.where("id % 10 = 0")
    one = {(r.query_id, r.ident): r.score for r in products(df, "id", "v", asked, "id", "v").collect()}
    two = {(r.query_id, r.ident): r.score for r in products(df, "id", "v", asked, "id", "v", block=4).collect()}
    assert one.keys() == two.keys() and len(one) == 6 * 60 and all(abs(one[k] - two[k]) < 1e-12 for k in one)
    kept = products(df, "id", "v", asked, "id", "v", keep=3).collect()
    for q in range(0, 60, 10):
        best = sorted(((-s, i) for (a, i), s in one.items() if a == q))[:3]
        assert {i for _, i in best} <= {r.ident for r in kept if r.query_id == q}
    assert products(df.limit(0), "id", "v", asked, "id", "v").count() == 0
    assert products(df, "id", "v", df.limit(0), "id", "v").count() == 0


def test_plain_letters_follow_unicode():
    source, target, longer = T._plain_letters()
    for c, p in [*zip(source, target), *longer]:
        assert "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)) == p
