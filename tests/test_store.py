import pytest
from pyspark.sql import functions as F

from plumbline.operators import records, store
from plumbline.sources.live import PageSource


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def render(path):
    for page in (1, 2, 3):
        yield page, 600, 800, [(0, 0, 10, 10, f" {path} {page} "), (0, 20, 10, 30, "  ")]


def test_store(spark, tmp_path):
    path = str(tmp_path / "store")
    points = spark.createDataFrame([("a", 1, "m", [1.0, 2.0]), ("a", 2, "m", [1.0]), ("a", 1, "n", [1.0])], "pdf_sha string, page_no int, model string, vec array<float>")
    points = points.withColumn("point_id", store.point_id("6ba7b811-9dad-11d1-80b4-00c04fd430c8", F.col("pdf_sha"), F.col("page_no"), F.col("model")))
    store.create(points, path)
    store.create(points, path)
    schema = "pdf_sha string, page_no int, vec array<float>, point_id string, model string"
    assert store.read(spark, path, schema).count() == 0
    points.write.mode("append").partitionBy("model").parquet(path)
    held = store.read(spark, path, schema)
    assert rows(store.indexed_pages(held, "a", "m")) == [(1,), (2,)] and store.indexed_pages(held, "b", "m").count() == 0
    pages = spark.createDataFrame([("a", 1, "m"), ("a", 3, "m"), ("b", 1, "m")], "pdf_sha string, page_no int, model string")
    assert rows(store.to_index(pages, held).select("pdf_sha", "page_no")) == [("a", 3), ("b", 1)]
    again = points.where("page_no = 2").withColumn("vec", F.array(F.lit(9.0)).cast("array<float>"))
    assert rows(store.replaced(held, again.select(*held.columns)).select("page_no", "model", "vec")) == [(1, "m", [1.0, 2.0]), (1, "n", [1.0]), (2, "m", [9.0])]
    assert rows(store.stored_bytes(held, ["model"])) == [("m", 2, 12), ("n", 1, 4)]


def test_records(spark):
    df = spark.createDataFrame([(1, ["b1", None, "a1", "b2", "a2", "a3"]), (2, [])], "i int, urls array<string>")
    got = df.select("i", records.promoted_urls("urls", lambda u: u.startswith("a")).alias("u")).withColumn("alt", records.alternatives("u")).orderBy("i").collect()
    assert [(r.u, r.alt) for r in got] == [(["a1", "a2", "a3", "b1", "b2"], ["a2", "a3", "b1"]), ([], [])]
    e = records.envelope(spark.createDataFrame([(1, 2, "y"), (1, 1, "x")], "q int, n int, t string"), ["q"], "n", ["t"], "pages").first()
    assert e.json == '{"q":1,"pages":[{"t":"x"},{"t":"y"}]}'


@pytest.mark.parametrize("turn, expected", [(0, (10, 20, 30, 60)), (90, (740, 10, 780, 30)), (180, (570, 740, 590, 780)), (270, (20, 570, 60, 590)), (-90, (20, 570, 60, 590))])
def test_rotated(spark, turn, expected):
    box = [F.lit(float(v)) for v in (10, 20, 30, 60)]
    r = spark.range(1).select(records.rotated(*box, F.lit(turn), F.lit(600.0), F.lit(800.0)).alias("b")).first().b
    assert tuple(r) == expected


def test_page_source(spark):
    spark.dataSource.register(PageSource)
    got = spark.read.format("pages").option("paths", "x.pdf,y.pdf").option("renderer", "tests.test_store:render").option("maxPages", 2).load()
    assert rows(got.select("path", "page_no", "text")) == [("x.pdf", 1, "x.pdf 1"), ("x.pdf", 2, "x.pdf 2"), ("y.pdf", 1, "y.pdf 1"), ("y.pdf", 2, "y.pdf 2")]
