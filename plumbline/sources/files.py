"""Text lists, JSON-lines logs, frozen pools and binary files as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions.text import BARE_DOI, base_name, host
from plumbline.schemas import MANIFEST, POOL


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("value"))


def allowlist(spark: SparkSession, path: str, inline_comments: bool = True) -> DataFrame:
    """``host`` of each line; whole-line comments are skipped, those after an entry only where ``inline_comments``."""
    return hosts_of(_lines(spark, path), inline_comments)


def hosts_of(lines: DataFrame, inline_comments: bool = True) -> DataFrame:
    text = F.trim(F.substring_index("value", "#", 1)) if inline_comments else F.trim("value")
    rows = lines.where(~F.startswith(F.trim("value"), F.lit("#"))).select(host(text).alias("host"))
    return rows.where("host IS NOT NULL").distinct()


def citations_of(lines: DataFrame) -> DataFrame:
    """``title, doi`` of lines such as ``Title``, ``doi:10...``, ``10.1234/x`` or ``Title | doi``; blank lines and comments are skipped."""
    line = F.trim("value")
    rows = lines.where((line != "") & ~F.startswith(line, F.lit("#"))).withColumn("_l", line)
    bar = F.instr("_l", "|")
    split_title, split_doi = F.trim(F.substring_index("_l", "|", 1)), F.trim(F.expr("substring(_l, instr(_l, '|') + 1)"))
    prefixed, bare = F.lower("_l").startswith("doi:"), F.col("_l").rlike(BARE_DOI)

    def tidy(c: Column) -> Column:
        return F.nullif(F.trim(F.regexp_replace(c, "(?i)^doi:", "")), F.lit(""))

    title = F.when(bar > 0, F.nullif(split_title, F.lit(""))).when(~prefixed & ~bare, F.col("_l"))
    doi = F.when(bar > 0, tidy(split_doi)).when(prefixed | bare, tidy(F.col("_l")))
    return rows.select(title.alias("title"), doi.alias("doi")).where("title IS NOT NULL OR doi IS NOT NULL")


def citations(spark: SparkSession, path: str) -> DataFrame:
    return citations_of(_lines(spark, path))


def descriptions(spark: SparkSession, path: str) -> DataFrame:
    """``description`` of each line that is neither blank nor a comment."""
    return _lines(spark, path).where("value <> '' AND NOT startswith(value, '#')").select(F.col("value").alias("description"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON-lines file with ``line_no`` in file order; lines that can't be read go to ``_corrupt`` and keep their place."""
    bad = "_corrupt"
    rows = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id())
    parsed = F.from_json("value", StructType.fromDDL(schema).add(bad, "string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    return rows.where("trim(value) <> ''").withColumn("_r", parsed).select("line_no", "_r.*")


def manifest(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """The log of outcomes of either tool; unreadable lines are skipped; with ``files`` (``path``) only records of files that exist."""
    rows = json_lines(spark, path, MANIFEST).where("_corrupt IS NULL").drop("_corrupt")
    if files is None:
        return rows
    there = files.select(base_name("path").alias("_name")).distinct()
    return rows.withColumn("_name", base_name("path")).join(there, "_name", "left_semi").drop("_name")


def pools(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Frozen pools, and the numbers of the lines that can't be read."""
    rows = json_lines(spark, path, POOL)
    return rows.where("_corrupt IS NULL").drop("_corrupt"), rows.where("_corrupt IS NOT NULL").select("line_no")


def pool_papers(pool: DataFrame) -> DataFrame:
    """The papers of frozen pools, without scores; missing lists are empty, ``title_only`` follows the trimmed abstract."""
    rows = pool.select("line_no", "description", F.posexplode("papers").alias("pool_ordinal", "_p")).select("line_no", "description", "pool_ordinal", "_p.*")
    empty = F.array().cast("array<string>")
    return rows.withColumns({"pdf_urls": F.coalesce("pdf_urls", empty), "retrieval_sources": F.coalesce("retrieval_sources", empty), "title_only": F.coalesce(F.trim("abstract"), F.lit("")) == ""})


def pdf_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, sha256, is_pdf, length`` of PDF files below the paths, each once; a file counts as PDF by its first bytes and size."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(list(paths))
    return rows.select("path", F.sha2("content", 256).alias("sha256"), is_pdf(F.col("content"), F.col("length")).alias("is_pdf"), "length").distinct()


def is_pdf(content: Column, length: Column, least: int = 1024) -> Column:
    """Guard of a download: begins as a PDF and is not merely an error page."""
    return (F.substring(content, 1, 5) == F.expr("X'255044462D'")) & (length >= least)


def download_outcome(url: Column, landed: Column, status: Column, content: Column, allowed, least: int = 1024) -> Column:
    """What a download comes to: null where the file can be kept, else the reason: an answer of 400 or more, an end outside the allowed hosts, no PDF, or merely an error page."""
    size = F.length(content)
    return (
        F.when(~F.coalesce(allowed(F.coalesce(landed, url)), F.lit(False)), F.concat(F.lit("redirected off-allowlist to "), F.coalesce(host(F.coalesce(landed, url)), F.lit(""))))
        .when(F.coalesce(status, F.lit(0)) >= 400, F.concat(F.lit("status "), status.cast("string"))).when(content.isNull() | (F.coalesce(F.substring(content, 1, 5) != F.expr("X'255044462D'"), F.lit(True))), "response is not a PDF")
        .when(size < least, F.concat(F.lit("file too small ("), size.cast("string"), F.lit(" bytes)")))
    )


def store_files(kept: DataFrame, folder: str) -> DataFrame:
    """Write the files (``name, content``) that a download kept and return ``name, path``; each goes to a temporary name first and is renamed when whole, so a lost executor leaves no partial file under a final name.

    ``folder`` is one that all executors share.
    """

    def run(frames):
        import os
        import uuid

        for frame in frames:
            paths = []
            for name, content in zip(frame["name"], frame["content"]):
                os.makedirs(folder, exist_ok=True)
                path = os.path.join(folder, os.path.basename(name))
                part = f"{path}.{uuid.uuid4().hex}.part"
                with open(part, "wb") as f:
                    f.write(content)
                os.replace(part, path)
                paths.append(path)
            yield frame[["name"]].assign(path=paths)

    return kept.select("name", "content").mapInPandas(run, "name string, path string")


def missing_paths(spark: SparkSession, *paths: str) -> list[str]:
    """Those of the given paths that don't exist, sorted."""
    hadoop = spark._jsc.hadoopConfiguration()
    there = lambda p: (h := spark._jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(hadoop).exists(h)
    return sorted(p for p in set(paths) if not there(p))


def append_manifest(outcomes: DataFrame, path: str) -> None:
    """One JSON line for each outcome, added to the log."""
    outcomes.write.mode("append").json(path)


def dump_pools(papers: DataFrame, path: str) -> None:
    """The unscored pool of each description, one JSON line each."""
    fields = [c for c in papers.columns if c not in ("description", "pool_ordinal", "line_no")]
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pool_ordinal", F.struct(*fields).alias("p")))), lambda x: x["p"])
    papers.groupBy("description").agg(ordered.alias("papers")).write.mode("append").json(path)
