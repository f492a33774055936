"""Shells for live sources as Python data sources; the transport is passed in, so nothing here opens a connection by itself.

Untested against real services: there is no network where this is built. The tests drive them with a local transport.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Answers that are asked for again, attempts, and the longest pause in seconds.
RETRY, ATTEMPTS, LONGEST = frozenset({429, 500, 502, 503, 504}), 3, 30.0


def fetch(get: Callable[[str], tuple[int, dict, bytes]], url: str, sleep: Callable[[float], None] = time.sleep) -> tuple[int, dict, bytes]:
    """One address, asked again after growing pauses or the pause that the server names."""
    status, headers, body = 0, {}, b""
    for attempt in range(ATTEMPTS):
        try:
            status, headers, body = get(url)
        except OSError as e:
            status, headers, body = 0, {"error": str(e)}, b""
        if status and status not in RETRY:
            break
        if attempt + 1 < ATTEMPTS:
            named = str(headers.get("Retry-After", ""))
            sleep(min(LONGEST, float(named)) if named.replace(".", "", 1).isdigit() else 2.0**attempt)
    return status, headers, body


def fetched(urls: DataFrame, get: Callable[[str], tuple[int, dict, bytes]], pause: float = 0.0, max_hosts: int = 200) -> DataFrame:
    """``url, status, content_type, head, body`` of each address; one partition for each host, so that pacing is local to a task."""
    from plumbline.functions.text import host

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for url in frame["url"]:
                status, headers, body = fetch(get, url)
                out.append((url, status, headers.get("Content-Type"), body[:5], body))
                time.sleep(pause)
            yield pd.DataFrame(out, columns=["url", "status", "content_type", "head", "body"])

    return urls.select("url").withColumn("_h", host("url")).repartition(max_hosts, "_h").select("url").mapInPandas(run, "url string, status int, content_type string, head binary, body binary")


def is_fetchable(answers: DataFrame) -> DataFrame:
    """``url, ok``: an answer below 400 that is named a PDF or begins as one."""
    named = F.coalesce(F.lower("content_type").contains("pdf"), F.lit(False))
    begins = F.coalesce(F.col("head") == F.expr("X'255044462D'"), F.lit(False))
    return answers.select("url", ((F.col("status") > 0) & (F.col("status") < 400) & (named | begins)).alias("ok"))


def mark_verified(papers: DataFrame, probes: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``pdf_verified``: what the probe of a paper's target said; false without a target or a probe."""
    return papers.join(probes.select(F.col("url").alias(url), "ok"), url, "left").withColumn("pdf_verified", F.coalesce("ok", F.lit(False))).drop("ok")


class PageSource(DataSource):
    """``spark.read.format("pages")``: pages of documents as rows, from a function that yields (page_no, width, height, line boxes)."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "path string, page_no int, width_pt double, height_pt double, line_no int, x0 double, y0 double, x1 double, y1 double, text string"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self.options)


class _PageReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.options.get("paths", "").split(",") if p]

    def read(self, partition) -> Iterator[tuple]:
        import importlib

        module, _, name = self.options["renderer"].partition(":")
        most = int(self.options.get("maxPages", 0))
        for page_no, width, height, lines in getattr(importlib.import_module(module), name)(partition.value):
            if most and page_no > most:
                break
            for k, (x0, y0, x1, y1, text) in enumerate(lines):
                if text.strip():
                    yield partition.value, page_no, float(width), float(height), k, float(x0), float(y0), float(x1), float(y1), text.strip()
