"""Records whose titles differ only in layout: one record for each title, with the number of its copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.plans.sizing import shuffle_partitions

#: The signs that divide the segments of a title, each between spaces.
DIVIDER = r"[\s\p{Z}][|/·][\s\p{Z}]"


def canonical_title(title: Column) -> Column:
    """Segments in sorted order, each reduced to its letters and digits without case; null where no letter or digit is left."""
    bare = F.transform(F.split(title, DIVIDER), lambda s: F.regexp_replace(F.lower(s), r"[^\p{L}\p{N}]+", ""))
    return F.nullif(F.array_join(F.array_sort(F.filter(bare, lambda s: s != "")), "|"), F.lit(""))


def keyed(df: DataFrame, ident: str, title: str) -> DataFrame:
    """``ident, key``: the 128-bit digest of the canonical title, so that the shuffles carry 16 bytes a key, not whole titles."""
    return df.select(F.col(ident).alias("ident"), F.unhex(F.md5(canonical_title(F.col(title)))).alias("key")).where("key IS NOT NULL")


def hot_keys(keys: DataFrame, share: float = 0.25) -> DataFrame:
    """``key, copies`` of each key with more rows than ``share`` of an even shuffle partition.

    Counts are exact over all rows (partial counts before the shuffle). At most ``partitions / share`` keys can be that frequent,
    whatever the input holds; that bound makes the result safe to broadcast.
    """
    counts = keys.groupBy("key").agg(F.count("*").alias("copies"))
    total = keys.agg((F.count("*") * share / shuffle_partitions(keys.sparkSession)).alias("limit"))
    return counts.join(F.broadcast(total), F.col("copies") > F.greatest(F.col("limit"), F.lit(1))).select("key", "copies")


def grouped(df: DataFrame, ident: str, title: str, salts: int | None = None) -> DataFrame:
    """``ident, keep_id, copies`` of every record with a title that has a letter or digit.

    Hot keys are found exactly and aggregated in two levels, by key and salt and then by key; their result has one row a hot key, so it is
    joined back by broadcast and the hot rows themselves are never shuffled by key. All other rows take one shuffle by key. The
    representative is the smallest identifier. Null titles, titles without letters or digits and null identifiers never count;
    repeated rows with one identifier count as one copy each; an empty table gives no rows; other columns are ignored.
    """
    keys = keyed(df, ident, title).where("ident IS NOT NULL")
    salts = salts or shuffle_partitions(df.sparkSession)
    hot = F.broadcast(hot_keys(keys).select("key"))
    in_hot = keys.join(hot, "key", "left_semi")
    salted = in_hot.groupBy("key", F.pmod(F.xxhash64("ident"), F.lit(salts)).alias("salt")).agg(F.min("ident").alias("low"), F.count("*").alias("n"))
    best = salted.groupBy("key").agg(F.min("low").alias("keep_id"), F.sum("n").alias("copies"))
    hot_rows = in_hot.join(F.broadcast(best), "key").select("ident", "keep_id", "copies")
    rest = keys.join(hot, "key", "left_anti").withColumns({"keep_id": F.expr("min(ident) OVER (PARTITION BY key)"), "copies": F.expr("count(*) OVER (PARTITION BY key)")})
    return hot_rows.unionByName(rest.select("ident", "keep_id", "copies"))


def collapse(df: DataFrame, ident: str, title: str) -> DataFrame:
    """``keep_id, copies``: one record for each distinct title."""
    return grouped(df, ident, title).where("ident = keep_id").select("keep_id", "copies").distinct()


def copies_of(df: DataFrame, ident: str, title: str) -> DataFrame:
    """``keep_id, copy_id``: every record that is not itself its group's representative."""
    return grouped(df, ident, title).where("ident > keep_id").select("keep_id", F.col("ident").alias("copy_id")).distinct()
