"""Overlapping chunks of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a chunk and words that neighbours share.
SIZE, OVERLAP = 512, 100


def chunk_documents(docs: DataFrame, ident: str, text: str, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """``ident, chunk_no, n_words, text`` of chunks of ``size`` words that begin every ``size - overlap`` words; the last one may be shorter."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    rows = docs.select(F.col(ident).alias("ident"), words.alias("_w")).where("size(_w) > 0")
    last = F.greatest(F.lit(0), F.ceil((F.size("_w") - overlap) / F.lit(float(size - overlap))).cast("int") - 1)
    rows = rows.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
    piece = F.slice("_w", F.col("chunk_no") * (size - overlap) + 1, F.lit(size))
    return rows.select("ident", "chunk_no", F.size(piece).alias("n_words"), F.array_join(piece, " ").alias("text"))
