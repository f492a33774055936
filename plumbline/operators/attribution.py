"""Late-interaction page scores and their attribution to regions of a page grid."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.plans.shipping import ship

#: Standard deviations above the mean that make a cell hot, reach of the blur, characters of a snippet, share of the span that makes a line wide.
HOT_SIGMA, BLUR, SNIPPET, WIDE = 0.5, 1, 300, 0.7


def token_maxima(patches: DataFrame, tokens: DataFrame, block: int = 4096) -> DataFrame:
    """``page_id, tok, best, patch_idx``: for each page and query token the largest product and the first patch that has it.

    The tokens go out in blocks of at most ``block``, each a broadcast matrix and one pass over the patches; products are dense blocks over Arrow batches, reduced to one row for each
    page and token within a batch, so the shuffle by page carries maxima, not products.
    """
    ship(patches.sparkSession)
    schema = "page_id long, tok int, best double, patch_idx int"
    rows: list = []
    part = patches.sparkSession.createDataFrame([], schema)
    for row in tokens.select("tok", "vec").where("size(vec) > 0").orderBy("tok").toLocalIterator():
        rows.append(row)
        if len(rows) == block:
            part, rows = part.unionByName(_block_maxima(patches, rows, schema)), []
    if rows:
        part = part.unionByName(_block_maxima(patches, rows, schema))
    top = F.max(F.struct("best", (-F.col("patch_idx")).alias("first"))).alias("top")
    return part.groupBy("page_id", "tok").agg(top).select("page_id", "tok", F.col("top.best").alias("best"), (-F.col("top.first")).alias("patch_idx"))


def _block_maxima(patches: DataFrame, rows: list, schema: str) -> DataFrame:
    """Maxima of one block of tokens within each Arrow batch."""
    numbers, matrix = np.array([r.tok for r in rows], np.int32), np.array([list(r.vec) for r in rows], np.float64)
    shared = patches.sparkSession.sparkContext.broadcast((numbers, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toks, asked = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            products = vectors @ asked.T
            frame = pd.DataFrame(products, columns=range(len(toks)))
            frame["page_id"], frame["patch_idx"] = batch.column("page_id").to_numpy(), batch.column("patch_idx").to_numpy()
            frame = frame.sort_values(["page_id", "patch_idx"], kind="stable").reset_index(drop=True)
            where = frame.groupby("page_id")[list(range(len(toks)))].idxmax()
            index = where.to_numpy()
            values = frame[list(range(len(toks)))].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(where.index.to_numpy(), len(toks))), pa.array(np.tile(toks, len(where))),
                    pa.array(np.take_along_axis(values, index, 0).ravel()), pa.array(frame["patch_idx"].to_numpy()[index].ravel().astype(np.int32)),
                ],
                names=["page_id", "tok", "best", "patch_idx"],
            )

    return patches.select("page_id", "patch_idx", "vec").where("size(vec) > 0").mapInArrow(run, schema)


def page_scores(maxima: DataFrame) -> DataFrame:
    """``page_id, score``: the sum of a page's token maxima."""
    return maxima.groupBy("page_id").agg(F.sum("best").alias("score"))


def top_pages(scores: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best pages; equal scores in order of the page."""
    return scores.orderBy(F.desc("score"), F.asc("page_id")).limit(k)


def heat(maxima: DataFrame, cells: DataFrame, grids: DataFrame) -> DataFrame:
    """``page_id, cell, v`` for every cell of each page: the positive contributions of the tokens that won there.

    Winners outside the image have no cell and are dropped; pages without any positive contribution give no rows.
    """
    hit = maxima.where("best > 0").join(cells, ["page_id", "patch_idx"]).groupBy("page_id", "cell").agg(F.sum("best").alias("v"))
    grid = grids.where("grid_ok AND grid_rows > 0 AND grid_cols > 0").join(hit.select("page_id").distinct(), "page_id", "left_semi")
    every = grid.select("page_id", F.explode(F.sequence(F.lit(0), F.col("grid_rows") * F.col("grid_cols") - 1)).alias("cell"))
    return every.join(hit, ["page_id", "cell"], "left").select("page_id", "cell", F.coalesce("v", F.lit(0.0)).alias("v"))


def blurred(heat_map: DataFrame, grids: DataFrame) -> DataFrame:
    """Mean over the neighbours within the grid: each cell gives its value to its neighbours, so no cell is joined with all others."""
    step = range(-BLUR, BLUR + 1)
    shifts = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a in step for b in step])
    spread = heat_map.join(grids.select("page_id", "grid_rows", "grid_cols"), "page_id").withColumn("s", F.explode(shifts))
    row = F.floor(F.col("cell") / F.col("grid_cols")) + F.col("s.dr")
    column = F.col("cell") % F.col("grid_cols") + F.col("s.dc")
    inside = (row >= 0) & (row < F.col("grid_rows")) & (column >= 0) & (column < F.col("grid_cols"))
    moved = spread.where(inside).select("page_id", (row * F.col("grid_cols") + column).cast("int").alias("cell"), "v")
    return moved.groupBy("page_id", "cell").agg((F.sum("v") / F.count("*")).alias("v"))


def hot_cells(smooth: DataFrame) -> DataFrame:
    """Adds ``hot``: at least the population mean plus half a standard deviation, and positive; else the first largest cell alone."""
    page = Window.partitionBy("page_id")
    rows = smooth.withColumn("_hot", (F.col("v") >= F.avg("v").over(page) + HOT_SIGMA * F.stddev_pop("v").over(page)) & (F.col("v") > 0))
    rows = rows.withColumn("_any", F.max("_hot").over(page)).withColumn("_first", F.row_number().over(page.orderBy(F.desc("v"), F.asc("cell"))) == 1)
    return rows.withColumn("hot", F.when(F.col("_any"), F.col("_hot")).otherwise(F.col("_first") & (F.col("v") > 0))).drop("_hot", "_any", "_first")


def components(hot: DataFrame, grids: DataFrame) -> DataFrame:
    """``page_id, cell, component``: hot cells joined by their sides, named by the smallest cell; a page's grid is small, so each page is one task item."""

    def label(page: pd.DataFrame) -> pd.DataFrame:
        cols = int(page["grid_cols"].iloc[0])
        left, names = set(page["cell"]), {}
        for seed in sorted(left):
            if seed in names:
                continue
            names[seed], todo = seed, [seed]
            while todo:
                c = todo.pop()
                near = [c - cols, c + cols] + ([c - 1] if c % cols else []) + ([c + 1] if (c + 1) % cols else [])
                for n in near:
                    if n in left and n not in names:
                        names[n] = seed
                        todo.append(n)
        return pd.DataFrame({"page_id": page["page_id"], "cell": page["cell"], "component": [names[c] for c in page["cell"]]})

    rows = hot.where("hot").join(grids.select("page_id", "grid_cols"), "page_id").select("page_id", "cell", "grid_cols")
    return rows.groupBy("page_id").applyInPandas(label, "page_id long, cell int, component int")


def regions(labelled: DataFrame, heat_map: DataFrame, scores: DataFrame, grids: DataFrame, top: int | None = None) -> DataFrame:
    """Box in points, share of the page's score, and size of each component, heaviest first; weights come from the heat before blurring."""
    rows = labelled.join(heat_map, ["page_id", "cell"]).join(grids, "page_id").where("width_pt > 0 AND height_pt > 0")
    r, c = F.floor(F.col("cell") / F.col("grid_cols")), F.col("cell") % F.col("grid_cols")
    high, wide = F.col("height_pt") / F.col("grid_rows"), F.col("width_pt") / F.col("grid_cols")
    boxes = rows.groupBy("page_id", "component").agg(
        F.min(c * wide).alias("x0"), F.min(r * high).alias("y0"), F.max((c + 1) * wide).alias("x1"), F.max((r + 1) * high).alias("y1"), F.sum("v").alias("weight"), F.count("*").alias("cells")
    )
    out = boxes.join(scores, "page_id").where("score > 0").withColumn("share", F.col("weight") / F.col("score"))
    place = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("weight"), F.asc("component")))
    out = out.withColumn("region_no", place)
    return out.where(F.col("region_no") <= top) if top else out
