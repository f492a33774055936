"""Text lines within page regions and their reading order; patch positions as a page-wide grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import snippet
from plumbline.operators.attribution import SNIPPET, WIDE

#: Fixed value: the marker before the run of a tile's patches.
TILE = r"^<row_([0-9]+)_col_([0-9]+)>$"


def overlap_area(a: list[Column], b: list[Column]) -> Column:
    """Area that two boxes (x0, y0, x1, y1) share."""
    return F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0])) * F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))


def _box(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}.{c}") for c in ("x0", "y0", "x1", "y1")]


def lines_in_regions(regions: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of the same page that touch a region: equality on the page, then interval tests."""
    a, b = _box("r"), _box("l")
    touches = (F.least(a[2], b[2]) > F.greatest(a[0], b[0])) & (F.least(a[3], b[3]) > F.greatest(a[1], b[1]))
    joined = regions.alias("r").join(lines.alias("l"), (F.col("r.page_id") == F.col("l.page_id")) & touches)
    return joined.select("r.page_id", "r.region_no", "l.line_no", *[F.col(f"l.{c}") for c in ("x0", "y0", "x1", "y1", "text")])


def words_in_regions(regions: DataFrame, words: DataFrame, least: float = 0.3) -> DataFrame:
    """Words of which at least the share ``least`` lies in a region."""
    a, b = _box("r"), _box("l")
    area = (b[2] - b[0]) * (b[3] - b[1])
    joined = regions.alias("r").join(words.alias("l"), (F.col("r.page_id") == F.col("l.page_id")) & (area > 0) & (overlap_area(a, b) / area >= least))
    return joined.select("r.page_id", "r.region_no", "l.line_no", *[F.col(f"l.{c}") for c in ("x0", "y0", "x1", "y1", "text")])


def reading_order(lines: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``column_no`` and ``reading_no``: wide lines first, then columns from left to right, each from top to bottom.

    A column begins where a line starts right of everything before it, a running maximum over lines sorted by their left edge.
    """
    page = Window.partitionBy(*by)
    span = F.max("x1").over(page) - F.min("x0").over(page)
    rows = lines.withColumn("_wide", (span > 0) & (F.col("x1") - F.col("x0") >= WIDE * span))
    side = Window.partitionBy(*by, "_wide").orderBy("x0", "line_no")
    before = F.max("x1").over(side.rowsBetween(Window.unboundedPreceding, -1))
    new = (~F.col("_wide")) & (before.isNull() | (F.col("x0") >= before))
    rows = rows.withColumn("_new", new.cast("int")).withColumn("column_no", F.when(F.col("_wide"), 0).otherwise(F.sum("_new").over(side)).cast("int"))
    order = page.orderBy("column_no", F.round("y0", 1), "x0", "line_no")
    return rows.withColumn("reading_no", F.row_number().over(order)).drop("_wide", "_new")


def snippets(ordered: DataFrame, by: list[str], limit: int = SNIPPET) -> DataFrame:
    """The lines of each region in reading order as one text of at most ``limit`` characters."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("reading_no", "text"))), lambda x: x["text"]), " ")
    return ordered.groupBy(*by).agg(snippet(text, limit).alias("snippet"))


def image_runs(tokens: DataFrame, is_image: Column) -> DataFrame:
    """Runs of consecutive image positions of a page (``page_id, start, length, marker``) with the token before each."""
    page = Window.partitionBy("page_id").orderBy("pos")
    marked = tokens.withColumn("_image", is_image).withColumn("_before", F.lag("token").over(page))
    image = marked.where("_image").withColumn("_run", F.col("pos") - F.row_number().over(page))
    return image.groupBy("page_id", "_run").agg(F.min("pos").alias("start"), F.count("*").alias("length"), F.min_by("_before", "pos").alias("marker")).drop("_run")


def any_layout(tiled: DataFrame, runs: DataFrame, expected: DataFrame) -> DataFrame:
    """``page_id, grid_rows, grid_cols, cell, patch_idx, grid_ok``: the grid of tiles where a page has one; else its image positions, in order, as the grid that was
    announced for the page (``expected``: ``page_id, rows, cols``) if their number agrees; else as a square if it is one; else the positions without a grid."""
    places = runs.select("page_id", F.explode(F.expr("sequence(start, start + length - 1)")).alias("patch_idx")).join(tiled.select("page_id").distinct(), "page_id", "left_anti")
    page = Window.partitionBy("page_id")
    flat = places.withColumn("cell", F.row_number().over(page.orderBy("patch_idx")) - 1).withColumn("_n", F.count("*").over(page)).join(expected, "page_id", "left")
    side = F.sqrt("_n").cast("int")
    fits, square = F.coalesce((F.col("rows") > 0) & (F.col("cols") > 0) & (F.col("rows") * F.col("cols") == F.col("_n")), F.lit(False)), side * side == F.col("_n")
    shape = lambda c: F.when(fits, F.col(c)).when(square, side).otherwise(F.coalesce(c, F.lit(0))).cast("int")
    flat = flat.select("page_id", shape("rows").alias("grid_rows"), shape("cols").alias("grid_cols"), "cell", F.col("patch_idx").cast("int").alias("patch_idx"), (fits | square).alias("grid_ok"))
    return tiled.withColumn("grid_ok", F.lit(True)).unionByName(flat)


def page_zoom(dpi: Column | int) -> Column:
    """Pixels a point: a page image of ``dpi`` has 72 points an inch."""
    return (dpi if isinstance(dpi, Column) else F.lit(dpi)) / F.lit(72.0)


def words_of_lines(lines: DataFrame) -> DataFrame:
    """The words of page lines, each with its share of the line's box by characters; ``word_no`` counts within the line."""
    n = F.length("text")
    each = lines.where(n > 0).withColumn("_w", F.explode(F.expr("filter(transform(split(text, ' '), (w, k) -> named_struct('k', k, 'w', w, 'at', length(array_join(slice(split(text, ' '), 1, k), ' ')) + if(k > 0, 1, 0))), x -> x.w <> '')")))
    left = F.col("x0") + (F.col("x1") - F.col("x0")) * F.col("_w.at") / n
    right = F.col("x0") + (F.col("x1") - F.col("x0")) * (F.col("_w.at") + F.length("_w.w")) / n
    return each.select("page_id", "line_no", F.col("_w.k").alias("word_no"), left.alias("x0"), "y0", right.alias("x1"), "y1", F.col("_w.w").alias("text"))


def tiled_layout(runs: DataFrame) -> DataFrame:
    """``page_id, grid_rows, grid_cols, cell, patch_idx``: tiles put together to one grid in row-major order.

    Only pages whose tiles have one square size and cover a full rectangle give rows; runs without a tile marker (the global view) have no place.
    """
    row, column = (F.regexp_extract(F.trim("marker"), TILE, k) for k in (1, 2))
    tiles = runs.where(F.trim("marker").rlike(TILE)).select("page_id", row.try_cast("int").alias("tr"), column.try_cast("int").alias("tc"), "start", "length")
    tiles = tiles.groupBy("page_id", "tr", "tc").agg(F.max(F.struct("start", "length")).alias("run")).select("page_id", "tr", "tc", "run.*")
    shape = tiles.groupBy("page_id").agg(F.min("length").alias("n"), F.max("length").alias("most"), F.max("tr").alias("rows"), F.max("tc").alias("cols"), F.count("*").alias("tiles"))
    side = F.sqrt("n").cast("int")
    good = shape.where("n = most AND tiles = rows * cols").withColumn("side", side).where("side * side = n")
    each = tiles.join(good, "page_id").withColumn("k", F.explode(F.expr("sequence(0, CAST(n AS INT) - 1)")))
    cell = ((F.col("tr") - 1) * F.col("side") + F.floor(F.col("k") / F.col("side"))) * F.col("cols") * F.col("side") + (F.col("tc") - 1) * F.col("side") + F.col("k") % F.col("side")
    return each.select("page_id", (F.col("rows") * F.col("side")).alias("grid_rows"), (F.col("cols") * F.col("side")).alias("grid_cols"), cell.cast("int").alias("cell"), (F.col("start") + F.col("k")).cast("int").alias("patch_idx"))
