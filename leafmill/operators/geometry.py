"""Rectangles: predicates as columns, exclusions as anti joins of what the spatial join finds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.arrays import alike, runs
from leafmill.operators import spatial
from leafmill.operators.spatial import CORNERS
from leafmill.runtime import cut

# Fixed values.
FULL_WIDTH, STAMP_IOU, SKEW, ROW_TOLERANCE = 0.8, 0.8, 0.01, 0.5
Box = tuple[Column, Column, Column, Column]


def box(frame: DataFrame, names: tuple[str, str, str, str] = CORNERS) -> Box:
    return tuple(frame[n] for n in names)


def overlaps(a: Box, b: Box) -> Column:
    """Whether two rectangles share area; touching edges do not count."""
    return (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])


def iou(a: Box, b: Box) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    both = F.when((w > 0) & (h > 0), w * h).otherwise(0.0)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def _without(rows: DataFrame, boxes: DataFrame, condition) -> DataFrame:
    """The rows for which no box of their page meets the condition, which holds only of rectangles that share a point."""
    key = [*spatial.KEY, *CORNERS]
    pages = spatial.crowded(rows, boxes)
    if pages is None:
        other = boxes.select(*[F.col(k).alias(f"_{k}") for k in key])
        hit = (F.col("doc_id") == F.col("_doc_id")) & (F.col("page") == F.col("_page")) & condition(box(rows), box(other, tuple(f"_{c}" for c in CORNERS)))
        return rows.join(other, hit, "left_anti")
    pairs = spatial.touching(rows.select(*key), boxes.select(*key), "_", pages)
    hit = pairs.where(condition(box(pairs), box(pairs, tuple(f"_{c}" for c in CORNERS)))).select(*key).distinct()
    return rows.join(hit, key, "left_anti").select(*rows.columns)


def exclude_regions(words: DataFrame, regions: DataFrame) -> DataFrame:
    """Words that overlap no region of their page."""
    return _without(words, regions, overlaps)


def drop_stamped(words: DataFrame, stamps: DataFrame) -> DataFrame:
    """Words that are not one of their page's stamps."""
    return _without(words, stamps, lambda a, b: iou(a, b) >= STAMP_IOU)


def centres(rows: DataFrame) -> DataFrame:
    """The rows with their rectangles shrunk to the centres."""
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    return rows.withColumns({"x0": x, "y0": y, "x1": x, "y1": y})


def drop_inside(chars: DataFrame, boxes: DataFrame) -> DataFrame:
    """Characters whose centre lies in none of their page's boxes, edges included."""
    key = [*spatial.KEY, *CORNERS]
    whole = chars.select(*key, *[F.col(c).alias(f"c_{c}") for c in CORNERS])
    hit = spatial.touching(centres(whole), boxes.where("x0 <= x1 and y0 <= y1").select(*key)).select(*spatial.KEY, *[F.col(f"c_{c}").alias(c) for c in CORNERS]).distinct()
    return chars.join(hit, key, "left_anti").select(*chars.columns)


def to_word_space(regions: DataFrame) -> DataFrame:
    """Regions (with origin_x, origin_y, rotation and the page's width and height) in the words' unrotated space."""
    x0, x1 = F.col("x0") - F.col("origin_x"), F.col("x1") - F.col("origin_x")
    y0, y1 = F.col("y0") - F.col("origin_y"), F.col("y1") - F.col("origin_y")
    turn, w, h = F.pmod(F.col("rotation"), F.lit(360)), F.col("width"), F.col("height")
    # The derotation of a page turned by 90, 180 or 270 degrees; width and height are those of the turned page.
    px = lambda x, y: F.when(turn == 90, y).when(turn == 180, w - x).when(turn == 270, h - y).otherwise(x)
    py = lambda x, y: F.when(turn == 90, w - x).when(turn == 180, h - y).when(turn == 270, x).otherwise(y)
    ax, bx, ay, by = px(x0, y0), px(x1, y1), py(x0, y0), py(x1, y1)
    return regions.withColumns({"x0": F.least(ax, bx), "x1": F.greatest(ax, bx), "y0": F.least(ay, by), "y1": F.greatest(ay, by)})


def blocks_of(words: DataFrame) -> DataFrame:
    """The hull and text of each block: lines by line_no, words from left to right."""
    ordered = F.array_sort(F.collect_list(F.struct("x0", "word_no", F.col("text").alias("t"))))
    lines = words.groupBy("doc_id", "page", "block_no", "line_no").agg(
        F.array_join(F.transform(ordered, lambda s: s["t"]), " ").alias("line"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")
    )
    return lines.groupBy("doc_id", "page", "block_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]), "\n").alias("text"),
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
    )


def blocks_in(words: Column) -> Column:
    """The same for a page's words as an array of structs: an array of block_no, text and hull, by block_no."""
    names = ("block_no", "line_no", "x0", "word_no", "text", "y0", "x1", "y1")
    placed = F.sort_array(F.transform(words, lambda w: F.struct(*[w[n].alias(n) for n in names])))
    each = lambda own, name: F.transform(own, lambda x: x[name])
    hull = lambda own: [f(each(own, c)).alias(c) for f, c in zip((F.array_min, F.array_min, F.array_max, F.array_max), CORNERS)]
    lines = F.transform(runs(placed, alike("block_no", "line_no")), lambda own: F.struct(F.get(own, F.lit(0))["block_no"].alias("block_no"), F.array_join(each(own, "text"), " ").alias("line"), *hull(own)))
    return F.transform(runs(lines, alike("block_no")), lambda own: F.struct(F.get(own, F.lit(0))["block_no"].alias("block_no"), F.array_join(each(own, "line"), "\n").alias("text"), *hull(own)))


def full_width(blocks: DataFrame) -> DataFrame:
    """Adds ``banner``: the block spans most of the width that the page's blocks take."""
    page = Window.partitionBy("doc_id", "page")
    span = F.max("x1").over(page) - F.min("x0").over(page)
    return blocks.withColumn("banner", F.when(span > 0, (F.col("x1") - F.col("x0")) / span >= FULL_WIDTH).otherwise(False))


def bands(blocks: DataFrame) -> DataFrame:
    """Adds ``band``: how many banners begin at or above the block, by y0 - an as-of assignment without a join."""
    upto = Window.partitionBy("doc_id", "page").orderBy("y0").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return blocks.withColumn("band", F.sum(F.col("banner").cast("int")).over(upto))


def columns_concurrent(columns: DataFrame) -> DataFrame:
    """(doc_id, page, concurrent): whether neighbouring columns, by their y-spans, run side by side."""
    order = Window.partitionBy("doc_id", "page").orderBy("y_min", "y_max")
    marked = columns.withColumn("meets", F.lead("y_min").over(order) < F.col("y_max"))
    return marked.groupBy("doc_id", "page").agg(F.coalesce(F.bool_or("meets"), F.lit(False)).alias("concurrent"))


def row_order(boxes: DataFrame) -> DataFrame:
    """Adds ``row_no`` and ``ord``: boxes by centre, a row going on while the step stays within half the lower height."""
    page = Window.partitionBy("doc_id", "page").orderBy("cy", "box_no")
    sized = boxes.withColumns({"cy": (F.col("y0") + F.col("y1")) / 2, "h": F.col("y1") - F.col("y0")})
    step = F.col("cy") - F.lag("cy").over(page)
    fresh = F.when(step.isNull() | (step > ROW_TOLERANCE * F.least(F.col("h"), F.lag("h").over(page))), 1).otherwise(0)
    rows = sized.withColumn("fresh", fresh).withColumn("row_no", F.sum("fresh").over(page))
    return rows.withColumn("ord", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("row_no", "x0", "box_no"))).drop("cy", "h", "fresh")


def is_skewed(dx: Column, dy: Column) -> Column:
    return (F.abs(dx) >= SKEW) & (F.abs(dy) >= SKEW)


def is_vertical(a: Column, b: Column) -> Column:
    return (F.abs(a) < SKEW) & (F.abs(b) >= SKEW)


def chars_to_words(chars: DataFrame) -> DataFrame:
    """Words of a line's characters (by seq): runs between blanks, with their hulls."""
    line = Window.partitionBy("doc_id", "page", "line_no").orderBy("seq")
    blank = F.trim("text") == ""
    runs = chars.withColumn("run", F.sum(blank.cast("int")).over(line)).where(~blank)
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.col("text").alias("t")))), lambda s: s["t"]), "")
    return runs.groupBy("doc_id", "page", "line_no", "run").agg(letters.alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


# What tells a drawn figure from a text box.
LEAST_SIDE, MOST_OF_PAGE, LEAST_PATHS, MOST_CHARS = 60, 0.85, 15, 2.0


def vector_figures(clusters: DataFrame, drawings: DataFrame, words: DataFrame, pages: DataFrame, taken: DataFrame) -> DataFrame:
    """The clusters of paths (doc_id, page, cluster_no, corners) that are figures: adds paths and chars.

    Large enough but not the page itself, clear of the raster figures in ``taken``, drawn with
    many paths, and with at most two characters per 1000 square points. ``pages`` has width and
    height; characters are those of overlapping words with one separator between two.
    """
    key = ["doc_id", "page", "cluster_no"]
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    sized = clusters.where((F.col("x1") - F.col("x0") >= LEAST_SIDE) & (F.col("y1") - F.col("y0") >= LEAST_SIDE)).join(pages.select("doc_id", "page", (F.col("width") * F.col("height")).alias("page_area")), ["doc_id", "page"])
    sized = sized.where((F.col("page_area") <= 0) | (area < MOST_OF_PAGE * F.col("page_area"))).drop("page_area")
    # The clusters left are few and used more than once.
    free = cut(_without(sized, taken, overlaps))
    inner = free.select(*key, *CORNERS)

    def within(rows: DataFrame) -> DataFrame:
        return spatial.touching(rows, inner, "c_").where(overlaps(tuple(F.col(c) for c in CORNERS), tuple(F.col(f"c_{c}") for c in CORNERS))).withColumnRenamed("c_cluster_no", "cluster_no")

    paths = within(drawings.select("doc_id", "page", *CORNERS)).groupBy(*key).agg(F.count("*").alias("paths")).where(F.col("paths") >= LEAST_PATHS)
    chars = within(words.select("doc_id", "page", "text", *CORNERS)).groupBy(*key).agg((F.sum(F.length("text")) + F.count("*") - 1).alias("chars"))
    found = free.join(paths, key).join(chars, key, "left").na.fill(0, ["chars"])
    return found.where(F.col("chars") / (area / 1000.0) <= MOST_CHARS)
