"""Column-aware reading order. Clustering columns depends on the order of its input, so pages are walked one by one.

Pages are sorted into partitions and each partition is walked once; a worker holds one
page and one batch of results at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.operators import hulls, spatial
from leafmill.operators.spatial import CORNERS
from leafmill.runtime import ship_package

# Fixed values.
COLUMN_OVERLAP, BANNER_SHARE, PAGE_WIDTH = 0.40, 0.8, 612.0
#: So many pages of an Arrow batch are Python objects at once.
CHUNK = 256
ORDERED = "doc_id string, page int, block_no int, ord int, columns int, concurrent boolean"


def cluster_columns(boxes: list[tuple[float, float, float, float, int]]) -> list[list[tuple]]:
    """Columns of (x0, y0, x1, y1, key): each box joins the first column it shares enough width with."""
    spans: list[list[float]] = []
    members: list[list[tuple]] = []
    for item in sorted(boxes, key=lambda b: (b[0], b[1])):
        width = item[2] - item[0]
        for span, own in zip(spans, members):
            least = min(width, span[1] - span[0])
            if least > 0 and min(item[2], span[1]) - max(item[0], span[0]) > COLUMN_OVERLAP * least:
                span[0], span[1] = min(span[0], item[0]), max(span[1], item[2])
                own.append(item)
                break
        else:
            spans.append([item[0], item[2]])
            members.append([item])
    by_centre = sorted(members, key=lambda own: sum((b[0] + b[2]) / 2 for b in own) / len(own))
    return [sorted(own, key=lambda b: b[1]) for own in by_centre]


def run_side_by_side(columns: list[list[tuple]]) -> bool:
    extents = sorted((min(b[1] for b in own), max(b[3] for b in own)) for own in columns)
    return any(low < high for (_, high), (low, _) in zip(extents, extents[1:]))


def order_page(boxes: list[tuple[float, float, float, float, int]]) -> tuple[list[int], int, bool]:
    """Keys in reading order, the widest band's number of columns, whether any band's columns run side by side."""
    if not boxes:
        return [], 0, False
    span = max(b[2] for b in boxes) - min(b[0] for b in boxes)
    banners = sorted((b for b in boxes if span > 0 and (b[2] - b[0]) / span >= BANNER_SHARE), key=lambda b: b[1])
    body = [b for b in boxes if b not in banners]
    out, most, beside = [], 1, False
    edges = [float("-inf"), *(b[1] for b in banners), float("inf")]
    for i in range(len(banners) + 1):
        if i:
            out.append(banners[i - 1][4])
        own = [b for b in body if edges[i] <= b[1] < edges[i + 1]]
        columns = cluster_columns(own)
        most = max(most, len(columns))
        beside = beside or run_side_by_side(columns)
        out += [b[4] for column in columns for b in column]
    return out, most, beside


def by_page(rows: DataFrame, solve: Callable[[list[tuple]], list[tuple]], names: list[str], kinds: list[pa.DataType], schema: str, stream: bool = False) -> DataFrame:
    """``solve`` on the rows of every page, sorted by all columns, without doc_id and page; these lead its rows again. With ``stream`` it is given an iterator."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

        waiting: list[tuple] = []
        each = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for key, own in groupby(each, itemgetter(0, 1)):
            rest = (row[2:] for row in own)
            waiting += [(*key, *out) for out in solve(rest if stream else list(rest))]
            if len(waiting) >= 8192:
                yield batch_of(waiting)
                waiting = []
        if waiting:
            yield batch_of(waiting)

    return rows.repartition("doc_id", "page").sortWithinPartitions(*rows.columns).mapInArrow(run, schema)


def _typed(rows: DataFrame, *keys: str, extra: list[str] | None = None) -> DataFrame:
    """doc_id, page, the integer ``keys``, the corners and the numbers ``extra``; a row that lacks a corner has no place and goes."""
    whole = F.lit(True)
    for corner in CORNERS:
        whole = whole & F.col(corner).isNotNull()
    return rows.where(whole).select(F.col("doc_id").cast("string").alias("doc_id"), F.col("page").cast("int").alias("page"), *[F.col(k).cast("int").alias(k) for k in keys], *[F.col(c).cast("double").alias(c) for c in [*CORNERS, *(extra or [])]])


def reading_order(blocks: DataFrame) -> DataFrame:
    """doc_id, page, block_no, ord, columns, concurrent of blocks (doc_id, page, block_no, x0, y0, x1, y1)."""

    def page(rows: list[tuple]) -> list[tuple]:
        order, columns, beside = order_page([(*row[1:], row[0]) for row in rows])
        return [(key, i, columns, beside) for i, key in enumerate(order, 1)]

    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
    return by_page(_typed(blocks, "block_no"), page, ["doc_id", "page", "block_no", "ord", "columns", "concurrent"], kinds, ORDERED)


def _rows(column: pa.Array, at: int) -> list:
    """Some of the values at a time, so that a batch's are never all Python objects."""
    return column.slice(at, CHUNK).to_pylist()


def ordered_texts(pages: DataFrame) -> DataFrame:
    """Adds text, columns and concurrent to pages with ``blocks`` (an array of block_no, text and corners by block_no).

    Only the corners travel to Python, and only those of pages with two blocks or more;
    a lone block is its page. Blocks that lack a corner have no place, as elsewhere.
    """
    ship_package(pages.sparkSession)

    @F.arrow_udf("order array<int>, columns int, concurrent boolean")
    def walk(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
        out: list[dict | None] = []
        for at in range(0, len(x0), CHUNK):
            for corners in zip(*(_rows(c, at) for c in (x0, y0, x1, y1))):
                if corners[0] is None:
                    out.append(None)
                    continue
                order, columns, beside = order_page([(*box, k) for k, box in enumerate(zip(*corners)) if None not in box])
                out.append({"order": order, "columns": columns, "concurrent": beside})
        return pa.array(out, pa.struct([("order", pa.list_(pa.int32())), ("columns", pa.int32()), ("concurrent", pa.bool_())]))

    several = F.size("blocks") > 1
    found = pages.withColumn("_walk", walk.asNondeterministic()(*[F.when(several, F.transform("blocks", lambda b: b[c].cast("double"))) for c in CORNERS]))  # noqa: B023
    placed = lambda b: b["block_no"].isNotNull() & b["x0"].isNotNull() & b["y0"].isNotNull() & b["x1"].isNotNull() & b["y1"].isNotNull()
    in_order = F.when(F.col("_walk").isNotNull(), F.transform("_walk.order", lambda k: F.get("blocks", k))).otherwise(F.col("blocks"))
    text = F.array_join(F.transform(F.filter(in_order, placed), lambda b: b["text"]), "\n\n")
    return found.withColumns({"text": F.coalesce(text, F.lit("")), "columns": F.coalesce("_walk.columns", F.lit(1)), "concurrent": F.coalesce("_walk.concurrent", F.lit(False))}).drop("_walk")


def ocr_line_order(lines: DataFrame) -> DataFrame:
    """The same for OCR lines (doc_id, page, line_no, box, image_width): x is brought to a page's width first."""
    scaled = lines.where("image_width > 0").select("doc_id", "page", F.col("line_no").alias("block_no"), *[(F.col(c) * PAGE_WIDTH / F.col("image_width") if c[0] == "x" else F.col(c)).alias(c) for c in ("x0", "y0", "x1", "y1")])
    return reading_order(scaled)


def page_text(blocks: DataFrame, order: DataFrame) -> DataFrame:
    """(doc_id, page, text): block texts in reading order, a blank line between them."""
    joined = blocks.withColumn("doc_id", F.col("doc_id").cast("string")).join(order, ["doc_id", "page", "block_no"])
    parts = F.array_sort(F.collect_list(F.struct("ord", "text")))
    return joined.groupBy("doc_id", "page").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n\n").alias("text"))


def word_texts(words: DataFrame) -> DataFrame:
    """(doc_id, page, text) of words, as ``page_text`` has it of their ``geometry.blocks_of``: one shuffle and one sort, and no row is kept beside a page's own."""

    def page(rows: list[tuple]) -> list[tuple]:
        boxes, texts = [], {}
        for block, each in groupby(rows, itemgetter(0)):
            own = list(each)
            hull = [f((r[k] for r in own if r[k] is not None), default=None) for f, k in ((min, 2), (min, 5), (max, 6), (max, 7))]
            if None not in hull:
                boxes.append((*hull, block))
                texts[block] = "\n".join(" ".join(r[4] for r in line if r[4] is not None) for _, line in groupby(own, itemgetter(1)))
        said = [texts[block] for block in order_page(boxes)[0] if block is not None]
        return [("\n\n".join(said),)] if said else []

    corner = {c: F.col(c).cast("double").alias(c) for c in CORNERS}
    keys = {c: F.col(c).cast("int").alias(c) for c in ("page", "block_no", "line_no", "word_no")}
    rows = words.select(F.col("doc_id").cast("string").alias("doc_id"), keys["page"], keys["block_no"], keys["line_no"], corner["x0"], keys["word_no"], "text", corner["y0"], corner["x1"], corner["y1"])
    return by_page(rows.where("doc_id is not null and page is not null"), page, ["doc_id", "page", "text"], [pa.string(), pa.int32(), pa.string()], "doc_id string, page int, text string")


# How close parts of one formula lie, what a short line is, and fonts that set formulas.
FORMULA_GAP, SHORT_LINE, MATH_FONT = 6.0, 4, "symbol|math|euclid|mtextra|mt extra|times new roman,italic"


def formula_regions(lines: DataFrame) -> DataFrame:
    """(doc_id, page, region_no, corners): places of formulas, from block lines (doc_id, page, block_no, line_no, text, font, scripts, corners).

    A block counts if its lines are short by median, its fonts set formulas, or its text
    holds unexpected scripts; blocks that nearly touch are one region.
    """
    said = lines.where("trim(text) <> ''")
    short = F.median(F.length(F.trim("text"))) < SHORT_LINE
    math = F.bool_or(F.lower(F.coalesce("font", F.lit(""))).rlike(MATH_FONT))
    odd = F.max(F.size(F.coalesce("scripts", F.array().cast("array<string>")))) > 0
    hull = [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]
    blocks = said.groupBy("doc_id", "page", "block_no").agg((short | math | odd).alias("wanted"), *hull).where("wanted")
    names = ["doc_id", "page", "region_no", *CORNERS]
    kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.float64()] * 4]
    return by_page(_typed(blocks), lambda rows: [(k, *hull) for k, (hull, _) in enumerate(hulls.grown(rows, lambda a, b: hulls.near(a, b, FORMULA_GAP), FORMULA_GAP))], names, kinds, "doc_id string, page int, region_no int, x0 double, y0 double, x1 double, y1 double")


def region_scores(expected: DataFrame, regions: DataFrame) -> DataFrame:
    """(doc_id, page, formula_no, iou, covered) for expected boxes (formula_no, corners): the best region's overlap, and the largest share inside one."""
    wanted = expected.withColumn("doc_id", F.col("doc_id").cast("string"))
    pairs = spatial.touching(wanted.select("doc_id", "page", "formula_no", *CORNERS), regions.select("doc_id", "page", *CORNERS))
    w, h = (F.greatest(F.lit(0.0), F.least(f"{d}1", f"r_{d}1") - F.greatest(f"{d}0", f"r_{d}0")) for d in "xy")
    own, theirs = ((F.col(f"{p}x1") - F.col(f"{p}x0")) * (F.col(f"{p}y1") - F.col(f"{p}y0")) for p in ("", "r_"))
    shared = w * h
    overlap = F.when(shared > 0, shared / (own + theirs - shared)).otherwise(0.0)
    key = ["doc_id", "page", "formula_no"]
    best = pairs.groupBy(*key).agg(F.max(overlap).alias("iou"), F.max(F.when(own > 0, shared / own).otherwise(0.0)).alias("covered"))
    return wanted.select(*key).distinct().join(best, key, "left").na.fill(0.0, ["iou", "covered"])


# Gap and shared span of one picture's slices; the least size of a picture as stored (pixels) and as placed (points);
# the bounds of a region's density; the share of a page, and the characters on it, that make a region a background.
FIGURE_GAP, SPAN_OVERLAP, LEAST_PIXELS, LEAST_POINTS = 6.0, 0.8, 50, 24.0
LEAST_DPI, MOST_DPI, BACKGROUND_SHARE, BACKGROUND_CHARS = 72, 300, 0.85, 200
PLACED = "doc_id string, page int, figure_no int, x0 double, y0 double, x1 double, y1 double"


def group_figures(images: DataFrame) -> DataFrame:
    """Hulls of picture parts that belong together; hulls grow while they merge, so a page is walked as a whole.

    With a column ``density``, each hull has the largest of its parts', too.
    """
    dense = "density" in images.columns
    together = hulls.pieces_of_one(FIGURE_GAP, SPAN_OVERLAP)

    def page(rows: list[tuple]) -> list[tuple]:
        found = enumerate(hulls.grown([row[:4] for row in rows], together, FIGURE_GAP))
        return [(k, *hull, *([max(rows[i][4] for i in parts)] if dense else [])) for k, (hull, parts) in found]

    rows = _typed(images, extra=["density"] if dense else [])
    kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.float64()] * (5 if dense else 4)]
    return by_page(rows, page, ["doc_id", "page", "figure_no", *CORNERS, *(["density"] if dense else [])], kinds, PLACED + (", density double" if dense else ""))


def figure_counts(pages: DataFrame) -> DataFrame:
    """Adds ``image_count``, the number of ``figure_regions``, to pages with ``images`` (an array), width, height and text.

    A page with one picture left has it as its only figure; only others are walked.
    """
    ship_package(pages.sparkSession)
    together = hulls.pieces_of_one(FIGURE_GAP, SPAN_OVERLAP)

    @F.arrow_udf("array<double>")
    def areas(parts: pa.Array) -> pa.Array:
        out: list[list[float] | None] = []
        for at in range(0, len(parts), CHUNK):
            for own in _rows(parts, at):
                found = None if own is None else hulls.grown(sorted(tuple(p[c] for c in CORNERS) for p in own), together, FIGURE_GAP)
                out.append(None if found is None else [(hull[2] - hull[0]) * (hull[3] - hull[1]) for hull, _ in found])
        return pa.array(out, pa.list_(pa.float64()))

    w, h = (lambda p: p["x1"] - p["x0"]), (lambda p: p["y1"] - p["y0"])
    large = lambda p: (F.coalesce(p["pixels_x"], F.lit(LEAST_PIXELS)) >= LEAST_PIXELS) & (F.coalesce(p["pixels_y"], F.lit(LEAST_PIXELS)) >= LEAST_PIXELS) & (w(p) >= LEAST_POINTS) & (h(p) >= LEAST_POINTS)
    parts = F.transform(F.filter("images", large), lambda p: F.struct(*[p[c].cast("double").alias(c) for c in CORNERS]))
    found = pages.withColumn("_parts", parts)
    found = found.withColumn("_areas", F.coalesce(areas(F.when(F.size("_parts") > 1, F.col("_parts"))), F.transform("_parts", lambda p: w(p) * h(p))))
    area = F.coalesce(F.col("width") * F.col("height"), F.lit(0.0))
    background = (F.length("text") >= BACKGROUND_CHARS) & (area > 0)
    seen = F.filter("_areas", lambda a: ~(F.coalesce(background, F.lit(False)) & (a >= BACKGROUND_SHARE * area)))
    return found.withColumn("image_count", F.greatest(F.coalesce(F.size(seen), F.lit(0)), F.lit(0)).cast("long")).drop("_parts", "_areas")


def figure_regions(images: DataFrame, pages: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, page, figure_no, corners, dpi): the figures of each page, from its pictures (pixels_x, pixels_y, corners).

    Small pictures, as stored or as placed, are icons and no part of a figure. A region
    that takes most of a page (``pages`` has width and height) with a text of its own
    (``texts`` has text) is its background. A region is read at the density of its
    densest part, within bounds. Defined cases: pictures of unknown stored size pass;
    pages without an area or a text have no background; null corners give no region.
    """
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    stored = (F.coalesce("pixels_x", F.lit(LEAST_PIXELS)) >= LEAST_PIXELS) & (F.coalesce("pixels_y", F.lit(LEAST_PIXELS)) >= LEAST_PIXELS)
    density = F.least(F.lit(float(MOST_DPI)), F.coalesce(F.greatest(F.col("pixels_x") * 72.0 / w, F.col("pixels_y") * 72.0 / h), F.lit(0.0)))
    parts = images.where(stored & (w >= LEAST_POINTS) & (h >= LEAST_POINTS)).withColumn("density", density)
    key = lambda frame, *columns: frame.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("page").cast("int").alias("page"), *columns)
    sized = key(pages, (F.col("width") * F.col("height")).alias("area"))
    prose = key(texts.where(F.length("text") >= BACKGROUND_CHARS)).distinct().withColumn("prose", F.lit(True))
    found = group_figures(parts).join(sized, ["doc_id", "page"], "left").join(prose, ["doc_id", "page"], "left")
    background = F.coalesce("prose", F.lit(False)) & (F.coalesce("area", F.lit(0.0)) > 0) & (w * h >= BACKGROUND_SHARE * F.col("area"))
    return found.where(~background).select("doc_id", "page", "figure_no", *CORNERS, F.greatest(F.lit(LEAST_DPI), F.floor("density").cast("int")).alias("dpi"))
