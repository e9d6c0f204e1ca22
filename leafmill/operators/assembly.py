"""Paged documents put together from their words, ruling lines and pictures, and from readings of their pictures.

A page is a row with its words and drawings as arrays, and what it says on its own is
worked out where it is; only what recurs in a document is counted over pages, as digests,
and the few marks that are found travel back. Readings join on (doc_id, page).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafmill.functions import markup
from leafmill.functions.text import count_urls, drop_urls, strip
from leafmill.operators import chrome, diacritics, geometry, grids, merge, ocr, pages, reading_order, spatial, tables, visual
from leafmill.operators.spatial import CORNERS
from leafmill.runtime import cut, empty

SAMPLE = 120


@dataclass
class Scanned:
    """What a page scan gives.

    pages: doc_id, page, width, height, and, where a scan has them by page, words, images,
    drawings (arrays of structs) and fonts (an array of names); these frames are then None,
    as are those of what there is none of. Else they are rows by doc_id and page. words: doc_id, page, block_no, line_no, word_no, text,
    x0, y0, x1, y1, a, b (the writing direction). images: xref, corners and, if known, the stored size pixels_x, pixels_y. drawings: item (l, re)
    and corners. fonts: font.
    """

    pages: DataFrame
    words: DataFrame | None = None
    images: DataFrame | None = None
    drawings: DataFrame | None = None
    fonts: DataFrame | None = None


@dataclass
class Readings:
    """What was read from pictures, as far as it was.

    lines: doc_id, page, image_no, line_no, text, confidence, error, as ``detection.recognize``
    gives them; pages to be read that have none were not read, for the reason ``unread``.
    visual: doc_id, page, raw, capped, as ``visual.infer`` gives them. ``figures``: whether
    the pictures of pages with a text of their own are read, too.
    """

    lines: DataFrame | None = None
    visual: DataFrame | None = None
    unread: str = "no recognition engine is installed"
    figures: bool = True


@dataclass
class Assembled:
    """units: doc_id, page, page_class, image_count. blocks: doc_id, page, stage, ord, type, text, rows, source. warnings: doc_id, page, code, detail, confidence, attrs."""

    units: DataFrame
    blocks: DataFrame
    warnings: DataFrame


KEY = ["doc_id", "page"]


WORD = ("block_no", "line_no", "word_no", "text", *CORNERS, "a", "b")
PARTS = {"words": WORD, "images": ("xref", *CORNERS, "pixels_x", "pixels_y"), "drawings": ("item", *CORNERS), "fonts": ("font",)}
KINDS = {"xref": "int", "pixels_x": "int", "pixels_y": "int", "item": "string", "font": "string", "block_no": "int", "line_no": "int", "word_no": "int", "text": "string"}


def packed(scan: Scanned) -> DataFrame:
    """The pages with their words, images, drawings and fonts as arrays; frames of rows are grouped by page, once each.

    A page without a document or a number holds nothing, as it joins with nothing.
    """
    out = scan.pages
    for name, columns in PARTS.items():
        frame, kind = getattr(scan, name), f"array<struct<{','.join(f'{c}:{KINDS.get(c, "double")}' for c in columns)}>>"
        kind = "array<string>" if name == "fonts" else kind
        if frame is not None:
            missing = {c: F.lit(None).cast("int") for c in columns if c not in frame.columns}
            item = F.col("font") if name == "fonts" else F.struct(*columns)
            out = out.drop(name).join(frame.withColumns(missing).groupBy(*KEY).agg(F.collect_list(item).alias(name)), KEY, "left")
        value = F.col(name) if name in out.columns else F.lit(None)
        out = out.withColumn(name, F.when(F.col("doc_id").isNotNull() & F.col("page").isNotNull(), value).cast(kind))
    return out


def _by_doc(pages: DataFrame, marks: DataFrame, schema: str) -> tuple[DataFrame, bool]:
    """The pages with what is known of their documents, null where nothing is, and whether anything is at all; the marks are worked out once, and few travel to the pages."""
    known = cut(marks)
    n = known.count()
    if n == 0:
        fields = StructType.fromDDL(schema)
        return pages.withColumns({f.name: F.lit(None).cast(f.dataType) for f in fields}), False
    return pages.join(F.broadcast(known) if n <= spatial.SMALL else known, "doc_id", "left"), True


def _said(words: Column) -> Column:
    """The text of words as they stand on the page; null where there are none."""
    ordered = F.sort_array(F.transform(words, lambda w: F.struct(*[w[c].alias(c) for c in ("block_no", "line_no", "word_no", "text")])))
    return F.when(F.size(words) > 0, F.array_join(F.transform(ordered, lambda w: w["text"]), " "))


def _stamps(each: DataFrame, counts: DataFrame) -> DataFrame:
    """(doc_id, stamps, logos): upright words and pictures that recur on the document's pages."""
    own = lambda items: each.select(*KEY, F.explode(items).alias("x")).select(*KEY, "x.*")
    upright = own(F.filter("words", lambda w: geometry.is_vertical(w["a"], w["b"])))
    placed = own(F.filter("images", lambda p: p["xref"] > 0))
    found = chrome.repeated_vertical_words(upright, counts).select("doc_id", "stamp", F.lit(None).cast("int").alias("xref"))
    found = found.unionByName(chrome.repeated_images(placed, counts).select("doc_id", F.lit(None).cast("string").alias("stamp"), "xref"))
    return found.groupBy("doc_id").agg(F.collect_list("stamp").alias("stamps"), F.collect_list("xref").alias("logos"))


def read_page(each: DataFrame, has_drawings: bool, wanted: bool) -> DataFrame:
    """What a page says on its own: its class and signals, tables, text in reading order, edge lines, askew words.

    ``each`` is as ``packed`` gives pages, with ``stamps`` and ``logos`` of their documents. Nothing is
    shuffled but pages of crowded drawings. ``wanted``: whether all that stands on the page is kept as ``shown``.
    """
    upright = lambda w: geometry.is_vertical(w["a"], w["b"]) & F.coalesce(F.array_contains(F.col("stamps"), F.lower(w["text"])), F.lit(False))
    is_stamp = lambda w: F.coalesce(geometry.is_skewed(w["a"], w["b"]) | upright(w), F.lit(False))
    each = each.withColumn("stamped", F.filter("words", is_stamp))
    each = each.withColumn("kept", F.when(F.size("stamped") > 0, F.filter("words", lambda w: ~is_stamp(w))).otherwise(F.col("words")))
    each = pages.drawn_signals(each)
    if has_drawings:
        # Stamps stay out of the cells they cross.
        each = grids.found_in(each, "kept")
        each = each.withColumn("native", F.filter("native", lambda t: tables.is_real_table(t["rows"])))
        box = lambda x: tuple(x[c] for c in CORNERS)
        clear = F.filter("kept", lambda w: ~F.exists("native", lambda t: F.coalesce(geometry.overlaps(box(w), box(t)), F.lit(False))))
        free = F.when(F.size("native") > 0, clear).otherwise(F.col("kept"))
    else:
        each, free = each.withColumn("native", F.array().cast(grids.FOUND)), F.col("kept")
    edges = chrome.edge_lines(F.col("kept"), F.col("width"), F.col("height"))
    # Words go before anything else travels to Python.
    logo = lambda p: F.coalesce(F.array_contains(F.col("logos"), p["xref"]), F.lit(False))
    each = each.select(
        *KEY, "width", "height", "image_ratio", "ruling_lines", "font_count", "native", F.filter("images", lambda p: ~logo(p)).alias("images"),
        geometry.blocks_in(free).alias("blocks"), _said(F.col("words")).alias("text"), edges.alias("edges"), _said(F.col("stamped")).alias("askew"),
    )
    each = reading_order.figure_counts(pages.text_signals(each))
    each = each.withColumn("page_class", pages.page_class()).withColumn("scripts", pages.unexpected_scripts(F.coalesce("text", F.lit(""))))
    each = reading_order.ordered_texts(each.withColumn("shown", F.col("text") if wanted else F.lit(None).cast("string")))
    return each.select(*KEY, "page_class", "image_count", "scripts", "shown", "text", "columns", "concurrent", "native", "edges", "askew")


def _visual_pages(readings: Readings, classed: DataFrame, native: DataFrame) -> DataFrame:
    """(doc_id, page, page_class, text, found, tables, urls, lost, reason, redundant) of the visual model's readings, judged.

    ``text`` and ``tables`` are what is kept; letters that the model set apart are rejoined by
    the words of the document's own text, and its URLs go.
    """
    raw = F.col("raw")
    read = readings.visual.join(classed.select(*KEY, "page_class", F.col("text").alias("native_text"), F.size("scripts").alias("odd")), KEY)
    read = read.select(*KEY, "page_class", "native_text", markup.prose(raw).alias("said"), markup.formulas(raw).alias("formulas"), markup.page_tables(raw).alias("grids"), (F.col("capped") | markup.is_truncated(raw)).alias("truncated"), markup.dropped_formulas(raw).alias("lost"))
    # Markup is parsed once, not for each use of what it says.
    read = cut(read)
    joined = diacritics.rejoin(read.select("doc_id", F.col("page").alias("text_no"), F.col("said").alias("text")), classed.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    read = read.join(joined.withColumnRenamed("text_no", "page"), KEY).drop("said")
    judged = visual.accept(read.select(*KEY, "text", "native_text", "formulas", F.size("grids").alias("table_count"), "truncated", F.col("page_class").isin(*pages.REREAD_CLASSES).alias("replacing")), native)
    out = read.select(*KEY, "page_class", "formulas", "grids", "lost").join(judged, KEY)
    kept = F.when(F.col("kept_tables") > 0, F.col("grids")).otherwise(F.slice("grids", 1, 0))
    return out.select(*KEY, "page_class", drop_urls(F.col("kept_text")).alias("text"), F.size("formulas").alias("found"), kept.alias("tables"), count_urls(F.col("kept_text")).alias("urls"), "lost", "reason", "redundant")


def _visual_warnings(read: DataFrame) -> DataFrame:
    kept = F.col("reason").isNull()
    some = lambda **pairs: F.map_filter(F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v.cast("string"))]), lambda _, v: v.isNotNull())
    item = lambda code, when, attrs: F.when(when, F.struct(F.lit(code).alias("code"), attrs.alias("attrs")))
    rows = F.array(
        item("VLM_APPLIED", kept, some(formulas=F.col("found"), prose=F.when(F.col("redundant"), F.lit("redundant")))),
        item("VLM_OUTPUT_REJECTED", ~kept, some(reason=F.col("reason"))),
        item("VLM_URLS_DROPPED", kept & (F.col("urls") > 0), some(count=F.col("urls"))),
        item("FORMULA_REVIEW_REQUIRED", kept & (F.col("lost") > 0), some(count=F.col("lost"))),
    )
    return read.select(*KEY, F.explode(F.array_compact(rows)).alias("w")).select(*KEY, "w.code", "w.attrs")


def _recognized_warnings(results: DataFrame) -> DataFrame:
    some = lambda **pairs: F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v.cast("string"))])
    item = lambda code, when, attrs=None, detail=None: F.when(when, F.struct(code.alias("code"), (F.lit(None) if attrs is None else attrs).cast("map<string,string>").alias("attrs"), (F.lit(None) if detail is None else detail).cast("string").alias("detail")))
    rows = F.array(
        item(F.col("code"), F.lit(True), some(low_lines=F.col("low_lines"), total_lines=F.col("scored_lines"), lowest=F.col("lowest")), F.when(F.col("code") == "OCR_FAILED", F.col("failure"))),
        item(F.lit("OCR_IMAGE_FAILED"), F.col("partial"), None, F.col("failure")),
        item(F.lit("OCR_NOISE_FILTERED"), F.col("dropped") > 0, some(dropped=F.col("dropped"), sample=F.array_join("sample", ", "))),
    )
    return results.withColumnRenamed("detail", "failure").select(*KEY, "confidence", F.explode(F.array_compact(rows)).alias("w")).select(*KEY, "confidence", "w.*")


def assemble(scan: Scanned, readings: Readings | None = None) -> Assembled:
    """Units, blocks and warnings of paged documents.

    Readings of a page stand in for a text that cannot be trusted or lacks, and beside one
    that can: by ``merge.merge_text`` and ``merge.merge_tables``. Pages that the visual model
    has read are not read by recognition as well. Defined cases: a page without words has a
    unit and no text block; repeated words stay; a document without pages has no rows; grids
    that are no real tables leave their words in the text; readings of pages that there are
    not go nowhere; empty frames give empty frames.
    """
    readings = readings or Readings()
    spark = scan.pages.sparkSession
    own = packed(scan)
    own = own.withColumns({c: F.lit(None).cast("double") for c in ("width", "height") if c not in own.columns})
    # Nothing recurs in documents of so few pages.
    counts = cut(own.groupBy("doc_id").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= chrome.HEADER_PAGES))
    n_long = counts.count()
    counts = F.broadcast(counts) if n_long <= spatial.SMALL else counts
    has = lambda name: getattr(scan, name) is not None or name in scan.pages.columns
    marks = _stamps(own, counts) if n_long else empty(spark, "doc_id string, stamps array<string>, logos array<int>")
    marked, _ = _by_doc(own, marks, "stamps array<string>, logos array<int>")
    classed = cut(read_page(marked, has("drawings"), readings.visual is not None))

    # Running lines go from the text; headers and footers come back as blocks.
    split = F.transform(F.split("text", r"\R"), strip)
    lined = classed.select(*KEY, "page_class", "edges", split.alias("lines"))
    edge_kind, body_kind = "edge_marks array<struct<band:string,sig:string,first_seen:struct<page:int,at:struct<block_no:int,line_no:int>>>>", "body_marks array<string>"
    lined, some_edges = _by_doc(lined, chrome.recurring_edges(classed, counts) if n_long else empty(spark, f"doc_id string, {edge_kind}"), edge_kind)
    lined, some_body = _by_doc(lined, chrome.recurring_body(classed.select("doc_id", split.alias("lines")), counts) if n_long else empty(spark, f"doc_id string, {body_kind}"), body_kind)
    lined = lined.withColumn("running", chrome.running_lines(F.col("edges"), F.col("edge_marks")) if some_edges else F.array().cast("array<struct<kind:string,first_seen:int,line:string>>"))
    left = chrome.lines_left(F.col("lines"), F.col("running"), F.col("body_marks") if some_body else None) if some_edges or some_body else F.col("lines")
    text = lined.select(*KEY, "page_class", F.array_join(left, "\n").alias("text"))
    text = text.withColumn("text", F.when(F.trim("text") != "", F.col("text")))
    of_kind = lambda kind: lined.select(*KEY, F.posexplode(F.filter("running", lambda x: x["kind"] == kind)).alias("ord", "x")).select(*KEY, (F.col("ord") + 1).alias("ord"), "x.line")
    native = classed.select(*KEY, F.inline("native"))

    # What was read from pictures.
    visual_pages = empty(spark, "doc_id string, page int, page_class string, text string, found int, tables array<array<array<string>>>, urls int, lost int, reason string, redundant boolean")
    if readings.visual is not None:
        visual_pages = cut(_visual_pages(readings, classed.drop("text").withColumnRenamed("shown", "text"), native))
    accepted = visual_pages.where("reason is null")
    targets = pages.ocr_targets(classed, accepted, readings.figures and readings.lines is not None)
    results = empty(spark, "doc_id string, page int, text string, confidence double, code string, low_lines long, scored_lines long, lowest double, detail string, partial boolean, dropped long, sample array<string>")
    if readings.lines is not None:
        results = cut(ocr.page_results(readings.lines.join(targets.select(*KEY), KEY, "left_semi")))
    unread = targets.join(results.select(*KEY), KEY, "left_anti")
    merged = merge.merge_text(text, results, accepted)
    tabled = merge.merge_tables(native.select(*KEY, "table_no", "rows"), accepted.select(*KEY, F.posexplode("tables").alias("table_no", "rows")))

    none = F.lit(None)
    row = lambda frame, stage, kind, at, said, rows=none, source=none: frame.select(*KEY, stage.alias("stage"), at.cast("int").alias("ord"), F.lit(kind).alias("type"), said.cast("string").alias("text"), rows.cast("array<array<string>>").alias("rows"), source.cast("string").alias("source"))
    blocks = row(of_kind("header"), F.lit("header"), "header", F.col("ord"), F.col("line"))
    blocks = blocks.unionByName(row(of_kind("footer"), F.lit("footer"), "footer", F.col("ord"), F.col("line")))
    blocks = blocks.unionByName(row(merged.where("stage <> 'rejected'"), F.col("stage"), "text", F.lit(0), F.col("text"), none, F.when(F.col("source") != "native", F.col("source"))))
    blocks = blocks.unionByName(row(tabled, F.col("stage"), "table", F.col("table_no"), none, tables.clean_rows(F.col("rows")), F.when(F.col("stage") == "visual_table", "visual")))

    said = lambda frame, code, page=F.col("page"), detail=none: frame.select("doc_id", page.cast("int").alias("page"), F.lit(code).alias("code"), detail.cast("string").alias("detail"))
    warnings = pages.page_warnings(classed).select("doc_id", "page", "code", none.cast("string").alias("detail"))
    beside = classed.where("columns > 1 and concurrent").select("doc_id", "page").distinct()
    chromed = lined.where("edge_marks is not null or body_marks is not null").select("doc_id").distinct()
    rotated = chrome.rotated_text_report(classed.select(*KEY, F.col("askew").alias("text")))
    warnings = warnings.unionByName(said(beside, "POSSIBLE_TWO_COLUMN_ORDER")).unionByName(said(chromed, "HEADER_FOOTER_DETECTED", none))
    warnings = warnings.unionByName(said(rotated, "ROTATED_TEXT_FILTERED", none, F.substring("sample", 1, SAMPLE))).unionByName(said(unread, "OCR_UNAVAILABLE", F.col("page"), F.lit(readings.unread)))
    warnings = warnings.withColumns({"confidence": none.cast("double"), "attrs": none.cast("map<string,string>")})
    warnings = warnings.unionByName(_visual_warnings(visual_pages), allowMissingColumns=True)
    recognized = _recognized_warnings(results).select("doc_id", "page", "code", "detail", "confidence", "attrs")
    swapped = merge.swap_warnings(recognized, merged.where("stage = 'rejected'"))
    return Assembled(classed.select(*KEY, "page_class", "image_count"), blocks, warnings.unionByName(swapped))
