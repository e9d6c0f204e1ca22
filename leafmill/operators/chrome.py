"""Repetition across pages: running headers and footers, repeated body lines, stamps, logos.

Every operator is an aggregate over (document, something repeated) and a join back, so
one shuffle by document serves the family; signatures are counted on rows already
reduced to one per page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.arrays import alike, let, runs
from leafmill.functions.text import line_signature, strip

# Bands and thresholds.
TOP, BOTTOM, LEFT, RIGHT = 0.12, 0.88, 0.15, 0.85
HEADER_PAGES, HEADER_SHARE = 3, 0.6
BODY_PAGES, BODY_SHARE, BODY_LENGTH = 20, 0.2, 12
STAMP_PAGES, LOGO_PAGES, LOGO_SHARE = 5, 4, 0.5
WATERMARK_PAGES, WATERMARK_SHARE, WATERMARK_LENGTH = 2, 0.5, 8


#: Kinds of what recurs: lines of the four bands, body lines, upright words, pictures, skewed texts.
BANDS = ("top", "bottom", "left", "right")


def enough(kind: str) -> Column:
    """Whether what is on ``on_pages`` of a document's ``n_pages`` recurs, by the rule of its kind."""
    on, n = F.col("on_pages"), F.col("n_pages")
    if kind in BANDS:
        return (n >= HEADER_PAGES) & (on >= F.greatest(F.lit(HEADER_PAGES), F.floor(HEADER_SHARE * n)))
    if kind == "body":
        return (n >= BODY_PAGES) & (on >= F.greatest(F.lit(3), F.floor(BODY_SHARE * n)))
    if kind == "stamp":
        return (n >= STAMP_PAGES) & (on >= STAMP_PAGES)
    if kind == "image":
        return (n >= LOGO_PAGES) & (on >= F.greatest(F.lit(float(LOGO_PAGES)), LOGO_SHARE * n))
    return on >= F.greatest(F.lit(WATERMARK_PAGES), F.floor(WATERMARK_SHARE * n))


def signature(kind: str, text: Column) -> Column:
    """What tells recurring things of a kind apart, or null for what does not count."""
    if kind in BANDS:
        return F.nullif(line_signature(text), F.lit(""))
    if kind == "body":
        return F.when(F.length(text) >= BODY_LENGTH, line_signature(text, exact=True))
    if kind == "watermark":
        return F.when(F.length(text) >= WATERMARK_LENGTH, line_signature(text))
    return F.lower(text) if kind == "stamp" else text


def explode_lines(pages: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, page, idx, line): the lines of each page's text, stripped."""
    rows = pages.select("doc_id", "page", F.posexplode(F.split(text, r"\R")).alias("idx", "line"))
    return rows.withColumn("line", strip(F.col("line")))


def band_lines(words: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, page, band, block_no, line_no, line) of the words in each page's edge bands."""
    sized = words.join(pages.select("doc_id", "page", "width", "height"), ["doc_id", "page"])
    bands = F.array(
        F.when(F.col("y0") < TOP * F.col("height"), F.lit("top")),
        F.when(F.col("y1") > BOTTOM * F.col("height"), F.lit("bottom")),
        F.when(F.col("x1") < LEFT * F.col("width"), F.lit("left")),
        F.when(F.col("x0") > RIGHT * F.col("width"), F.lit("right")),
    )
    rows = sized.withColumn("band", F.explode(F.array_compact(bands)))
    ordered = F.array_sort(F.collect_list(F.struct("x0", "word_no", F.col("text").alias("t"))))
    return rows.groupBy("doc_id", "page", "band", "block_no", "line_no").agg(F.array_join(F.transform(ordered, lambda s: s["t"]), " ").alias("line"))


def edge_lines(words: Column, width: Column, height: Column) -> Column:
    """A page's band lines that can recur, from its words as an array: an array of band, sig, line and at, one for each signature.

    As ``repeated_band_lines`` counts them: of one signature the last line of a page shows, and the first place counts.
    """
    tests = {
        "top": lambda w: w["y0"] < TOP * height,
        "bottom": lambda w: w["y1"] > BOTTOM * height,
        "left": lambda w: w["x1"] < LEFT * width,
        "right": lambda w: w["x0"] > RIGHT * width,
    }
    names = ("block_no", "line_no", "x0", "word_no", "text")

    def lines(own: Column, band: str) -> Column:
        placed = F.sort_array(F.transform(F.filter(own, tests[band]), lambda w: F.struct(*[w[n].alias(n) for n in names])))

        def line(run: Column) -> Column:
            said, first = F.array_join(F.transform(run, lambda w: w["text"]), " "), F.get(run, F.lit(0))
            return F.struct(F.lit(band).alias("band"), signature(band, said).alias("sig"), F.struct(first["block_no"].alias("block_no"), first["line_no"].alias("line_no")).alias("at"), said.alias("line"))

        return F.transform(runs(placed, alike("block_no", "line_no")), line)

    at_edge = F.filter(words, lambda w: tests["top"](w) | tests["bottom"](w) | tests["left"](w) | tests["right"](w))
    found = let(at_edge, lambda own: F.concat(*[lines(own, band) for band in BANDS]))
    signed = F.sort_array(F.filter(found, lambda x: x["sig"].isNotNull()))
    one = lambda run: F.struct(F.get(run, F.lit(0))["band"].alias("band"), F.get(run, F.lit(0))["sig"].alias("sig"), F.element_at(run, -1)["line"].alias("line"), F.get(run, F.lit(0))["at"].alias("at"))
    return F.transform(runs(signed, alike("band", "sig")), one)


def recurring_edges(pages: DataFrame, page_counts: DataFrame) -> DataFrame:
    """(doc_id, edge_marks): the band, sig and first_seen of edge lines (``edges``) on enough of a document's pages."""
    each = pages.select("doc_id", "page", F.inline("edges"))
    counted = each.groupBy("doc_id", "band", "sig").agg(F.count("*").alias("on_pages"), F.min(F.struct("page", "at")).alias("first_seen"))
    kept = counted.join(page_counts, "doc_id").where(enough("top"))
    return kept.groupBy("doc_id").agg(F.collect_list(F.struct("band", "sig", "first_seen")).alias("edge_marks"))


def body_signatures(lines: Column) -> Column:
    """A digest of each line's signature, null for lines that do not count; it is what is counted, so no line is shuffled."""
    return F.transform(lines, lambda line: F.sha2(signature("body", line), 256))


def recurring_body(pages: DataFrame, page_counts: DataFrame) -> DataFrame:
    """(doc_id, body_marks): digests of the body lines (``lines``) that recur on enough of a long document's pages."""
    long = pages.join(page_counts.where(F.col("n_pages") >= BODY_PAGES), "doc_id")
    each = long.select("doc_id", "n_pages", F.explode(F.array_distinct(F.array_compact(body_signatures(F.col("lines"))))).alias("sig"))
    counted = each.groupBy("doc_id", F.unhex("sig").alias("sig")).agg(F.count("*").alias("on_pages"), F.first("n_pages").alias("n_pages"))
    return counted.where(enough("body")).groupBy("doc_id").agg(F.collect_list(F.lower(F.hex("sig"))).alias("body_marks"))


def running_lines(edges: Column, marks: Column) -> Column:
    """A page's edge lines that recur, by kind (header, footer, side), where they were first seen, and line."""

    def entry(e: Column) -> Column:
        known = F.get(F.filter(marks, lambda m: (m["band"] == e["band"]) & (m["sig"] == e["sig"])), F.lit(0))
        kind = F.when(e["band"] == "top", "header").when(e["band"] == "bottom", "footer").otherwise("side")
        return F.struct(kind.alias("kind"), known["first_seen"].alias("first_seen"), e["line"].alias("line"))

    return F.sort_array(F.filter(F.transform(edges, entry), lambda x: x["first_seen"].isNotNull()))


def lines_left(lines: Column, running: Column, body_marks: Column | None) -> Column:
    """A page's lines without its running lines and recurring body lines, as ``remove_banners`` and ``remove_chrome_lines`` take them away."""
    of = lambda kind: F.transform(F.filter(running, lambda x: x["kind"] == kind), lambda x: x["line"])
    same = lambda items, line: F.size(F.filter(items, lambda x: x == line))

    def rest(own: Column, heads: Column, feet: Column, gone: Column) -> Column:
        def stays(line: Column, k: Column) -> Column:
            # Ranks are counted for lines that equal a running one alone.
            head = F.when(F.array_contains(heads, line), same(F.slice(own, F.lit(1), k + 1), line) <= same(heads, line)).otherwise(False)
            foot = F.when(F.array_contains(feet, line), same(F.slice(own, k + 1, F.size(own) - k), line) <= same(feet, line)).otherwise(False)
            return ~(head | foot | F.array_contains(gone, line))

        return F.filter(own, stays)

    gone = F.transform(of("side"), strip)
    body = F.array().cast("array<string>")
    if body_marks is not None:
        signed = lambda own: let(body_signatures(own), lambda sigs: F.transform(F.array_intersect(body_marks, sigs), lambda s: F.element_at(own, F.array_position(sigs, s).cast("int"))))
        body = F.when(F.size(body_marks) > 0, F.transform(let(lines, signed), strip)).otherwise(body)
    return let(lines, lambda own: let(of("header"), lambda heads: let(of("footer"), lambda feet: let(F.concat(gone, F.coalesce(body, F.array().cast("array<string>"))), lambda out: rest(own, heads, feet, out)))))


def repeated_band_lines(lines: DataFrame, page_counts: DataFrame) -> DataFrame:
    """Band lines whose signature is on enough pages: (doc_id, page, band, line, first_seen).

    ``lines`` has doc_id, page, band, block_no, line_no, line; ``page_counts`` doc_id,
    n_pages. Of one signature only a page's last line counts.
    """
    at = F.struct("block_no", "line_no")
    signed = lines.withColumn("sig", signature("top", F.col("line"))).where("sig is not null")
    one = signed.groupBy("doc_id", "band", "sig", "page").agg(F.max_by("line", at).alias("line"), F.min(at).alias("at"))
    whole = Window.partitionBy("doc_id", "band", "sig")
    counted = one.withColumn("on_pages", F.count("*").over(whole)).withColumn("first_seen", F.min(F.struct("page", "at")).over(whole))
    kept = counted.join(page_counts, "doc_id").where(enough("top"))
    return kept.select("doc_id", "page", "band", "line", "on_pages", "first_seen")


def repeated_body_lines(lines: DataFrame, page_counts: DataFrame) -> DataFrame:
    """(doc_id, page, line) of long lines that recur on a fifth of a long document's pages."""
    signed = lines.withColumn("sig", signature("body", F.col("line"))).where("sig is not null")
    one = signed.groupBy("doc_id", "sig", "page").agg(F.min_by("line", "idx").alias("line"))
    counted = one.withColumn("on_pages", F.count("*").over(Window.partitionBy("doc_id", "sig")))
    kept = counted.join(page_counts, "doc_id").where(enough("body"))
    return kept.select("doc_id", "page", "line", "on_pages")


def remove_banners(lines: DataFrame, chrome: DataFrame) -> DataFrame:
    """Each header entry takes its first exact line of the page away, each footer its last.

    ``chrome`` is (doc_id, page, kind header|footer, line), one row per entry.
    """
    want = chrome.groupBy("doc_id", "page", "line").agg(F.count_if(F.col("kind") == "header").alias("heads"), F.count_if(F.col("kind") == "footer").alias("feet"))
    same = Window.partitionBy("doc_id", "page", "line")
    ranked = lines.withColumn("from_top", F.row_number().over(same.orderBy("idx"))).withColumn("from_end", F.row_number().over(same.orderBy(F.desc("idx"))))
    joined = ranked.join(want, ["doc_id", "page", "line"], "left")
    gone = (F.col("from_top") <= F.coalesce("heads", F.lit(0))) | (F.col("from_end") <= F.coalesce("feet", F.lit(0)))
    return joined.where(~gone).select(*lines.columns)


def remove_chrome_lines(lines: DataFrame, chrome: DataFrame) -> DataFrame:
    """Every line of the page that equals a chrome line goes."""
    known = chrome.select("doc_id", "page", strip(F.col("line")).alias("line")).distinct()
    return lines.join(known, ["doc_id", "page", "line"], "left_anti").select(*lines.columns)


def _on_pages(rows: DataFrame, key: str) -> DataFrame:
    return rows.select("doc_id", key, "page").distinct().groupBy("doc_id", key).agg(F.count("*").alias("on_pages"))


def repeated_vertical_words(words: DataFrame, page_counts: DataFrame) -> DataFrame:
    """Vertical words, by lower-cased text, on five pages or more of documents that have so many."""
    counted = _on_pages(words.withColumn("stamp", signature("stamp", F.col("text"))), "stamp")
    return counted.join(page_counts, "doc_id").where(enough("stamp")).select("doc_id", "stamp", "on_pages")


def repeated_images(images: DataFrame, page_counts: DataFrame) -> DataFrame:
    """Image objects on half of the pages, and on four at least."""
    counted = _on_pages(images, "xref").join(page_counts, "doc_id")
    return counted.where(enough("image")).select("doc_id", "xref", "on_pages")


def rotated_text_report(rotated: DataFrame) -> DataFrame:
    """Per document with rotated text: its pages, characters, and a sample from its first page, the least text where that page has several."""
    some = rotated.where("text <> ''")
    return some.groupBy("doc_id").agg(F.countDistinct("page").alias("pages"), F.sum(F.length("text")).alias("characters"), F.min_by(F.substring("text", 1, 120), F.struct("page", "text")).alias("sample"))


def watermark_signatures(skewed: DataFrame, page_counts: DataFrame) -> DataFrame:
    """Skewed texts of a page that recur on half of the document's pages."""
    rows = skewed.withColumn("sig", signature("watermark", F.col("text"))).where("sig is not null")
    counted = _on_pages(rows, "sig").join(page_counts, "doc_id")
    return counted.where(enough("watermark")).select("doc_id", "sig", "on_pages")
