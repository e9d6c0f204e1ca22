"""Page signals, classes and the warnings that follow from them."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Thresholds of the classes.
REPLACED, PRINTABLE, IMAGE_AREA, SCANNED_CHARS, RULES, FONTS, SCRIPTS = 0.05, 0.95, 0.60, 20, 30, 12, 2
CLASS_CODES = {"scanned": "SCANNED_PAGE_NO_TEXT", "mixed": "MIXED_CONTENT_PAGE", "garbled": "GARBLED_TEXT", "layout-complex": "LAYOUT_COMPLEX"}
NOT_PRINTABLE = r"[\p{C}\p{Zl}\p{Zp}\p{Zs}&&[^ \n\r\t\f]]"
FULL_PAGE_CLASSES, FIGURE_CLASSES, REREAD_CLASSES = ("scanned",), ("mixed", "layout-complex"), ("scanned", "garbled")


def text_signals(pages: DataFrame) -> DataFrame:
    """Adds char_count, word_count, replaced_ratio and printable_ratio of ``text``."""
    text = F.coalesce("text", F.lit(""))
    n = F.length(text)
    share = lambda pattern: F.when(n == 0, 0.0).otherwise(F.regexp_count(text, F.lit(pattern)) / n)
    return pages.withColumns(
        {
            "char_count": n,
            "word_count": F.regexp_count(text, F.lit(r"(?U)\S+")),
            "replaced_ratio": share("�"),
            "printable_ratio": F.lit(1.0) - share(NOT_PRINTABLE),
        }
    )


def area_signals(pages: DataFrame, images: DataFrame, drawings: DataFrame, fonts: DataFrame) -> DataFrame:
    """Adds image_ratio, ruling_lines and font_count; pages without any have zeros."""
    placed = images.groupBy("doc_id", "page").agg(F.sum((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("image_area"))
    ruled = drawings.groupBy("doc_id", "page").agg(F.sum(F.when(F.col("item") == "l", 1).when(F.col("item") == "re", 4).otherwise(0)).alias("ruling_lines"))
    named = fonts.groupBy("doc_id", "page").agg(F.countDistinct("font").alias("font_count"))
    out = pages
    for part in (placed, ruled, named):
        out = out.join(part, ["doc_id", "page"], "left")
    area = F.col("width") * F.col("height")
    return out.withColumns(
        {
            "image_ratio": F.when(area > 0, F.least(F.coalesce(F.col("image_area"), F.lit(0.0)) / area, F.lit(1.0))).otherwise(0.0),
            "ruling_lines": F.coalesce("ruling_lines", F.lit(0)),
            "font_count": F.coalesce("font_count", F.lit(0)),
        }
    ).drop("image_area")


def drawn_signals(pages: DataFrame) -> DataFrame:
    """The same for pages that have their images, drawings and fonts as arrays."""
    add = lambda items, value: F.aggregate(F.coalesce(F.transform(items, value), F.array().cast("array<double>")), F.lit(0.0), lambda n, x: n + F.coalesce(x, F.lit(0.0)))
    area = F.col("width") * F.col("height")
    covered = add("images", lambda p: ((p["x1"] - p["x0"]) * (p["y1"] - p["y0"])).cast("double"))
    rules = add("drawings", lambda p: F.when(p["item"] == "l", 1.0).when(p["item"] == "re", 4.0).otherwise(0.0))
    fonts = F.size(F.array_distinct(F.filter(F.coalesce("fonts", F.array().cast("array<string>")), lambda f: f.isNotNull())))
    return pages.withColumns({"image_ratio": F.when(area > 0, F.least(covered / area, F.lit(1.0))).otherwise(0.0), "ruling_lines": rules.cast("long"), "font_count": fonts})


def page_class() -> Column:
    """The class of a row that has all signals; the first rule that holds decides."""
    return (
        F.when((F.col("char_count") > 0) & ((F.col("replaced_ratio") > REPLACED) | (F.col("printable_ratio") < PRINTABLE)), "garbled")
        .when((F.col("image_ratio") > IMAGE_AREA) & (F.col("char_count") < SCANNED_CHARS), "scanned")
        .when(F.col("image_ratio") > IMAGE_AREA, "mixed")
        .when((F.col("ruling_lines") > RULES) | (F.col("font_count") > FONTS), "layout-complex")
        .otherwise("native-text")
    )


def page_warnings(pages: DataFrame) -> DataFrame:
    """(doc_id, page, code) of rows with page_class and scripts (an array of unexpected script names)."""
    by_class = F.coalesce(*[F.when(F.col("page_class") == k, F.lit(v)) for k, v in CLASS_CODES.items()])
    glyphs = F.when(F.size(F.coalesce("scripts", F.array().cast("array<string>"))) >= SCRIPTS, F.lit("MISMAPPED_GLYPHS"))
    return pages.select("doc_id", "page", F.explode(F.array_compact(F.array(by_class, glyphs))).alias("code"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def unexpected_scripts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Scripts, by the first word of the characters' names, beyond those a European text may mix."""
    expected = {"LATIN", "GREEK", "CYRILLIC", "COMBINING", "MODIFIER"}
    known: dict[str, str] = {}

    def script(char: str) -> str:
        if char not in known:
            letter = ord(char) >= 0x370 and unicodedata.category(char)[0] in "LM"
            name = unicodedata.name(char, "").split(" ")[0] if letter else ""
            known[char] = "" if name in expected else name
        return known[char]

    for part in texts:
        yield part.map(lambda t: sorted({script(c) for c in set(t or "")} - {""}))


def visual_candidates(pages: DataFrame) -> DataFrame:
    """Pages that the visual model should read again."""
    return pages.where(F.col("page_class").isin(*REREAD_CLASSES) | (F.size("scripts") >= SCRIPTS)).select("doc_id", "page")


def ocr_targets(pages: DataFrame, replaced: DataFrame, figures: bool = False) -> DataFrame:
    """Pages for OCR: whole pages by class and, with ``figures``, pages whose pictures are read; never those already replaced."""
    whole = F.col("page_class").isin(*REREAD_CLASSES)
    wanted = whole | (F.lit(figures) & F.col("page_class").isin(*FIGURE_CLASSES) & (F.col("image_count") > 0))
    return pages.where(wanted).join(replaced.select("doc_id", "page").distinct(), ["doc_id", "page"], "left_anti").select("doc_id", "page", whole.alias("whole_page"))
