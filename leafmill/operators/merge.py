"""Native, OCR and visual readings of a page merged by explicit precedence, and the nested model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_CONFIDENCE = 0.60
#: The order of a unit's blocks.
STAGES = ("header", "text", "ocr", "visual", "native_table", "visual_table", "image", "footer")


def stage_rank(stage: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in STAGES]), stage)


def merge_text(pages: DataFrame, ocr: DataFrame, visual: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """The text blocks of each page: (doc_id, page, stage, source, text, confidence), plus rejected rows with stage 'rejected'.

    On scanned and garbled pages a visual reading replaces the native text; on garbled
    pages an OCR reading does if it is sure enough and is rejected if not. Elsewhere
    both follow the native text.
    """
    o = ocr.select("doc_id", "page", F.col("text").alias("ocr_text"), F.col("confidence").alias("ocr_confidence"))
    v = visual.select("doc_id", "page", F.col("text").alias("visual_text"))
    rows = pages.join(o, ["doc_id", "page"], "left").join(v, ["doc_id", "page"], "left")
    garbled, reread = F.col("page_class") == "garbled", F.col("page_class").isin("scanned", "garbled")
    has_visual, has_ocr = F.coalesce("visual_text", F.lit("")) != "", F.coalesce("ocr_text", F.lit("")) != ""
    sure = F.coalesce(F.col("ocr_confidence") >= min_confidence, F.lit(False))
    replaced_by_visual = reread & has_visual
    replaced_by_ocr = garbled & has_ocr & sure & ~replaced_by_visual
    rejected = garbled & has_ocr & ~sure & ~replaced_by_visual
    part = lambda stage, source, text, confidence: F.struct(F.lit(stage).alias("stage"), F.lit(source).alias("source"), text.alias("text"), confidence.cast("double").alias("confidence"))
    none = F.lit(None)
    native = F.when((F.coalesce("text", F.lit("")) != "") & ~replaced_by_visual & ~replaced_by_ocr, part("text", "native", F.col("text"), none))
    as_visual = F.when(replaced_by_visual, part("text", "visual", F.col("visual_text"), none)).when(has_visual, part("visual", "visual", F.col("visual_text"), none))
    as_ocr = (
        F.when(replaced_by_ocr, part("text", "ocr", F.col("ocr_text"), F.col("ocr_confidence")))
        .when(rejected, part("rejected", "ocr", F.col("ocr_text"), F.col("ocr_confidence")))
        .when(has_ocr & ~replaced_by_visual, part("ocr", "ocr", F.col("ocr_text"), F.col("ocr_confidence")))
    )
    return rows.select("doc_id", "page", F.explode(F.array_compact(F.array(native, as_visual, as_ocr))).alias("b")).select("doc_id", "page", "b.*")


def swap_warnings(warnings: DataFrame, rejected: DataFrame) -> DataFrame:
    """On pages whose OCR reading was rejected, that warning takes the place of the one that it was applied."""
    pages = rejected.select("doc_id", "page").distinct()
    stay = warnings.where("code <> 'OCR_APPLIED'").unionByName(warnings.where("code = 'OCR_APPLIED'").join(pages, ["doc_id", "page"], "left_anti"))
    return stay.unionByName(rejected.select("doc_id", "page", F.lit("OCR_REJECTED_LOW_CONFIDENCE").alias("code"), "confidence"), allowMissingColumns=True)


def merge_tables(native: DataFrame, visual: DataFrame) -> DataFrame:
    """Native tables always; the visual model's only on pages that have none."""
    own = native.withColumn("stage", F.lit("native_table"))
    other = visual.join(native.select("doc_id", "page").distinct(), ["doc_id", "page"], "left_anti").withColumn("stage", F.lit("visual_table"))
    return own.unionByName(other, allowMissingColumns=True)


def assemble_units(blocks: DataFrame) -> DataFrame:
    """(doc_id, unit, content): each unit's blocks (stage, ord, type, text) in order; empty text blocks are dropped."""
    fine = blocks.where("not (type = 'text' and coalesce(trim(text), '') = '')")
    item = F.struct(stage_rank(F.col("stage")).alias("rank"), "ord", "type", "text")
    content = F.transform(F.array_sort(F.collect_list(item)), lambda b: F.struct(b["type"].alias("type"), b["text"].alias("text")))
    return fine.groupBy("doc_id", "unit").agg(content.alias("content"))


def assemble_documents(units: DataFrame) -> DataFrame:
    """(doc_id, pages, units): the nested model, units renumbered from 1."""
    ordered = F.array_sort(F.collect_list(F.struct("unit", "content")))
    numbered = F.transform(ordered, lambda u, i: F.struct((i + 1).cast("int").alias("unit"), u["content"].alias("content")))
    return units.groupBy("doc_id").agg(F.count("*").alias("pages"), numbered.alias("units"))
