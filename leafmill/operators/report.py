"""Per-file statistics, the run summary and the warning roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Warnings after which a page counts as unreadable.
UNREADABLE = ("OCR_UNAVAILABLE", "OCR_SKIPPED_DISABLED", "OCR_MODEL_INCOMPATIBLE", "OCR_FAILED", "OCR_REJECTED_LOW_CONFIDENCE")
#: Those of them that a model would mend.
INSTALLABLE = ("OCR_UNAVAILABLE", "OCR_MODEL_INCOMPATIBLE")


def file_stats(blocks: DataFrame, warnings: DataFrame) -> DataFrame:
    """Counters per document; a document without warnings has zeros."""
    by_block = blocks.groupBy("doc_id").agg(
        F.countDistinct("unit").alias("units"), F.count_if(F.col("type") == "text").alias("text_blocks"), F.count_if(F.col("type") == "table").alias("table_blocks"), F.count_if(F.col("type") == "image").alias("images")
    )
    code = F.col("code")
    by_warning = warnings.groupBy("doc_id").agg(
        F.count_if(code.isin("OCR_APPLIED", "OCR_LOW_CONFIDENCE", "OCR_MIXED_CONFIDENCE")).alias("ocr_pages"),
        F.count_if(code == "VLM_APPLIED").alias("visual_pages"),
        F.sum(F.when(code == "VLM_APPLIED", F.coalesce("formulas", F.lit(0))).otherwise(0)).alias("formulas"),
        F.count_if(code.isin(*UNREADABLE)).alias("unreadable_pages"),
    )
    return by_block.join(by_warning, "doc_id", "left").na.fill(0)


def run_summary(files: DataFrame) -> DataFrame:
    """Counts per source type with the run's totals as the roll-up row (source_type null)."""
    return files.rollup("source_type").agg(
        F.count("*").alias("files"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"),
        F.sum(F.when(F.col("ok"), F.col("text_blocks")).otherwise(0)).alias("text_blocks"), F.sum(F.when(F.col("ok"), F.col("table_blocks")).otherwise(0)).alias("table_blocks"),
    )


def summary_lines(files: DataFrame) -> DataFrame:
    """(ord, line): one line per succeeded file, then one per failed file."""
    units, images = (F.col(c) if c in files.columns else F.lit(0) for c in ("units", "image_count"))
    good = F.format_string("[OK]   %s (%s): %d unit(s), %d text, %d table, %d image(s)", "filename", "source_type", units, "text_blocks", "table_blocks", images)
    bad = F.format_string("[FAILED] %s: %s", F.col("filename"), F.coalesce("error", F.lit("unknown error")))
    return files.select((~F.col("ok")).cast("int").alias("part"), "filename", F.when(F.col("ok"), good).otherwise(bad).alias("line"))


def distinct_notes(notes: DataFrame) -> DataFrame:
    """The distinct sentences of each document, first seen first: (doc_id, note, ord)."""
    first = Window.partitionBy("doc_id", "note").orderBy("ord")
    return notes.withColumn("seen", F.row_number().over(first)).where("seen = 1").select("doc_id", "note", "ord")


def notes_text(notes: DataFrame) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("ord", "note")))
    return distinct_notes(notes).groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda n: F.concat(F.lit("- "), n["note"])), "\n").alias("notes"))


def rollup_lines(warnings: DataFrame) -> DataFrame:
    """(ord, line): what the run could not read, from warnings (filename, code, page, formulas, detail, note); no rows if all went well.

    Recognized and visually read pages first, then why the visual model could not run, then the
    number of unreadable pages with each distinct note, and last what would help.
    """
    code = F.col("code")
    total = warnings.agg(
        F.count_if(code.isin("OCR_APPLIED", "OCR_LOW_CONFIDENCE", "OCR_MIXED_CONFIDENCE")).alias("ocr"),
        F.count_if(code == "VLM_APPLIED").alias("visual"),
        F.coalesce(F.sum(F.when(code == "VLM_APPLIED", F.coalesce("formulas", F.lit(0)))), F.lit(0)).alias("formulas"),
        F.array_sort(F.collect_set(F.when(code == "VLM_UNAVAILABLE", F.coalesce("detail", F.lit(""))))).alias("missing"),
        F.count_if(code.isin(*UNREADABLE)).alias("unread"),
        F.count_if(code.isin(*INSTALLABLE)).alias("installable"),
    )
    why = F.array_join(F.filter("missing", lambda d: d != ""), "; ")
    heads = F.array(
        F.when(F.col("ocr") > 0, F.struct(F.lit(0).alias("ord"), F.format_string("Recognition recovered text on %d page(s).", "ocr").alias("line"))),
        F.when(F.col("visual") > 0, F.struct(F.lit(1).alias("ord"), F.format_string("The visual model read %d page(s), recovering %d formula(s).", "visual", "formulas").alias("line"))),
        F.when(F.size("missing") > 0, F.struct(F.lit(2).alias("ord"), F.concat(F.lit("The visual model is unavailable: "), why).alias("line"))),
        F.when(F.col("unread") > 0, F.struct(F.lit(3).alias("ord"), F.format_string("%d page(s) could not be extracted:", "unread").alias("line"))),
        F.when(F.col("installable") > 0, F.struct(F.lit(5).alias("ord"), F.lit("  Fix: put a detection and a recognition .onnx model with its dictionary into models/ocr").alias("line"))),
    )
    notes = warnings.where(code.isin(*UNREADABLE)).select(F.lit(4).alias("ord"), F.format_string("  - %s: %s", "filename", "note").alias("line")).distinct()
    return total.select(F.explode(F.array_compact(heads)).alias("h")).select("h.ord", "h.line").unionByName(notes)


def exit_code(found: int, failed: int, has_input: bool = True) -> int:
    return 2 if not has_input else 1 if found and failed else 0
