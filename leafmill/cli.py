"""A folder of files in; JSON, Markdown and notes out, with a summary and an exit code."""

from __future__ import annotations

import argparse
import logging
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.render import describe
from leafmill.operators import report
from leafmill.operators.guards import MAX_FILE_BYTES
from leafmill.runtime import cut
from leafmill.sources import committed, documents, sinks

log = logging.getLogger("leafmill")


def _name() -> Column:
    return F.regexp_extract("path", "([^/]+)$", 1)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="leafmill", description="Extract documents to JSON and Markdown.")
    parser.add_argument("--input", dest="input_dir", default="input", help="folder of input files (any file system Spark reads)")
    parser.add_argument("--output", dest="output_dir", default="output", help="folder that gets json/ and markdown/; shared between executors")
    parser.add_argument("--log-file", default="logs/extraction.log", help="log file on the driver")
    parser.add_argument("--max-file-mb", type=int, default=MAX_FILE_BYTES // (1024 * 1024), help="larger files are refused without being read")
    parser.add_argument("--verbose", "-v", action="store_true", help="log at debug level")
    return parser


def notes(extracted: DataFrame) -> DataFrame:
    """(path, notes): the sidecar body of every file with warnings."""
    warned = extracted.select("path", F.posexplode("warnings").alias("ord", "w"))
    none = lambda kind: F.lit(None).cast(kind)
    said = warned.select(F.col("path").alias("doc_id"), "ord", describe(F.col("w.code"), none("int"), none("double"), F.col("w.detail"), none("map<string,string>")).alias("note"))
    return report.notes_text(said).select(F.col("doc_id").alias("path"), F.concat(F.lit("# Extraction Notes\n\n"), "notes", F.lit("\n")).alias("notes"))


def statistics(extracted: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row per file: filename, source_type, ok, units, text_blocks, table_blocks, image_count, error_category, error."""
    counted = blocks.groupBy("path").agg(F.count_if(F.col("type") == "text").alias("text_blocks"), F.count_if(F.col("type") == "table").alias("table_blocks"))
    images = F.aggregate(F.coalesce("units", F.array()), F.lit(0), lambda n, u: n + F.coalesce(u["image_count"], F.lit(0)))
    files = extracted.select("path", _name().alias("filename"), "source_type", F.col("error_category").isNull().alias("ok"), F.coalesce(F.size("units"), F.lit(0)).alias("units"), images.alias("image_count"), "error_category", "error")
    return files.join(counted, "path", "left").na.fill(0, ["text_blocks", "table_blocks"])


def run(spark: SparkSession, input_dir: str, output_dir: str, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Extract every supported file of a folder, write its outputs, and return its row of ``statistics``."""
    return extract_folder(spark, input_dir, output_dir, max_bytes)[0]


def warnings_of(extracted: DataFrame) -> DataFrame:
    """(filename, code, formulas, detail, note) of every warning of the files that went through."""
    none = lambda kind: F.lit(None).cast(kind)
    warned = extracted.where("error_category is null").select(_name().alias("filename"), F.explode("warnings").alias("w"))
    note = describe(F.col("w.code"), none("int"), none("double"), F.col("w.detail"), none("map<string,string>"))
    return warned.select("filename", "w.code", none("int").alias("formulas"), "w.detail", note.alias("note"))


def extract_folder(spark: SparkSession, input_dir: str, output_dir: str, max_bytes: int = MAX_FILE_BYTES) -> tuple[DataFrame, DataFrame]:
    """As ``run``, with the warnings of all files beside their statistics.

    Each file is parsed once: the parsed rows go through the shared checkpoint folder and feed
    all sinks. A file that fails is a row with its category; the others are written all the same.
    Notes that an earlier run left beside a file that is clean now are removed.
    """
    files = documents.scan_files(spark, input_dir)
    stems = files.select("path", "output_stem")
    extracted = cut(documents.extract(files, max_bytes))
    blocks = cut(documents.blocks(extracted))
    named = lambda rows, body, end: rows.join(stems, "path").select(F.concat("output_stem", F.lit(end)).alias("name"), F.col(body).alias("body"))
    models = sinks.documents_json(extracted, blocks).withColumn("model", sinks.indented_json("model"))
    good = extracted.where("error_category is null")
    units = good.select("path", F.explode("units").alias("u")).select("path", "u.unit", "u.unit_type", "u.title")
    drawn = sinks.block_markdown(blocks).select("path", "unit", "ord", "md")
    whole = units.join(drawn, ["path", "unit"], "left").withColumnRenamed("path", "doc_id")
    markdown = sinks.documents_markdown(whole, good.select(F.col("path").alias("doc_id"), _name().alias("filename"))).withColumnRenamed("doc_id", "path")
    committed.write_files(named(models, "model", ".json"), f"{output_dir}/json")
    sidecars = good.select("path").join(notes(extracted), "path", "left")  # a null body removes what an earlier run left
    for rows, body, end in ((markdown, "markdown", ".md"), (sidecars, "notes", ".notes.md")):
        committed.write_files(named(rows, body, end), f"{output_dir}/markdown")
    return statistics(extracted, blocks), warnings_of(extracted)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0: every file went through or there was none; 1: some failed; 2: no such input folder."""
    given = arguments().parse_args(argv)
    Path(given.log_file).parent.mkdir(parents=True, exist_ok=True)
    handlers = [logging.StreamHandler(), logging.FileHandler(given.log_file, encoding="utf-8")]
    for handler in handlers:
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(handler)
    log.setLevel(logging.DEBUG if given.verbose else logging.INFO)
    try:
        spark = spark or SparkSession.builder.appName("leafmill").getOrCreate()
        try:
            files, warnings = map(cut, extract_folder(spark, given.input_dir, given.output_dir, given.max_file_mb * 1024 * 1024))
        except AnalysisException as why:
            if why.getCondition() != "PATH_NOT_FOUND":
                raise
            log.error("Input folder does not exist: %s", given.input_dir)
            return report.exit_code(0, 0, has_input=False)
        total = files.agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("failed"), *[F.sum(F.when(F.col("ok"), F.col(c)).otherwise(0)).alias(c) for c in ("units", "text_blocks", "table_blocks", "image_count")]).first()
        if not total.n:
            log.info("No supported files found in %s", given.input_dir)
            return report.exit_code(0, 0)
        log.info("%d file(s): %d succeeded, %d failed", total.n, total.n - total.failed, total.failed)
        for row in report.summary_lines(files).orderBy("part", "filename").toLocalIterator():
            log.info("  %s", row.line)
        log.info("Totals: %d units, %d text block(s), %d table block(s), %d image(s)", total.units, total.text_blocks, total.table_blocks, total.image_count)
        for row in report.rollup_lines(warnings).orderBy("ord", "line").toLocalIterator():
            log.info("%s", row.line)
        return report.exit_code(total.n, total.failed)
    finally:
        for handler in handlers:
            log.removeHandler(handler)
            handler.close()
