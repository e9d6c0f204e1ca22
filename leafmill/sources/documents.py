"""Directories of mixed files as blocks, documents and warnings; one row per file whatever happens to it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import normalize
from leafmill.operators.assembly import Readings
from leafmill.operators.guards import MAX_FILE_BYTES, route, unique_stems
from leafmill.operators.tables import MAX_CELLS, cell_count
from leafmill.runtime import ship_package
from leafmill.sources.pages import extract_pages

EXTRACTED = (
    "path string, source_type string, author string, title string, error_category string, error string, warnings array<struct<code:string,detail:string>>, "
    "units array<struct<unit:int,unit_type:string,title:string,image_count:int,blocks:array<struct<type:string,text:string,rows:array<array<string>>,level:int,source:string>>>>"
)


def scan_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, content, suffix, reader, output_stem) of the supported files directly in a folder."""
    files = spark.read.format("binaryFile").load(folder)
    return unique_stems(route(files).where(F.col("reader").isNotNull()))


def _within_cells(extracted: DataFrame, most: int) -> DataFrame:
    """Files with a table of more cells than that, of whatever format, become failures."""
    tables_of = lambda u: F.transform(F.coalesce(u["blocks"], F.array()), lambda b: cell_count(F.coalesce(b["rows"], F.expr("cast(array() as array<array<string>>)"))))
    largest = F.array_max(F.flatten(F.transform("units", tables_of)))
    over = F.coalesce(F.col("largest") > most, F.lit(False))
    rows = extracted.withColumn("largest", largest)
    instead = {"error_category": F.lit("resource_limit"), "error": F.format_string("a table of %d cells", "largest"), "units": F.slice("units", 1, 0), "warnings": F.slice("warnings", 1, 0)}
    return rows.withColumns({c: F.when(over, new).otherwise(F.col(c)) for c, new in instead.items()}).select(*extracted.columns)


def extract(files: DataFrame, max_bytes: int = MAX_FILE_BYTES, readings: Readings | None = None, max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per file: its units with raw blocks, or the category of its failure.

    ``readings`` is what was read from the pictures of PDF files, named by their paths.

    Files over the limit are refused by a filter on length, before their content is read.
    PDF files go page by page through ``assembly``; a stream of files refuses them, as that
    counts over all pages of a file.
    """
    ship_package(files.sparkSession)
    paged = None
    if not files.isStreaming:
        papers = files.where((F.col("reader") == "pdf") & (F.col("length") <= max_bytes))
        if not papers.select("path").isEmpty():
            paged = extract_pages(papers, readings)
            files = files.where((F.col("reader") != "pdf") | (F.col("length") > max_bytes))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from leafmill.sources.parsers import Refused, parse

        for batch in batches:
            rows = []
            for path, reader, suffix, content in zip(batch.path, batch.reader, batch.suffix, batch.content):
                kind = suffix[1:] if reader == "xlsx" else reader
                try:
                    got = parse(reader, suffix, bytes(content))
                    units = [
                        {"unit": i + 1, "unit_type": u[0], "title": u[1], "image_count": u[2], "blocks": [dict(zip(("type", "text", "rows", "level", "source"), b)) for b in u[3]]}
                        for i, u in enumerate(got.units)
                    ]
                    rows.append((path, kind, got.author, got.title, None, None, [{"code": c, "detail": d} for c, d in got.warnings], units))
                except Refused as why:
                    rows.append((path, kind, "", "", why.category, str(why), [], []))
                except (ValueError, KeyError, IndexError, EOFError, OSError) as why:
                    rows.append((path, kind, "", "", "malformed", f"{type(why).__name__}: {why}", [], []))
            yield pd.DataFrame(rows, columns=["path", "source_type", "author", "title", "error_category", "error", "warnings", "units"])

    small = files.where(F.col("length") <= max_bytes).select("path", "reader", "suffix", "content").mapInPandas(run, EXTRACTED)
    large = files.where(F.col("length") > max_bytes).select(
        "path", F.col("reader").alias("source_type"), F.lit("").alias("author"), F.lit("").alias("title"), F.lit("resource_limit").alias("error_category"),
        F.format_string("%d bytes", "length").alias("error"), F.expr("cast(array() as array<struct<code:string,detail:string>>)").alias("warnings"),
    )
    rest = small.unionByName(large, allowMissingColumns=True)
    return _within_cells(rest if paged is None else rest.unionByName(paged), max_cells)


def blocks(extracted: DataFrame) -> DataFrame:
    """(path, unit, unit_type, ord, type, content, rows, level, source), texts and every cell normalized in the JVM."""
    units = extracted.select("path", "source_type", F.explode("units").alias("u"))
    each = units.select("path", "source_type", "u.unit", "u.unit_type", F.posexplode("u.blocks").alias("ord", "b"))
    keeps = F.col("source_type") == "md"
    text = F.when(keeps, normalize(F.col("b.text"), preserve_layout=True)).otherwise(normalize(F.col("b.text")))
    rows = F.transform("b.rows", lambda r: F.transform(r, lambda c: normalize(F.coalesce(c, F.lit("")), repaired=False)))
    out = each.select("path", "unit", "unit_type", "ord", "b.type", text.alias("content"), rows.alias("rows"), "b.level", "b.source")
    return out.where("type not in ('text', 'heading') or content <> ''")
