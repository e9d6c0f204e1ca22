"""PDF files as rows: one scan per file and a row per page, then frames of pages, words, lines and pictures."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.render import percent
from leafmill.operators.assembly import Readings, Scanned, assemble
from leafmill.operators.merge import stage_rank
from leafmill.runtime import cut, ship_package

_BOX = "x0:double,y0:double,x1:double,y1:double"
SCANNED = (
    "path string, author string, title string, error_category string, error string, page int, page_error string, width double, height double, "
    f"words array<struct<block_no:int,line_no:int,word_no:int,text:string,{_BOX},a:double,b:double>>, images array<struct<xref:int,{_BOX},pixels_x:int,pixels_y:int>>, "
    f"drawings array<struct<item:string,{_BOX}>>, fonts array<string>"
)
_CORNERS = ("x0", "y0", "x1", "y1")
_FILE = ("path", "author", "title", "error_category", "error")


def _page(page) -> dict:
    """A page's columns; one that could not be read keeps what was painted before the damage."""
    from leafmill.sources import pdf

    named = lambda names, rows: [dict(zip(names, row)) for row in rows]
    error = page.error
    try:
        said = pdf.words(page)
    except pdf.UNREADABLE as why:
        said, error = [], error or f"{type(why).__name__}: {why}"
    stored = lambda n: n if isinstance(n, int) and 0 <= n < 1 << 31 else None
    return {
        "page_error": error, "width": page.width, "height": page.height, "fonts": sorted(page.fonts),
        "words": named(("block_no", "line_no", "word_no", "text", *_CORNERS, "a", "b"), said),
        "images": [dict(zip(("xref", *_CORNERS), row[:5]), pixels_x=stored(row[5]), pixels_y=stored(row[6])) for row in page.images],
        "drawings": named(("item", *_CORNERS), page.drawings),
    }


def scan_files(files: DataFrame) -> DataFrame:
    """A row per page of each PDF file (path, content), or one row with the category of the file's failure. A file is read in one task."""
    ship_package(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from leafmill.sources import pdf
        from leafmill.sources.parsers import Refused

        columns = [c.split(" ")[0] for c in SCANNED.split(", ")]
        frame = lambda row: pd.DataFrame([dict.fromkeys(columns) | row], columns=columns, dtype=object)
        for batch in batches:
            for path, content in zip(batch.path, batch.content):
                failed = None
                try:
                    if not bytes(content[:1024]).lstrip().startswith(b"%PDF-"):
                        raise Refused("malformed", "not a PDF")
                    info, found = pdf.scan(bytes(content))
                except Refused as why:
                    failed = (why.category, str(why))
                except pdf.UNREADABLE as why:
                    failed = ("malformed", f"{type(why).__name__}: {why}")
                if failed:
                    yield frame({"path": path, "author": "", "title": "", "error_category": failed[0], "error": failed[1]})
                    continue
                for k, page in enumerate(found, 1):
                    yield frame({"path": path, "author": info["author"], "title": info["title"], "page": k, **_page(page)})

    return files.select("path", "content").mapInPandas(run, SCANNED)


def frames(scanned: DataFrame) -> Scanned:
    """The pages that ``assembly.assemble`` takes; a file is a document by its path."""
    each = scanned.where("page is not null").withColumnRenamed("path", "doc_id")
    return Scanned(each.select("doc_id", "page", "width", "height", "words", "images", "drawings", "fonts"))


def extract_pages(files: DataFrame, readings: Readings | None = None) -> DataFrame:
    """PDF files as the rows that ``documents.extract`` gives of other files: one unit a page, raw blocks, warnings."""
    scanned = cut(scan_files(files))
    made = assemble(frames(scanned), readings)
    block = F.struct(F.col("type"), F.coalesce("text", F.lit("")).alias("text"), F.col("rows"), F.lit(None).cast("int").alias("level"), F.col("source"))
    ordered = F.array_sort(F.collect_list(F.struct(stage_rank(F.col("stage")).alias("rank"), F.col("ord"), F.col("type"), block.alias("block"))))
    by_page = made.blocks.groupBy("doc_id", "page").agg(F.transform(ordered, lambda x: x["block"]).alias("blocks"))
    units = made.units.join(by_page, ["doc_id", "page"], "left")
    none = F.expr("cast(array() as array<struct<type:string,text:string,rows:array<array<string>>,level:int,source:string>>)")
    unit = F.struct(F.col("page").alias("unit"), F.lit("page").alias("unit_type"), F.lit(None).cast("string").alias("title"), F.col("image_count").cast("int").alias("image_count"), F.coalesce("blocks", none).alias("blocks"))
    units = units.groupBy(F.col("doc_id").alias("path")).agg(F.array_sort(F.collect_list(unit), lambda a, b: a["unit"] - b["unit"]).alias("units"))
    damaged = scanned.where("page_error is not null").select(F.col("path").alias("doc_id"), "page", F.lit("PAGE_UNREADABLE").alias("code"), F.col("page_error").alias("detail"))
    warnings = made.warnings.unionByName(damaged, allowMissingColumns=True)
    sure = F.when(F.col("confidence").isNotNull(), F.concat(F.lit("confidence "), percent(F.col("confidence"))))
    where = F.concat_ws("; ", F.concat(F.lit("page "), F.col("page")), sure, F.when(F.col("detail") != "", F.col("detail")))
    said = F.array_sort(F.collect_list(F.struct(F.coalesce("page", F.lit(0)).alias("page"), F.col("code"), where.alias("detail"))))
    warned = warnings.groupBy(F.col("doc_id").alias("path")).agg(F.transform(said, lambda w: F.struct(w["code"].alias("code"), w["detail"].alias("detail"))).alias("warnings"))
    out = scanned.select(*_FILE).dropDuplicates(["path"]).join(units, "path", "left").join(warned, "path", "left")
    empty = F.expr("cast(array() as array<struct<code:string,detail:string>>)")
    return out.select("path", F.lit("pdf").alias("source_type"), "author", "title", "error_category", "error", F.coalesce("warnings", empty).alias("warnings"), F.coalesce("units", F.array()).alias("units"))
