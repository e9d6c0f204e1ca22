"""Limits, format signatures, routing, names and error categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
MAX_FILE_BYTES, MAX_ROWS, MAX_CELLS = 100 * 1024 * 1024, 500_000, 5_000_000
READERS = {
    ".pdf": "pdf", ".csv": "csv", ".docx": "docx", ".xlsx": "xlsx", ".xlsm": "xlsx", ".txt": "txt", ".md": "md", ".html": "html", ".htm": "html", ".pptx": "pptx",
    ".json": "json", ".xml": "xml", ".png": "image", ".jpg": "image", ".jpeg": "image", ".tif": "image", ".tiff": "image", ".bmp": "image",
}


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def route(files: DataFrame) -> DataFrame:
    """Adds suffix and reader (null: unsupported)."""
    table = F.create_map(*[F.lit(x) for pair in READERS.items() for x in pair])
    return files.withColumn("suffix", suffix(F.col("path"))).withColumn("reader", F.try_element_at(table, F.col("suffix")))


def size_guard(files: DataFrame, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Adds ok; a file of just the limit passes. A filter on length is pushed into the file scan, which then reads no content."""
    return files.withColumn("ok", F.col("length") <= max_bytes)


def package_kind(content: Column, file_suffix: Column) -> Column:
    """What the first bytes say a file is."""
    head = F.hex(F.substring(content, 1, 512))
    zipped = F.when(file_suffix == ".docx", "docx").when(file_suffix.isin(".xlsx", ".xlsm"), "xlsx").when(file_suffix == ".pptx", "pptx")
    starts = lambda b: F.startswith(head, F.lit(b.hex().upper()))
    return F.when(starts(b"%PDF-"), "pdf").when(starts(b"{\\rtf"), "rtf").when(starts(bytes.fromhex("d0cf11e0a1b11ae1")), "ole").when(starts(b"PK"), zipped)


def error_category(kind: Column, message: Column) -> Column:
    """The stable category of a failure, from the exception's class name and message."""
    low = F.lower(F.coalesce(message, F.lit("")))
    package = F.when(low.rlike("encrypted|password"), "encrypted").when(low.rlike("missing|not found|no such file"), "missing_part").otherwise("malformed")
    return (
        F.when(kind.isin("ResourceLimitError", "LimitError"), "resource_limit")
        .when((kind == "ValueError") & F.startswith(low, F.lit("unsupported file type:")), "unsupported")
        .when(kind.isin("FileNotFoundError", "PermissionError"), "io")
        .when(kind.isin("BadZipFile", "error", "ParseError", "EOFError"), package)
        .when(kind.isin("JSONDecodeError", "ValueError"), "malformed")
        .when(kind.isin("OSError", "IOError"), "io")
        .otherwise("unknown")
    )


def workbook_guard(sheets: DataFrame) -> DataFrame:
    """(doc_id, rows, cells, ok) from declared sheet dimensions."""
    total = sheets.groupBy("doc_id").agg(F.sum("rows").alias("rows"), F.sum(F.col("rows") * F.col("cols")).alias("cells"))
    return total.withColumn("ok", (F.col("rows") <= MAX_ROWS) & (F.col("cells") <= MAX_CELLS))


def effective_dpi(width: Column, height: Column, requested: Column, max_pixels: int = 25_000_000) -> Column:
    """The resolution at which a page (in points) stays within the pixel budget; 72 at least."""
    inches = width * height / (72.0 * 72.0)
    return F.when(inches <= 0, requested).otherwise(F.greatest(F.lit(72), F.least(requested, F.floor(F.sqrt(max_pixels / inches)).cast("int"))))


def unique_stems(files: DataFrame) -> DataFrame:
    """Adds output_stem: the stem, or stem-extension where several files share it."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")
    ext = F.regexp_extract(name, r".\.([^.]+)$", 1)
    rows = files.withColumn("_stem", stem).withColumn("_ext", F.lower(ext))
    shared = F.count("*").over(Window.partitionBy("_stem")) > 1
    return rows.withColumn("output_stem", F.when(shared & (F.col("_ext") != ""), F.concat_ws("-", "_stem", "_ext")).otherwise(F.col("_stem"))).drop("_stem", "_ext")


def figure_names(figures: DataFrame) -> DataFrame:
    """Adds name: page and running number; figures that failed take no number."""
    order = Window.partitionBy("doc_id", "page").orderBy("figure_no")
    return figures.where("ok").withColumn("name", F.format_string("p%03d_i%02d.png", F.col("page").cast("int"), F.row_number().over(order)))
