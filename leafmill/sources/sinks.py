"""Markdown, JSON and notes: rendered as columns, written one file per document on the executors."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.functions.render import gfm_table, unit_heading

# Lines that say where a text comes from.
VISUAL_LINE = "> Read from the page image by the visual model"
CHART_LINE = "> Chart data (native values from the file)"


def block_markdown(blocks: DataFrame) -> DataFrame:
    """Adds md: a heading, a table, an image, or a text under the line that names its source.

    ``source``, ``confidence`` and ``image_path`` may be absent. Page headers and footers and
    empty texts have a null md and are left out of documents.
    """
    optional = lambda name, kind: F.col(name) if name in blocks.columns else F.lit(None).cast(kind)
    source, kind, content = optional("source", "string"), F.col("type"), F.nullif(F.col("content"), F.lit(""))
    sure = F.bround(F.coalesce(optional("confidence", "double"), F.lit(0.0)) * 100, 0).cast("int").cast("string")
    origin = (
        F.when(source == "ocr", F.concat(F.lit("> Text recovered by OCR (confidence "), sure, F.lit("%)\n\n")))
        .when(source == "vlm", F.lit(f"{VISUAL_LINE}\n\n"))
        .when(source == "chart", F.lit(f"{CHART_LINE}\n\n"))
        .otherwise("")
    )
    hashes = F.repeat(F.lit("#"), F.least(F.lit(6), F.coalesce("level", F.lit(1)) + 2))
    md = (
        F.when(kind == "table", F.concat(F.lit("### Table\n\n"), gfm_table(F.col("rows"))))
        .when(kind == "heading", F.concat(hashes, F.lit(" "), F.col("content")))
        .when(kind == "image", F.concat(F.lit("![]("), optional("image_path", "string"), F.lit(")")))
        .when(kind == "text", F.concat(origin, content))
    )
    return blocks.withColumn("md", md)


def documents_markdown(blocks: DataFrame, names: DataFrame) -> DataFrame:
    """(doc_id, markdown) of blocks (doc_id, unit, unit_type, title, ord, md) and names (doc_id, filename).

    A unit without blocks is a row with a null md and shows its heading.
    """
    ordered = F.array_sort(F.collect_list(F.struct("ord", "md")))
    per_unit = blocks.groupBy("doc_id", "unit").agg(F.first("unit_type").alias("unit_type"), F.first("title").alias("title"), F.transform(ordered, lambda b: b["md"]).alias("parts"))
    heading = unit_heading(F.col("unit_type"), F.col("unit"), F.col("title"))
    drawn = per_unit.withColumn("md", F.array_join(F.concat(F.array(heading), F.col("parts")), "\n\n"))
    units = F.array_sort(F.collect_list(F.struct("unit", "md")))
    whole = drawn.groupBy("doc_id").agg(F.array_join(F.transform(units, lambda u: u["md"]), "\n\n---\n\n").alias("body"))
    text = F.concat(F.lit("# "), F.col("filename"), F.lit("\n\n"), F.coalesce("body", F.lit("")))
    return names.join(whole, "doc_id", "left").select("doc_id", F.concat(F.regexp_replace(text, r"\s+$", ""), F.lit("\n")).alias("markdown"))


def documents_json(extracted: DataFrame, blocks: DataFrame, version: str = "2.0") -> DataFrame:
    """(path, model): each succeeded file's nested model as compact JSON; absent keys are left out.

    ``extracted`` as read by the document readers, ``blocks`` the normalized blocks of the same files.
    """
    lone = F.nullif(F.nullif(F.col("source"), F.lit("")), F.lit("native"))
    is_table = F.col("type") == "table"
    # A table's content is its rows, any other block's its text: JSON of both kinds, put together as strings.
    plain = F.struct("type", "level", "content", lone.alias("source"))
    grid = F.struct("type", F.col("rows").alias("content"), lone.alias("source"))
    item = F.when(is_table, F.to_json(grid)).otherwise(F.to_json(plain))
    joined = lambda order, of: F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, of))), lambda x: x[of]), ","), F.lit("]"))
    content = blocks.select("path", "unit", "ord", item.alias("item")).groupBy("path", "unit").agg(joined("ord", "item").alias("content"))
    units = extracted.where("error_category is null").select("path", F.explode("units").alias("u")).select("path", "u.unit", "u.unit_type", "u.title", "u.image_count")
    head = F.to_json(F.struct("unit", "unit_type", (F.col("image_count") > 0).alias("has_images"), "image_count", F.nullif(F.col("title"), F.lit("")).alias("title")))
    opened = F.regexp_replace(head, r"\}$", "")
    body = F.concat(opened, F.lit(',"content":'), F.coalesce("content", F.lit("[]")), F.lit("}"))
    pages = units.join(content, ["path", "unit"], "left").select("path", "unit", body.alias("body")).groupBy("path").agg(joined("unit", "body").alias("pages"))
    images = F.aggregate("units", F.lit(0), lambda n, u: n + F.coalesce(u["image_count"], F.lit(0)))
    document = F.struct(
        F.regexp_extract("path", "([^/]+)$", 1).alias("filename"), "source_type", F.size("units").alias("pages"), F.coalesce("author", F.lit("")).alias("author"), F.coalesce("title", F.lit("")).alias("title"),
        (images > 0).alias("has_images"), images.alias("image_count"), F.lit(version).alias("schema_version"), F.when(F.size("warnings") > 0, F.col("warnings")).alias("warnings"),
    )
    documents = extracted.where("error_category is null").select("path", F.to_json(document).alias("document"))
    model = F.concat(F.lit('{"document":'), F.col("document"), F.lit(',"pages":'), F.coalesce("pages", F.lit("[]")), F.lit("}"))
    return documents.join(pages, "path", "left").select("path", model.alias("model"))


@F.pandas_udf(T.StringType())
def indented_json(compact: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Compact JSON laid out with two spaces, non-ASCII kept."""
    for part in compact:
        yield part.map(lambda t: None if t is None else json.dumps(json.loads(t), ensure_ascii=False, indent=2))
