"""Which detected grids are tables; merged and vertical cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import strip
from leafmill.operators import spatial
from leafmill.operators.geometry import centres, is_vertical
from leafmill.operators.spatial import CORNERS

# Fixed values.
LEAST_FILL, MEDIAN_LENGTH, SAME_ROWS, MAX_CELLS, WORD_GAP = 0.2, 120, 3, 5_000_000, 1.5


def clean_rows(rows: Column) -> Column:
    return F.transform(rows, lambda r: F.transform(r, lambda c: F.coalesce(c, F.lit(""))))


def cell_count(rows: Column) -> Column:
    return F.aggregate(rows, F.lit(0), lambda n, r: n + F.size(r))


def rows_all_identical(rows: Column) -> Column:
    """Three data rows or more, all the same."""
    data = F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))
    return (F.size(data) >= SAME_ROWS) & (F.size(F.array_distinct(data)) == 1)


def _median(lengths: Column) -> Column:
    n = F.size(lengths)
    ordered = F.array_sort(lengths)
    return (F.try_element_at(ordered, F.floor((n + 1) / 2).cast("int")) + F.try_element_at(ordered, F.ceil((n + 1) / 2).cast("int"))) / 2


def is_real_table(rows: Column) -> Column:
    """Two rows and columns, enough filled cells, short cells, and rows that differ."""
    cells = F.flatten(rows)
    filled = F.filter(F.transform(cells, lambda c: strip(F.coalesce(c, F.lit("")))), lambda c: c != "")
    total = cell_count(rows)
    shape = (F.size(rows) >= 2) & (F.array_max(F.transform(rows, F.size)) >= 2)
    dense = (total > 0) & (F.size(filled) >= LEAST_FILL * total)
    short = F.coalesce(_median(F.transform(filled, F.length)) < MEDIAN_LENGTH, F.lit(False))
    return F.coalesce(shape & dense & short & ~rows_all_identical(rows), F.lit(False))


def suppress_merged(cells: DataFrame) -> DataFrame:
    """Cells (…, row, col, cell_id, text) where a repetition of the cell to the left reads empty."""
    row = Window.partitionBy("doc_id", "table_no", "row").orderBy("col")
    return cells.withColumn("text", F.when(F.lag("cell_id").over(row) == F.col("cell_id"), "").otherwise(F.col("text")))


def chart_rows(points: DataFrame) -> DataFrame:
    """Native charts (doc_id, chart_no, series_no, series, category_no, category, value) as tables."""
    text = F.when(F.col("value").isNull(), "").when(F.col("value") == F.floor("value"), F.col("value").cast("long").cast("string")).otherwise(F.col("value").cast("string"))
    by_row = points.groupBy("doc_id", "chart_no", "category_no").agg(
        F.min("category").alias("category"), F.transform(F.array_sort(F.collect_list(F.struct("series_no", text.alias("t")))), lambda s: s["t"]).alias("values")
    )
    body = by_row.groupBy("doc_id", "chart_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("category_no", F.concat(F.array(F.coalesce("category", F.lit(""))), F.col("values")).alias("r")))), lambda s: s["r"]).alias("body"))
    names = points.select("doc_id", "chart_no", "series_no", "series").distinct().groupBy("doc_id", "chart_no")
    head = names.agg(F.transform(F.array_sort(F.collect_list(F.struct("series_no", "series"))), lambda s: s["series"]).alias("names"))
    return head.join(body, ["doc_id", "chart_no"]).select("doc_id", "chart_no", F.concat(F.array(F.concat(F.array(F.lit("")), F.col("names"))), F.col("body")).alias("rows"))


CELL = ["doc_id", "page", "table_no", "row", "col"]


def in_cells(cells: DataFrame, chars: DataFrame) -> DataFrame:
    """The characters (or words) with the cells (doc_id, page, table_no, row, col, corners) that hold their centre."""
    marks = chars.withColumnsRenamed({c: f"own_{c}" for c in CORNERS}).withColumns({c: F.col(f"own_{c}") for c in CORNERS})
    pairs = spatial.touching(centres(marks), cells.where("x0 <= x1 and y0 <= y1").select(*CELL, *CORNERS), "c_")
    return pairs.drop(*CORNERS, *[f"c_{c}" for c in CORNERS]).withColumnsRenamed({f"own_{c}": c for c in CORNERS} | {"c_table_no": "table_no", "c_row": "row", "c_col": "col"})


def sideways(inside: DataFrame) -> DataFrame:
    """(cell, read): the text of cells of which most characters run up or down; those at one rounded x form a line."""
    whole = Window.partitionBy(*CELL)
    n = F.count("*").over(whole)
    turned = inside.withColumns({
        "sideways": F.count_if(is_vertical(F.col("a"), F.col("b"))).over(whole) * 2 > n,
        "up": F.count_if(F.col("b") > 0).over(whole) * 2 >= n,
    }).where("sideways")
    sign = F.when(F.col("up"), -1).otherwise(1)
    turned = turned.select(*CELL, "char_no", "text", "y0", "y1", "up", (F.bround("x0", 0) * -sign).alias("line"), (F.col("y0") * sign).alias("along"))
    before = Window.partitionBy(*CELL, "line").orderBy("along", "char_no")
    gap = F.when(F.col("up"), F.lag("y0").over(before) - F.col("y1")).otherwise(F.col("y0") - F.lag("y1").over(before))
    spaced = turned.withColumn("text", F.when(gap > WORD_GAP, F.concat(F.lit(" "), F.col("text"))).otherwise(F.col("text")))
    run = F.array_sort(F.collect_list(F.struct("along", "char_no", "text")))
    by_line = spaced.groupBy(*CELL, "line").agg(strip(F.array_join(F.transform(run, lambda c: c["text"]), "")).alias("text"))
    return by_line.groupBy(*CELL).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda t: t["text"]), "\n").alias("read"))


def vertical_cells(cells: DataFrame, chars: DataFrame) -> DataFrame:
    """Cells with sideways text read in its own direction; the others keep theirs.

    cells: doc_id, page, table_no, row, col, x0, top, x1, bottom, text. chars: doc_id, page,
    char_no, x0, top, x1, bottom, a, b, text, a and b from the text matrix.
    """
    edges = {"top": "y0", "bottom": "y1"}
    read = sideways(in_cells(cells.withColumnsRenamed(edges), chars.withColumnsRenamed(edges)))
    return cells.join(read, CELL, "left").withColumn("text", F.coalesce("read", "text")).drop("read")


def debris(rows: Column) -> Column:
    """struct(lines, fragments): the non-empty lines of a table's cells, and those of one or two characters."""
    lines = F.filter(F.transform(F.flatten(F.transform(F.flatten(clean_rows(rows)), lambda c: F.split(c, "\n"))), strip), lambda t: t != "")
    return F.struct(F.size(lines).alias("lines"), F.size(F.filter(lines, lambda t: F.length(t) <= 2)).alias("fragments"))
