"""Columns that read the visual model's page markup: truncation, blocks, cell grids and formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import strip

# The tags of the markup.
PROSE_TAGS = ("text", "section_header_level_1", "list_item", "caption", "other")
DROPPED_TAGS = ("page_header", "page_footer")
PAIRED_TAGS = ("doctag", "unordered_list", "ordered_list", "group", "picture", "otsl", "formula", "text", "section_header_level_1", "list_item", "caption", "page_header", "page_footer")
CONTAINERS = "</?(?:doctag|unordered_list|ordered_list|group)>"
SPAN_CELLS = ("lcel", "ucel", "xcel")


def strip_locations(raw: Column) -> Column:
    return F.regexp_replace(raw, r"<loc_\d+>", "")


def is_truncated(raw: Column) -> Column:
    """No closing page tag, or a paired tag opened more or less often than closed."""
    body = strip_locations(raw)
    uneven = F.lit(False)
    for tag in PAIRED_TAGS:
        uneven = uneven | (F.regexp_count(body, F.lit(f"<{tag}>")) != F.regexp_count(body, F.lit(f"</{tag}>")))
    return ~F.endswith(strip(raw), F.lit("</doctag>")) | uneven


def braces_balanced(latex: Column) -> Column:
    """Every brace closes and none closes early; escaped braces do not count."""
    only = F.split(F.regexp_replace(F.regexp_replace(latex, r"(?<=\\)[{}]", ""), "[^{}]", ""), "")
    start = F.struct(F.lit(0).alias("depth"), F.lit(True).alias("fine"))

    def step(acc: Column, brace: Column) -> Column:
        depth = acc["depth"] + F.when(brace == "{", 1).when(brace == "}", -1).otherwise(0)
        return F.struct(depth.alias("depth"), (acc["fine"] & (depth >= 0)).alias("fine"))

    return F.aggregate(only, start, step, lambda acc: acc["fine"] & (acc["depth"] == 0))


def formula_balanced(latex: Column) -> Column:
    left = F.regexp_count(latex, F.lit(r"\\left(?![A-Za-z])"))
    right = F.regexp_count(latex, F.lit(r"\\right(?![A-Za-z])"))
    return (left == right) & braces_balanced(latex)


def display_math(latex: Column) -> Column:
    """A displayed formula; rows and alignment marks outside any environment get one."""
    body = strip(latex)
    bare = (F.contains(body, F.lit("&")) | F.contains(body, F.lit("\\\\"))) & ~body.rlike(r"\\begin\s*\{")
    rows = F.regexp_replace(F.regexp_replace(body, r"\\\\\s*$", ""), r"\s+$", "")
    aligned = F.concat(F.lit("\\begin{aligned}\n"), rows, F.lit("\n\\end{aligned}"))
    return F.concat(F.lit("$$\n"), F.when(bare, aligned).otherwise(body), F.lit("\n$$"))


def unsupported_numbers(latex: Column, page_text: Column) -> Column:
    """Numbers of two digits or more that the page's own digits do not hold."""
    numbers = F.regexp_extract_all(F.regexp_replace(latex, r"\s+", ""), F.lit(r"(\d+(?:[.,]\d+)?)"), F.lit(1))
    known = F.regexp_replace(page_text, r"\D", "")

    def missing(n: Column) -> Column:
        digits = F.regexp_replace(n, r"\D", "")
        return (F.length(digits) >= 2) & ~F.contains(known, digits)

    return F.filter(numbers, missing)


def blocks(raw: Column) -> Column:
    """array<struct<tag, body>> of the page's blocks in order."""
    inner = F.regexp_replace(strip_locations(raw), CONTAINERS, "")
    pattern = r"(?s)<(\w+)>(.*?)</\1>"
    tags = F.regexp_extract_all(inner, F.lit(pattern), F.lit(1))
    bodies = F.regexp_extract_all(inner, F.lit(pattern), F.lit(2))
    return F.transform(F.arrays_zip(tags.alias("tag"), bodies.alias("body")), lambda b: F.struct(b["tag"].alias("tag"), strip(b["body"]).alias("body")))


def prose(raw: Column) -> Column:
    """The page's prose and its sound formulas, one blank line between blocks."""
    kept = F.filter(blocks(raw), lambda b: (b["tag"].isin(*PROSE_TAGS) & (b["body"] != "")) | ((b["tag"] == "formula") & formula_balanced(b["body"])))
    return F.array_join(F.transform(kept, lambda b: F.when(b["tag"] == "formula", display_math(b["body"])).otherwise(b["body"])), "\n\n")


def formulas(raw: Column) -> Column:
    """array<string> of the page's sound formulas, displayed."""
    sound = F.filter(blocks(raw), lambda b: (b["tag"] == "formula") & formula_balanced(b["body"]))
    return F.transform(sound, lambda b: display_math(b["body"]))


def dropped_formulas(raw: Column) -> Column:
    """How many formulas of the page do not close."""
    return F.size(F.filter(blocks(raw), lambda b: (b["tag"] == "formula") & ~formula_balanced(b["body"])))


def page_tables(raw: Column) -> Column:
    """array<array<array<string>>>: the rows of the page's cell grids."""
    return F.filter(F.transform(F.filter(blocks(raw), lambda b: b["tag"] == "otsl"), lambda b: otsl_rows(b["body"])), lambda t: F.size(t) > 0)


def otsl_rows(body: Column) -> Column:
    """array<array<string>> of a cell grid; spanned cells are empty, rows without cells are dropped."""
    pattern = r"<(ched|fcel|ecel|rhed|lcel|ucel|xcel)>([^<]*)"

    def row(line: Column) -> Column:
        kinds = F.regexp_extract_all(line, F.lit(pattern), F.lit(1))
        texts = F.regexp_extract_all(line, F.lit(pattern), F.lit(2))
        return F.zip_with(kinds, texts, lambda k, t: F.when(k.isin(*SPAN_CELLS), "").otherwise(strip(t)))

    return F.filter(F.transform(F.split(body, "<nl>"), row), lambda r: F.size(r) > 0)
