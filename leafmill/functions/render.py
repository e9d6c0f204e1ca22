"""Columns that write Markdown and plain-language notes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording of the warning codes.
WARNING_TEXT = {
    "SCANNED_PAGE_NO_TEXT": "scanned page — the file itself carries no text layer",
    "MIXED_CONTENT_PAGE": "page mixes text and large images",
    "GARBLED_TEXT": "text on this page is damaged or unreadable",
    "MISMAPPED_GLYPHS": "a symbol font on this page decoded to unrelated alphabets — its formulas and special characters are unreliable",
    "LAYOUT_COMPLEX": "complex layout — reading order may be imperfect",
    "HEADER_FOOTER_DETECTED": "repeated headers or footers were removed from the text",
    "POSSIBLE_TWO_COLUMN_ORDER": "two-column layout — reading order may be imperfect",
    "UNICODE_REPAIRED": "damaged characters were repaired",
    "ENCODING_FALLBACK": "the file encoding had to be guessed",
    "NESTING_TRUNCATED": "the document nests deeper than the reader renders — the deepest levels were cut",
    "OCR_UNAVAILABLE": "no text extracted",
    "OCR_SKIPPED_DISABLED": "no text extracted",
    "OCR_MODEL_INCOMPATIBLE": "no text extracted",
    "OCR_FAILED": "no text extracted — OCR could not read this page",
    "OCR_IMAGE_FAILED": "some images on this page could not be read — text from the rest was kept",
    "OCR_APPLIED": "text recovered by OCR",
    "OCR_LOW_CONFIDENCE": "OCR text on this page is uncertain — check it before relying on it",
    "OCR_REJECTED_LOW_CONFIDENCE": "OCR was too uncertain to replace the damaged text on this page",
    "OCR_MIXED_CONFIDENCE": "some OCR lines on this page are much weaker than the page average",
    "OCR_NOISE_FILTERED": "unreadable OCR fragments were discarded",
    "OCR_MULTI_COLUMN": "this page was read as multiple columns — check the order of the OCR text",
    "VLM_APPLIED": "the visual model read this page",
    "VLM_OUTPUT_REJECTED": "the visual model's reading of this page was discarded",
    "VLM_UNAVAILABLE": "the visual model could not run",
    "FORMULA_REVIEW_REQUIRED": "a formula on this page was dropped as malformed — check the source",
    "VLM_URLS_DROPPED": "URLs read by the visual model were removed — the model invents them; check the source for links",
    "PAGE_UNREADABLE": "this page's content is damaged — what comes after the damage is lost",
}
CONFIDENCE_CODES = ("OCR_APPLIED", "OCR_LOW_CONFIDENCE", "OCR_REJECTED_LOW_CONFIDENCE")
UNIT_LABELS = {"page": "Page", "section": "Section", "sheet": "Sheet", "slide": "Slide"}


def cell(text: Column) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit("|"), F.lit("\\|")), r"\r?\n", "<br>")


def gfm_table(rows: Column) -> Column:
    """A pipe table as wide as its widest row; the first row is the header."""
    width = F.array_max(F.transform(rows, F.size))

    def line(row: Column) -> Column:
        padded = F.concat(F.transform(row, cell), F.array_repeat(F.lit(""), width - F.size(row)))
        return F.concat(F.lit("| "), F.array_join(padded, " | "), F.lit(" |"))

    drawn = F.transform(rows, line)
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    table = F.array_join(F.concat(F.slice(drawn, 1, 1), F.array(rule), F.slice(drawn, 2, F.greatest(F.size(drawn) - 1, F.lit(0)))), "\n")
    return F.when(F.coalesce(F.size(rows), F.lit(0)) > 0, table).otherwise("")


def unit_heading(unit_type: Column, number: Column, title: Column) -> Column:
    label = F.coalesce(*[F.when(unit_type == k, F.lit(v)) for k, v in UNIT_LABELS.items()], F.concat(F.upper(F.substring(unit_type, 1, 1)), F.lower(F.substring(unit_type, 2, 1000))))
    return F.concat(F.lit("## "), label, F.lit(" "), number.cast("string"), F.when(F.coalesce(title, F.lit("")) != "", F.concat(F.lit(": "), title)).otherwise(""))


def percent(share: Column) -> Column:
    return F.concat(F.bround(share * 100, 0).cast("int").cast("string"), F.lit("%"))


def describe(code: Column, page: Column, confidence: Column, detail: Column, attrs: Column) -> Column:
    """One readable sentence for a warning; missing keys drop their part, unknown codes stand for themselves."""
    base = F.coalesce(*[F.when(code == k, F.lit(v)) for k, v in WARNING_TEXT.items()], code)
    note = lambda inner: F.concat(F.lit(" ("), inner, F.lit(")"))
    has = lambda key: F.coalesce(attrs[key], F.lit("")).isin("", "0") == F.lit(False)
    sure = F.when(code.isin(*CONFIDENCE_CODES) & confidence.isNotNull(), note(F.concat(F.lit("confidence "), percent(confidence))))
    mixed = F.when(
        (code == "OCR_MIXED_CONFIDENCE") & attrs["low_lines"].isNotNull(),
        note(F.concat(attrs["low_lines"], F.lit(" of "), F.coalesce(attrs["total_lines"], F.lit("?")), F.lit(" lines, lowest "), percent(F.coalesce(attrs["lowest"].cast("double"), F.lit(0.0))))),
    )
    applied = F.concat_ws(
        "; ",
        F.when(has("formulas"), F.concat(attrs["formulas"], F.lit(" formula(s) recovered"))),
        F.when(attrs["prose"] == "redundant", F.lit("its prose repeated the page text and was dropped")),
    )
    visual = F.when((code == "VLM_APPLIED") & (applied != ""), note(applied))
    counted = F.when(code.isin("FORMULA_REVIEW_REQUIRED", "VLM_URLS_DROPPED") & has("count"), note(attrs["count"]))
    reason = F.when((code == "VLM_OUTPUT_REJECTED") & has("reason") & ~has("pages"), note(attrs["reason"]))
    noise = F.when((code == "OCR_NOISE_FILTERED") & has("sample"), note(F.concat(F.coalesce(attrs["dropped"], F.lit("?")), F.lit(": "), attrs["sample"])))
    repeated = F.concat(attrs["pages"], F.lit(" page(s) the visual model read only repeated text the document already carries, and were discarded"))
    base = F.when((code == "VLM_OUTPUT_REJECTED") & has("pages"), repeated).otherwise(base)
    tail = F.when(~code.isin(*CONFIDENCE_CODES) & (F.coalesce(detail, F.lit("")) != ""), F.concat(F.lit(" — "), detail))
    parts = [F.when(page.isNotNull(), F.concat(F.lit("Page "), page.cast("string"), F.lit(": "))), base, sure, mixed, visual, counted, reason, noise, tail]
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])
