"""Quality metrics over extracted documents, and the formula scorer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.markup import formula_balanced, unsupported_numbers
from leafmill.functions.text import lines, strip
from leafmill.operators import matching


def phrase_retention(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """(doc_id, retention): the share of a document's expected phrases (doc_id, phrase) found in its text; 1 without any.

    A phrase of a document with several texts counts for each of them, as does one that
    is listed several times; a null phrase or text counts for nothing.
    """
    known = matching.numbered(matching.keyed(phrases, "doc_id", pattern=F.lower("phrase")))
    hits = matching.contained(matching.keyed(texts, "doc_id", text_id=F.lit(0), text=F.lower("text")), known, listed=False)
    wanted = known.groupBy("key").agg(F.sum("n").alias("n"))
    had = texts.where("text is not null").groupBy(F.col("doc_id").alias("key")).agg(F.count("*").alias("texts"))
    rate = hits.groupBy("key").agg(F.sum("weight").alias("hits")).join(wanted, "key").join(had, "key").select(F.col("key").alias("doc_id"), (F.col("hits") / (F.col("n") * F.col("texts"))).alias("retention"))
    return texts.select("doc_id").distinct().join(rate, "doc_id", "left").withColumn("retention", F.coalesce("retention", F.lit(1.0)))


def duplicate_line_ratio(texts: DataFrame) -> DataFrame:
    """(doc_id, ratio) without exploding: repeated lines over all non-empty lines of each text."""
    own = F.filter(F.transform(lines(F.coalesce("text", F.lit(""))), strip), lambda x: x != "")
    rows = texts.select("doc_id", own.alias("own"))
    return rows.select("doc_id", F.when(F.size("own") == 0, 0.0).otherwise(1 - F.size(F.array_distinct("own")) / F.size("own")).alias("ratio"))


def cell_recall(cells: DataFrame, expected: DataFrame) -> DataFrame:
    """(doc_id, recall) of expected cells (doc_id, cell) among extracted ones, case and edges aside."""
    key = lambda df: df.select("doc_id", F.lower(strip(F.col("cell"))).alias("cell"))
    want, have = key(expected), key(cells).distinct().withColumn("found", F.lit(1))
    return want.join(have, ["doc_id", "cell"], "left").groupBy("doc_id").agg(F.avg(F.coalesce("found", F.lit(0))).alias("recall"))


def cell_precision(cells: DataFrame, expected: DataFrame) -> DataFrame:
    """(doc_id, precision): the share of non-empty extracted cells that were expected."""
    key = lambda df: df.select("doc_id", F.lower(strip(F.col("cell"))).alias("cell"))
    have, want = key(cells).where("cell <> ''"), key(expected).distinct().withColumn("found", F.lit(1))
    return have.join(want, ["doc_id", "cell"], "left").groupBy("doc_id").agg(F.avg(F.coalesce("found", F.lit(0))).alias("precision"))


def reading_order_errors(texts: DataFrame, markers: DataFrame) -> DataFrame:
    """(doc_id, errors): neighbouring columns of which the right one begins before the left one ends.

    ``markers`` is (doc_id, column_no, marker); markers that the text lacks do not count.
    """
    at = markers.join(texts, "doc_id").select("doc_id", "column_no", F.expr("locate(marker, text)").alias("at")).where("at > 0")
    spans = at.groupBy("doc_id", "column_no").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    right = spans.select("doc_id", (F.col("column_no") - 1).alias("column_no"), F.col("first").alias("next_first"))
    return spans.join(right, ["doc_id", "column_no"]).groupBy("doc_id").agg(F.count_if(F.col("next_first") < F.col("last")).alias("errors"))


def leakage(blocks: DataFrame, patterns: DataFrame) -> DataFrame:
    """(doc_id, leaks): pairs of a text block and a known chrome pattern of its document that it holds."""
    known = matching.numbered(matching.keyed(patterns, "doc_id", pattern=F.lower("pattern")))
    hits = matching.contained(matching.keyed(blocks, "doc_id", text_id=F.lit(0), text=F.lower("text")), known, listed=False)
    counted = hits.groupBy(F.col("key").alias("doc_id")).agg(F.sum("weight").alias("leaks"))
    return blocks.select("doc_id").distinct().join(counted, "doc_id", "left").na.fill({"leaks": 0})


def empty_unit_rate(units: DataFrame, blocks: DataFrame) -> DataFrame:
    filled = blocks.select("doc_id", "unit").distinct().withColumn("filled", F.lit(1))
    return units.join(filled, ["doc_id", "unit"], "left").groupBy("doc_id").agg(F.avg(F.when(F.col("filled").isNull(), 1.0).otherwise(0.0)).alias("empty_rate"))


def corruption_rate(texts: DataFrame) -> DataFrame:
    """(doc_id, rate): replacement characters per character of all its texts."""
    sums = texts.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit("�"))).alias("bad"), F.sum(F.length("text")).alias("n"))
    return sums.select("doc_id", F.when(F.col("n") > 0, F.col("bad") / F.col("n")).otherwise(0.0).alias("rate"))


def normalize_formula(latex):
    """Spacing, style commands and brace style folded away for comparison."""
    out = F.regexp_replace(latex, r"\\(?:displaystyle|textstyle|left|right|mathrm|mathbf|text|operatorname|limits|quad|qquad)(?![A-Za-z])", "")
    out = F.regexp_replace(out, r"\\[,;:! ]|[\s~]+", "")
    out = F.regexp_replace(out, r"\^\{?\\circ\}?", "°")
    out = F.regexp_replace(out, r"(\d),(\d)", "$1.$2")
    return F.lower(F.regexp_replace(out, r"\{([^{}])\}", "$1"))


def _formula_hits(expected: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(page, candidate_id, number) of the expected formulas that a candidate holds, and (page, formula_id, number) of these; an empty formula is held by none."""
    want = matching.keyed(expected, "page", formula_id=F.col("formula_id"), pattern=normalize_formula(F.col("latex")))
    known = matching.numbered(want.where("pattern <> ''"))
    found = matching.contained(matching.keyed(candidates, "page", text_id=F.col("candidate_id"), text=normalize_formula(F.col("latex"))), known)
    pairs = found.select(F.col("key").alias("page"), F.col("text_id").alias("candidate_id"), F.explode("found").alias("number"))
    named = want.join(known, ["key", "pattern"]).select(F.col("key").alias("page"), "formula_id", "number")
    return pairs, named


def formula_score(expected: DataFrame, candidates: DataFrame) -> DataFrame:
    """(page, expected, recovered, wrong, wrong_balanced, unbalanced) of each page with expected formulas.

    recovered: expected formulas that a candidate of the page holds; wrong: candidates that
    hold none, told apart by whether their braces and delimiters close.
    """
    pairs, named = _formula_hits(expected, candidates)
    hit = named.join(pairs.select("page", "number").distinct(), ["page", "number"]).select("page", "formula_id").distinct().groupBy("page").agg(F.count("*").alias("recovered"))
    used = pairs.select("page", "candidate_id").distinct()
    stray = candidates.select("page", F.col("candidate_id").cast("long").alias("candidate_id"), formula_balanced(F.col("latex")).alias("balanced")).join(used, ["page", "candidate_id"], "left_anti")
    wrong = stray.groupBy("page").agg(F.count("*").alias("wrong"), F.count_if("balanced").alias("wrong_balanced"), F.count_if(~F.col("balanced")).alias("unbalanced"))
    total = expected.groupBy("page").agg(F.count("*").alias("expected"))
    return total.join(hit, "page", "left").join(wrong, "page", "left").na.fill(0, ["recovered", "wrong", "wrong_balanced", "unbalanced"])


def numeric_gate(expected: DataFrame, candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """What dropping formulas with unsupported numbers would catch and cost, per reason of ``pages`` (page, reason, text).

    wrong: balanced candidates that hold no expected formula, caught: those the gate drops;
    recovered: expected formulas that a candidate holds, cost: those whose holders it drops all.
    """
    pairs, named = _formula_hits(expected, candidates)
    read = candidates.withColumn("candidate_id", F.col("candidate_id").cast("long")).join(pages, "page")
    have = read.select("page", "reason", "candidate_id", formula_balanced(F.col("latex")).alias("balanced"), (F.size(unsupported_numbers(F.col("latex"), F.col("text"))) > 0).alias("flagged"))
    stray = have.where("balanced").join(pairs.select("page", "candidate_id").distinct(), ["page", "candidate_id"], "left_anti")
    missed = stray.groupBy("reason").agg(F.count("*").alias("wrong"), F.count_if("flagged").alias("caught"))
    # Whether all holders of a formula text are dropped is settled per text, before it meets the formulas that share it.
    lost = pairs.join(have, ["page", "candidate_id"]).groupBy("page", "reason", "number").agg(F.every("flagged").alias("lost"))
    held = named.join(lost, ["page", "number"]).groupBy("reason", "page", "formula_id").agg(F.every("lost").alias("lost")).groupBy("reason").agg(F.count("*").alias("recovered"), F.count_if("lost").alias("cost"))
    return pages.select("reason").distinct().join(missed, "reason", "left").join(held, "reason", "left").na.fill(0)
