"""OCR lines after recognition: decoding, filtering, page confidence and outcome."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import ICON, icon_noise, strip

# Fixed values.
LINE_FLOOR, FRAGMENT_LENGTH, SAMPLES, MIN_CONFIDENCE, BLANK = 0.30, 3, 5, 0.60, 0


def decode_steps(steps, labels: list[str]) -> tuple[str, float]:
    """(text, confidence) of steps x classes, as ``greedy_decode`` says."""
    scores = np.asarray(steps, np.float64).reshape(len(steps), -1) if len(steps) else np.zeros((0, len(labels)))
    if scores.shape[1] != len(labels):
        raise ValueError(f"{scores.shape[1]} classes, {len(labels)} labels")
    if scores.size and (scores.min() < 0 or scores.max() > 1):
        raised = np.exp(scores - scores.max(axis=1, keepdims=True))
        scores = raised / raised.sum(axis=1, keepdims=True)
    best = scores.argmax(axis=1)
    keep = (best != BLANK) & np.append(True, best[1:] != best[:-1])[: len(best)]
    sure = scores.max(axis=1)[keep] if len(best) else np.zeros(0)
    return "".join(labels[i] for i in best[keep]), float(sure.mean()) if len(sure) else 0.0


def greedy_decode(labels: list[str]):
    """A pandas UDF from array<array<float>> (steps x classes) to struct(text, confidence).

    The best class of each step is taken, repeats are collapsed, blanks dropped;
    confidence is the mean probability of what is kept. Scores outside 0..1 go
    through a softmax. Another number of classes than labels is an error.
    """

    @F.pandas_udf("text string, confidence double")
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for steps in part:
                out.append(decode_steps([] if steps is None else [list(s) for s in steps], labels))
            yield pd.DataFrame(out, columns=["text", "confidence"])

    return decode


def readable(lines: DataFrame) -> DataFrame:
    """Recognized lines that are kept at all; lone glyphs become icons."""
    return lines.where((strip(F.col("text")) != "") & (F.col("confidence") >= LINE_FLOOR)).withColumn("text", icon_noise(F.col("text")))


def page_results(lines: DataFrame, threshold: float = MIN_CONFIDENCE) -> DataFrame:
    """One row per page: its text, confidence, counts and outcome code.

    ``lines`` is (doc_id, page, image_no, line_no, text, confidence, error); an image
    that failed is one row with an error and null text. Fragments - short and below the
    threshold - are discarded, counted and sampled.
    """
    failed = F.col("error").isNotNull()
    fragment = ~failed & (F.col("confidence") < threshold) & (F.length("text") <= FRAGMENT_LENGTH)
    kept = ~failed & ~fragment
    scored = kept & (F.col("text") != ICON)
    at = lambda *c: F.struct("image_no", "line_no", *c)
    ordered = lambda flag: F.transform(F.array_sort(F.collect_list(F.when(flag, at(F.col("text").alias("t"))))), lambda s: s["t"])
    pages = lines.groupBy("doc_id", "page").agg(
        F.countDistinct("image_no").alias("images"),
        F.countDistinct(F.when(failed, F.col("image_no"))).alias("failed_images"),
        F.min_by("error", F.when(failed, F.col("image_no"))).alias("detail"),
        F.count_if(fragment).alias("dropped"),
        F.slice(ordered(fragment), 1, SAMPLES).alias("sample"),
        F.array_join(ordered(kept), "\n").alias("text"),
        F.count_if(scored).alias("scored_lines"),
        F.avg(F.when(scored, F.col("confidence"))).alias("confidence"),
        F.count_if(scored & (F.col("confidence") < threshold)).alias("low_lines"),
        F.min(F.when(scored, F.col("confidence"))).alias("lowest"),
    )
    outcome = (
        F.when(F.col("failed_images") == F.col("images"), "OCR_FAILED")
        .when(F.col("scored_lines") == 0, "OCR_APPLIED")
        .when(F.col("confidence") < threshold, "OCR_LOW_CONFIDENCE")
        .when(F.col("low_lines") > 0, "OCR_MIXED_CONFIDENCE")
        .otherwise("OCR_APPLIED")
    )
    return pages.withColumn("code", outcome).withColumn("partial", (F.col("failed_images") > 0) & (F.col("failed_images") < F.col("images")))
