"""Pages read by a visual model: routing, availability, cached inference, judging and acceptance."""

from __future__ import annotations

import platform
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import novelty
from leafmill.runtime import cut, ship_package

# Fixed values.
MAX_TOKENS, REPETITION_PENALTY = 4096, 1.05
LOW_YIELD, NOVEL = 0.5, 0.30
#: The store's folders are named by so many digits of the keys.
PREFIX = 2


def route(candidates: DataFrame, pages: DataFrame, enabled: bool, mode: str = "auto") -> DataFrame:
    """The pages to read: none unless enabled, the candidates, or all."""
    wanted = pages.select("doc_id", "page")
    if not enabled:
        return wanted.limit(0)
    return wanted if mode == "all" else wanted.join(candidates.select("doc_id", "page").distinct(), ["doc_id", "page"], "left_semi")


def cache_key(png: Column, model: Column, tokens: Column, penalty: Column, prompt: Column) -> Column:
    """The key under which an inference is stored: content and everything that shapes the answer."""
    return F.sha2(F.concat(png, F.concat_ws("|", model, tokens.cast("string"), penalty.cast("string"), prompt).cast("binary")), 256)


def host_failure(enabled: bool = True, known_model: bool = True, installed: bool = True, system: str | None = None, machine: str | None = None) -> str | None:
    """Why no visual model can run here, the first reason that holds, or null; nothing is loaded to find out."""
    if not enabled:
        return "disabled"
    where = (system or platform.system(), machine or platform.machine())
    if where != ("Darwin", "arm64"):
        return f"unsupported-platform ({'/'.join(where)})"
    return "missing-deps" if not installed else None if known_model else "unknown-model"


def infer(pages: DataFrame, engine: Callable[[], Callable[[bytes, int, float], tuple[str, bool]]], store: str, model: str, prompt: str, max_tokens: int = MAX_TOKENS, penalty: float = REPETITION_PENALTY) -> DataFrame:
    """(doc_id, page, raw, capped, cached) of page pictures (doc_id, page, png); answers are kept in the Parquet folder ``store``.

    ``engine`` builds, once a task, what turns (png, max_tokens, penalty) into (raw output,
    whether the token limit was hit). Pictures with one key are read once; those that the
    store holds are not read at all. Null pictures give no row. The store is laid out by
    the first two digits of the keys, and only the folders of the keys asked for are read;
    damaged files in it are passed over, as if their answers had not been kept. A run with
    nothing new writes nothing; of answers that two runs at once stored the least counts.
    """
    spark = pages.sparkSession
    ship_package(spark)
    key = cache_key(F.col("png"), F.lit(model), F.lit(max_tokens), F.lit(penalty), F.lit(prompt))
    keyed = cut(pages.where("png is not null").select("doc_id", "page", "png", key.alias("key")))
    asked = [r[0] for r in keyed.select(F.substring("key", 1, PREFIX)).distinct().collect()]  # 256 at most
    known = cut(kept_answers(spark, store, asked).join(keyed.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.min(F.struct("raw", "capped")).alias("r")).select("key", "r.raw", "r.capped"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        convert = None
        for part in parts:
            convert = convert or engine()
            rows = [(k, *convert(bytes(png), max_tokens, penalty)) for k, png in zip(part["key"], part["png"])]
            yield pd.DataFrame(rows, columns=["key", "raw", "capped"])

    lacking = keyed.join(known, "key", "left_anti").groupBy("key").agg(F.first("png").alias("png"))
    fresh = cut(lacking.mapInPandas(run, "key string, raw string, capped boolean"))
    if not fresh.isEmpty():
        placed = fresh.withColumn("prefix", F.substring("key", 1, PREFIX))
        placed.repartition("prefix").write.partitionBy("prefix").mode("append").parquet(store)
    answers = known.withColumn("cached", F.lit(True)).unionByName(fresh.withColumn("cached", F.lit(False)))
    return keyed.drop("png").join(answers, "key").select("doc_id", "page", "raw", "capped", "cached")


def kept_answers(spark: SparkSession, store: str, prefixes: list[str]) -> DataFrame:
    """(key, raw, capped) of the store's folders for these prefixes of keys."""
    kind = "key string, raw string, capped boolean"
    try:
        held = spark.read.schema(f"{kind}, prefix string").option("ignoreCorruptFiles", "true").parquet(store)
    except AnalysisException as why:
        if why.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], kind)
    return held.where(F.col("prefix").isin(prefixes)).where("key is not null and raw is not null").select("key", "raw", "capped")


def judge(truncated: Column, produced: Column, native_chars: Column, replacing: Column) -> Column:
    """Why a reading is rejected, or null."""
    return F.when(truncated, "truncated").when(produced == 0, "empty").when(replacing & (produced < LOW_YIELD * native_chars), "low-yield")


def accept(readings: DataFrame, native_tables: DataFrame) -> DataFrame:
    """What of each reading is published.

    ``readings`` is (doc_id, page, text, native_text, formulas array, table_count,
    truncated, replacing). An additive reading that says little new keeps its formulas
    only; its tables count only where the page has none of its own; one that has
    nothing left is a duplicate.
    """
    owned = native_tables.select("doc_id", "page").distinct().withColumn("has_table", F.lit(True))
    rows = readings.join(owned, ["doc_id", "page"], "left").withColumn("has_table", F.coalesce("has_table", F.lit(False)))
    produced = F.length("text") + F.when(F.col("table_count") > 0, 1).otherwise(0)
    rows = rows.withColumn("rejected", judge(F.col("truncated"), produced, F.length(F.coalesce("native_text", F.lit(""))), F.col("replacing")))
    redundant = ~F.col("replacing") & (novelty(F.col("text"), F.coalesce("native_text", F.lit(""))) < NOVEL)
    rows = rows.withColumn("redundant", F.col("rejected").isNull() & redundant)
    rows = rows.withColumn("kept_tables", F.when(F.col("rejected").isNull() & ~F.col("has_table"), F.col("table_count")).otherwise(0))
    rows = rows.withColumn("kept_text", F.when(F.col("rejected").isNotNull(), "").when(F.col("redundant"), F.array_join("formulas", "\n\n")).otherwise(F.col("text")))
    nothing = F.col("rejected").isNull() & (F.col("kept_text") == "") & (F.col("kept_tables") == 0)
    reason = F.coalesce("rejected", F.when(nothing, "duplicate"))
    return rows.select("doc_id", "page", "kept_text", "kept_tables", "redundant", reason.alias("reason"))


def trusted_text(text: Column, replacing: Column, mismapped: Column) -> Column:
    """The native text that numbers may be checked against, null where it cannot be trusted."""
    return F.when(~replacing & ~mismapped, text)
