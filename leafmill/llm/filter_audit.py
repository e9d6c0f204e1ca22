"""Filter interaction audit: every order of the quality filters replayed over the documents' flags.

Which filter gets the blame for a removal depends on the order in which filters run.
The audit replays all orders: flags are crossed with the broadcast orders, each order is
exploded into its steps, a document leaves at its first failing step, and conditional
sums, combined map-side, count what every step kept, removed and found gone already.
A filter's removals summed over all orders are its (unscaled) Shapley value.

Documents with the same part, flags and labels meet the same fate under every order, so
they are counted before the cross: it grows with parts and flag patterns, not documents.
Texts never leave the scan; a SHA-256 digest stands for each where copies are looked for.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Letters of the filters; the bit of a filter in ``fails`` is its place here.
FILTERS = "ABCDE"
WHITE = r"[\x20\x09-\x0D]+"


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def flagged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, fails) of every row; ``fails`` has the bits of filters A to D, which look at one text alone."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", WHITE), ""))
    rows = rows.select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), F.length("text").cast("long").alias("n_chars"),
        F.size("words").cast("long").alias("n_words"), F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"), F.col("text").rlike("[#$%&*|]").alias("signs"),
    )
    conditions = {"A": F.col("n_words") < 200, "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"), "C": 100 * F.col("n_capitals") > 3 * F.col("n_chars"), "D": F.col("signs")}
    fails = sum((F.when(failed, _bit(letter)).otherwise(0) for letter, failed in conditions.items()), F.lit(0))
    return rows.select("doc_id", "part", "digest", fails.alias("fails"))


def profiles(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic, n): how many documents share their part, all five flags and both labels.

    Rows that repeat are combined before each shuffle, so no copies gather in one task:
    first by document and text, then, with the labels, by text. A text's least doc_id
    decides filter E; there are no more rows of a text left than parts times labels.
    """
    counted = flagged(docs).groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").cast("string").alias("key"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # Rows without a doc_id find no label; a key of their own each spreads them.
    counted = counted.withColumn("key", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.hex("digest"))))
    known = counted.join(marks, "key", "left").fillna(0, ["good", "toxic"])
    texts = known.groupBy("digest", "part", "fails", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("n_least"),
    )
    first = F.col("least") == F.min("least").over(Window.partitionBy("digest"))
    texts = texts.withColumn("originals", F.col("nameless") + F.when(first, F.col("n_least")).otherwise(0))
    split = F.array(
        F.struct("fails", F.col("originals").alias("n")),
        F.struct(F.col("fails").bitwiseOR(_bit("E")).alias("fails"), (F.col("n") - F.col("originals")).alias("n")),
    )
    rows = texts.select("part", "good", "toxic", F.inline(split)).where("n > 0")
    return rows.groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n"))


def replay(rows: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from rows (part, fails, good, toxic, n)."""
    orders = rows.sparkSession.createDataFrame([("".join(p),) for p in permutations(FILTERS)], "filter_order string")

    def failing(letter: str) -> Column:
        return F.col("fails").bitwiseAND(_bit(letter)) != 0

    crossed = rows.crossJoin(F.broadcast(orders))  # 120 rows, whatever the data
    # least() passes over nulls: null if no filter fails.
    first = F.least(*[F.when(failing(letter), F.instr("filter_order", letter)) for letter in FILTERS])
    steps = crossed.withColumn("first", first).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    steps = steps.withColumn("bit", F.expr(f"shiftleft(1, instr('{FILTERS}', substring(filter_order, step, 1)) - 1)"))
    gone, fails_here = F.col("first") == F.col("step"), F.col("fails").bitwiseAND(F.col("bit")) != 0

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    out = steps.groupBy("part", "filter_order", "step").agg(
        total(F.col("first").isNull() | (F.col("first") > F.col("step"))).alias("kept"),
        total(gone).alias("removed"),
        total(fails_here & (F.col("first") < F.col("step"))).alias("redundant"),
        total(F.col("fails") == F.col("bit")).alias("unique_fails"),
        total(gone & (F.col("good") == 1)).alias("good_lost"),
        total(gone & (F.col("toxic") == 1)).alias("toxic_lost"),
    )
    whole = Window.partitionBy("part", F.expr("substring(filter_order, step, 1)"))  # 120 rows
    return out.withColumn("shapley", F.sum("removed").over(whole))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The replay of all 120 orders of the five filters over the documents.

    Filters: A under 200 words; B under half of the words distinct; C over 3 % capitals;
    D any of ``#$%&*|``; E the same text as a smaller doc_id's, of any part, removed or not.
    Defined cases: a null text is empty; a null lang is the empty part, as an empty one;
    a row without a doc_id neither fails E nor makes another fail it, and has no label;
    rows that repeat a doc_id are counted each, and copies among them do not fail E by
    one another; of several labels of a doc_id any 1 counts; null labels count as 0; an
    empty table has no parts and gives no rows; other columns are ignored.
    """
    return replay(profiles(docs, labels))


#: The same in DuckDB; documents are replayed one by one.
AUDIT_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
      len(words) < 200,
      100 * len(list_distinct(words)) < 50 * len(words),
      100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
      regexp_matches(t, '[#$%&*|]'),
      coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS fails
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
r AS (
  SELECT part, good, toxic, fails, filter_order,
    list_min([CASE WHEN fails[i] THEN instr(filter_order, substr('ABCDE', i, 1)) END FOR i IN range(1, 6)]) AS gone
  FROM d, o),
s AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS letter, gone, good, toxic,
    fails[instr('ABCDE', substr(filter_order, step, 1))] AS here, len(list_filter(fails, lambda x: x)) AS n_fails
  FROM r, (SELECT unnest(range(1, 6)) AS step) n),
g AS (
  SELECT part, filter_order, step, letter,
    count(*) FILTER (WHERE gone IS NULL OR gone > step) AS kept,
    count(*) FILTER (WHERE gone = step) AS removed,
    count(*) FILTER (WHERE here AND gone < step) AS redundant,
    count(*) FILTER (WHERE here AND n_fails = 1) AS unique_fails,
    count(*) FILTER (WHERE gone = step AND good = 1) AS good_lost,
    count(*) FILTER (WHERE gone = step AND toxic = 1) AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM g
"""
