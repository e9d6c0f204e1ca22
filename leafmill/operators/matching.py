"""Many patterns at once: which of a document's patterns each of its texts holds.

Patterns and texts are dealt to shards of their key, and a task streams a shard's texts
past one automaton of its patterns, so the work is that of reading each text once for
every shard of patterns, plus the hits. A shard holds a bounded length of patterns; the
texts of a key that has very many are salted over several shards, each with the key's
patterns. Nothing is paired before it matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.runtime import cut, ship_package

#: Characters of patterns in one automaton.
PATTERN_CHARS = 2_000_000
#: Characters of one key's texts that one task reads.
TEXT_CHARS = 64_000_000
#: Keys whose numbers of shards travel to every task; more are joined.
SMALL = 50_000


def _searched(listed: bool):
    """Rows sorted by (key, shard, salt, kind), patterns before texts, to a row (key, text_id, weight, found) per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (kind, pa.int64(), pa.int64(), pa.list_(pa.int64())))], ["key", "text_id", "weight", "found"])

        shard = automaton = kind = None
        always: list[tuple[int, int]] = []
        ready = False
        for batch in batches:
            kind, out = batch.schema.field(0).type, []
            for key, at, salt, is_text, number, weight, value in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, at, salt) != shard:
                    shard, automaton, always, ready = (key, at, salt), ahocorasick.Automaton(), [], False
                if not is_text:
                    if value:
                        automaton.add_word(value, (number, weight))
                    else:
                        always.append((number, weight))  # every text holds the empty pattern
                    continue
                if not ready:
                    automaton.make_automaton()
                    ready = True
                hits = set(always)
                if len(automaton):
                    hits.update(hit for _, hit in automaton.iter(value))
                out.append((key, number, sum(w for _, w in hits), sorted(n for n, _ in hits) if listed else None))
            if out:
                yield batch_of(out)

    return run


def numbered(patterns: DataFrame, weight: Column | None = None) -> DataFrame:
    """(key, pattern, number, n): the distinct patterns of each key, with the sum of their weights, written out so that numbers last."""
    n = F.count("*") if weight is None else F.sum(weight)
    known = patterns.where("key is not null and pattern is not null").groupBy("key", "pattern").agg(n.cast("long").alias("n"))
    return cut(known.withColumn("number", F.monotonically_increasing_id()))


def contained(texts: DataFrame, known: DataFrame, listed: bool = True, pattern_chars: int = PATTERN_CHARS, text_chars: int = TEXT_CHARS) -> DataFrame:
    """(key, text_id, weight, found) for texts (key, text_id, text) and ``numbered`` patterns.

    ``found`` is the numbers of the key's patterns that the text holds, each once and null
    if not ``listed``; ``weight`` is the sum of their n. A text has a row for each shard
    of its key's patterns, in all cases at least one if the key has patterns. Defined
    cases: null texts and keys have no row; an empty pattern is in every text; texts
    that repeat have a row each; letters match as they are written; empty frames give
    no rows.
    """
    ship_package(texts.sparkSession)
    said = texts.where("key is not null and text is not null").select("key", F.col("text_id").cast("long").alias("text_id"), "text")
    shards = known.groupBy("key").agg(F.ceil((F.sum(F.length("pattern")) + 1) / pattern_chars).cast("int").alias("shards"))
    salts = said.groupBy("key").agg(F.ceil((F.sum(F.length("text")) + 1) / text_chars).cast("int").alias("salts"))
    plan = cut(shards.join(salts, "key"))
    plan = F.broadcast(plan) if plan.count() <= SMALL else plan
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = known.join(plan, "key").select("key", F.pmod(F.xxhash64("pattern"), F.col("shards")).cast("int").alias("shard"), upto("salts").alias("salt"), F.lit(False).alias("is_text"), "number", "n", F.col("pattern").alias("value"))
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("salts")).cast("int")
    dealt = said.join(plan, "key").select("key", salt.alias("salt"), upto("shards").alias("shard"), F.col("text_id").alias("number"), F.col("text").alias("value"))
    rows = own.unionByName(dealt.select("key", "shard", "salt", F.lit(True).alias("is_text"), "number", F.lit(0).cast("long").alias("n"), "value"))
    rows = rows.repartition("key", "shard", "salt").sortWithinPartitions("key", "shard", "salt", "is_text")
    kind = texts.schema["key"].dataType.simpleString()
    return rows.mapInArrow(_searched(listed), f"key {kind}, text_id long, weight long, found array<long>")


def keyed(frame: DataFrame, key: str, **columns: Column) -> DataFrame:
    return frame.select(F.col(key).alias("key"), *[c.alias(n) for n, c in columns.items()])
