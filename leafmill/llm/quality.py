"""Quality classifier: hashed word n-gram logistic regression, FTRL-proximal updates.

Words and runs of signs are hashed, single and in pairs, into ``2**bits`` weights; a
document's feature is the share of its n-grams that fall on a weight. Training visits
a bounded, documented number of labelled rows in hash order (``max_rows``), so it
costs the same at every corpus size; scoring is one sparse dot product per document
over its whole text, with the weights (a fixed 2**bits floats) sent to the workers.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.chunks import grouped, words_of
from leafmill.runtime import ship_package

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
#: The slot of all pairs of one and the same word.
ECHO = 0


@dataclass(frozen=True)
class QualityConfig:
    bits: int = 18
    alpha: float = 2.0
    beta: float = 0.1
    l1: float = 0.002
    l2: float = 0.02
    epochs: int = 6
    #: At most so many labelled rows are used for fitting, the first ones by hash of doc_id.
    max_rows: int = 6000
    #: Feature values are shares of a document's n-grams times this.
    scale: float = 30.0
    threshold: float = 0.3
    folds: int = 5


def _token_hashes(words: list[str]) -> list[list[int]]:
    return [[zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in _TOKEN.findall(w)] for w in words]


class Hasher:
    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)

    def slots(self, texts: list[str]) -> list[np.ndarray]:
        """The weight slots of every text's words and word pairs, in order."""
        words = words_of(texts)
        hashed = _token_hashes(words.distinct.to_pylist())
        counts = np.fromiter(map(len, hashed), np.int64, len(hashed))
        tokens, ends = words.gather(np.fromiter(chain.from_iterable(hashed), np.uint64, int(counts.sum())), counts)
        single = ((tokens + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
        pairs = (((tokens[:-1] + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)) ^ ((tokens[1:] + np.uint64(7)) * np.uint64(0x165667B19E3779F9)))
        pairs = (pairs * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
        pairs[tokens[:-1] == tokens[1:]] = ECHO  # a word said twice is one n-gram, whatever the word
        out = []
        for a, b in zip(ends[:-1], ends[1:]):
            out.append(np.concatenate([single[a:b], pairs[a : max(a, b - 1)]]).astype(np.int64))
        return out


@lru_cache(maxsize=4)
def hasher(bits: int) -> Hasher:
    return Hasher(bits)


@dataclass
class Ftrl:
    """Follow-the-regularised-leader, per coordinate; slot ``2**bits`` is the bias, which is not regularised."""

    config: QualityConfig

    def __post_init__(self) -> None:
        size = (1 << self.config.bits) + 1
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        c, z, n = self.config, self.z[at], self.n[at]
        w = -(z - np.sign(z) * c.l1) / ((c.beta + np.sqrt(n)) / c.alpha + c.l2)
        return np.where(np.abs(z) <= c.l1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        w = self.weights(at)
        p = 1.0 / (1.0 + np.exp(-np.clip(float(w @ x), -35, 35)))
        g = (p - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.config.alpha * w
        self.n[at] = n + g * g


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]], config: QualityConfig) -> np.ndarray:
    """Weights from (slots, values, label) examples, visited in a fixed shuffled order each epoch."""
    model = Ftrl(config)
    order = np.random.default_rng(7)
    bias = 1 << config.bits
    for _ in range(config.epochs):
        for i in order.permutation(len(examples)):
            at, x, label = examples[i]
            model.update(np.append(at, bias), np.append(x, 1.0), label)
    return model.weights().astype(np.float32)


def held_out(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


def training_examples(docs: DataFrame, labels: DataFrame, config: QualityConfig) -> DataFrame | None:
    """Sparse rows (doc_id, quality, slots, shares) of the bounded training sample, or None without usable labels.

    The ids are fixed first, so only their texts leave the scan. Of rows that repeat a
    doc_id the one with the least hash of its text is taken, in each task and then over all.
    """
    bits, scale = config.bits, config.scale
    # A doc_id with several labels takes the larger; labels other than 0 and 1 and null ids take no part.
    usable = labels.selectExpr("cast(doc_id as long) doc_id", "cast(quality as int) quality").where("doc_id is not null and quality in (0, 1)")
    usable = usable.where(~held_out(F.col("doc_id"), config.folds)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # A hash sample of about max_rows pairs of two numbers, then cut to max_rows: a bound that does not depend on the data.
    below = int(min(1.0, 1.1 * config.max_rows / max(1, usable.count())) * (1 << 31))
    near = usable.select("doc_id", "quality", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)).alias("draw")).where(F.col("draw") < below).collect()
    picked = {r.doc_id: r.quality for r in sorted(near, key=lambda r: (r.draw, r.doc_id))[: config.max_rows]}
    if not picked:
        return None
    sample = docs.sparkSession.createDataFrame(list(picked.items()), "doc_id long, quality int")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = hasher(bits)
        least: dict[int, int] = {}
        for batch, texts in grouped(batches, "text"):
            new = []
            for k, (doc_id, mark) in enumerate(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist())):
                if mark < least.get(doc_id, mark + 1):
                    least[doc_id] = mark
                    new.append(k)
            batch = batch.take(pa.array(new, pa.int64()))
            rows = maker.slots([texts[k] for k in new])
            slots, values = [], []
            for row in rows:
                at, n = np.unique(row, return_counts=True)
                slots.append(at.astype(np.int32))
                values.append((n * (scale / max(1, len(row)))).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(slots, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32())), batch.column(3)],
                ["doc_id", "quality", "slots", "shares", "mark"],
            )

    texts = docs.selectExpr("cast(doc_id as long) doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text", F.xxhash64("text").alias("mark"))
    found = texts.mapInArrow(features, "doc_id long, quality int, slots array<int>, shares array<float>, mark long")
    return found.groupBy("doc_id").agg(F.min_by(F.struct("quality", "slots", "shares"), "mark").alias("row")).select("doc_id", "row.*")


def train(docs: DataFrame, labels: DataFrame, config: QualityConfig | None = None) -> np.ndarray:
    """Fit in one task: the updates follow one another and the sample is bounded. The driver gets the weights alone."""
    config = config or QualityConfig()
    ship_package(docs.sparkSession)
    sample = training_examples(docs, labels, config)
    if sample is None:
        return np.zeros((1 << config.bits) + 1, np.float32)

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        group = pa.Table.from_batches(parts)
        ids = group.column("doc_id").to_numpy()
        slots, shares = group.column("slots").combine_chunks(), group.column("shares").combine_chunks()
        at, ends = slots.values.to_numpy(), slots.offsets.to_numpy()
        values = shares.values.to_numpy()
        labels_of = group.column("quality").to_numpy()
        examples = []
        for i in ids.argsort().tolist():
            part = slice(ends[i], ends[i + 1])
            examples.append((at[part].astype(np.int64), values[part].astype(np.float64), int(labels_of[i])))
        yield pa.RecordBatch.from_arrays([pa.array([fit(examples, config).tobytes()], pa.binary())], ["weights"])

    fitted = sample.repartition(1).mapInArrow(fit_all, "weights binary").collect()
    return np.frombuffer(fitted[0].weights, np.float32) if fitted else np.zeros((1 << config.bits) + 1, np.float32)


def score_texts(texts: list[str], weights: np.ndarray, config: QualityConfig) -> np.ndarray:
    rows = hasher(config.bits).slots(texts)
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    hit = np.concatenate([[0.0], np.cumsum(weights[np.concatenate(rows)] if rows else [], dtype=np.float64)])
    ends = np.cumsum(sizes)
    margin = (hit[ends] - hit[ends - sizes]) * (config.scale / np.maximum(1, sizes)) + float(weights[-1])
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35)))


def scorer(spark: SparkSession, weights: np.ndarray, config: QualityConfig) -> Callable[[str], Column]:
    """A column function from text to score."""
    ship_package(spark)
    sent = spark.sparkContext.broadcast(weights)  # 2**bits + 1 floats, whatever the corpus

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            whole = pa.RecordBatch.from_arrays([pa.array(part, pa.large_string(), from_pandas=True)], ["text"])
            found = [score_texts(texts, sent.value, config) for _, texts in grouped([whole], "text")]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))

    return scored


def accepted(docs: DataFrame, weights: np.ndarray, config: QualityConfig | None = None) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold.

    Defined cases: null and empty texts have the score of the bias alone; repeated rows
    stay or go together; rows without a doc_id are scored like any other; an empty table
    gives no rows.
    """
    config = config or QualityConfig()
    return docs.where(scorer(docs.sparkSession, weights, config)("text") >= config.threshold)


def classify(docs: DataFrame, labels: DataFrame, config: QualityConfig | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Defined cases: a null or empty text scores the bias alone; a null doc_id is never
    held out and never trained on; repeated rows score alike; without usable labels
    every score is 0.5; an empty table gives no rows; only doc_id and text are read
    of documents, only doc_id and quality of labels.
    """
    config = config or QualityConfig()
    weights = train(docs, labels, config)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    scored = rows.select("doc_id", scorer(docs.sparkSession, weights, config)("text").alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id"), config.folds), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= config.threshold, 1).otherwise(0).alias("predicted"),
    )
