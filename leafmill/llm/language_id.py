"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and reduced to its words, runs of letters and their marks. The
n-grams of one to four characters of each word, with the space on either side of it,
are hashed into ``2**bits`` slots. As a naive Bayes score is a sum over n-grams, it is
also one over words: each distinct word of a batch is scored once, and a document adds
up its words' scores. Log-probabilities are fixed-point integers, so that sums are
exact and the same however rows are batched.

Fitting looks at a bounded, documented number of rows a language (``max_rows``), drawn
by a hash of doc_id; Spark adds up their n-gram counts. The matrix of log-probabilities,
``max_cells`` numbers at most, is broadcast; scoring reads every whole text once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.chunks import Chunks, grouped
from leafmill.runtime import ship_package

UNKNOWN = "und"
SPACE = 32
#: Log-probabilities are kept as whole multiples of 1 / UNIT.
UNIT = 1 << 16


@dataclass(frozen=True)
class LanguageConfig:
    longest: int = 4
    bits: int = 16
    #: Fitting bound: about so many documents a language are looked at, drawn by a hash of doc_id.
    max_rows: int = 2000
    #: Fitting bound: the languages with the most rows are learned, ties by name.
    max_languages: int = 512
    #: Slots are halved until languages times slots are no more.
    max_cells: int = 1 << 21
    alpha: float = 0.1
    #: Rows whose crc32(doc_id) modulo ``folds`` is ``fold`` are never learned from.
    folds: int = 4
    fold: int = 2
    #: N-grams are hashed in stretches of so many characters.
    stretch: int = 1 << 18


def slot_bits(languages: int, config: LanguageConfig) -> int:
    return max(4, min(config.bits, (config.max_cells // max(1, languages)).bit_length() - 1))


def words_of(texts: list[str]) -> tuple[Chunks, np.ndarray]:
    """The words of all texts, and whether each text has a letter."""
    lower = pc.utf8_lower(pa.array(texts, pa.large_string()))
    letters = pc.replace_substring_regex(lower, r"[^\p{L}\p{M}]+", " ")
    split = pc.split_pattern(pc.utf8_trim(letters, " "), " ")
    offsets = split.offsets.to_numpy().astype(np.int64)
    return Chunks(split.values, offsets[:-1], np.diff(offsets)), pc.match_substring_regex(letters, r"\p{L}").to_numpy(zero_copy_only=False)


def grams(words: Chunks, bits: int, longest: int, stretch: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, distinct words) of all n-grams, in stretches: an n-gram has no space but at its ends and is no space alone."""
    points = np.frombuffer(f" {words.joined(' ')} ".encode("utf-32-le", "surrogatepass"), "<u4")
    spaces = points == SPACE
    owner = np.cumsum(spaces) - 1  # a space counts to the word after it
    shift = np.uint64(64 - bits)
    for a in range(0, len(points), stretch):
        part = points[a : a + stretch + longest - 1].astype(np.uint64)
        gap = spaces[a : a + stretch + longest - 1]
        mine = owner[a : a + stretch]
        hashed = np.zeros(len(mine), np.uint64)
        whole = np.ones(len(mine), bool)
        for n in range(1, longest + 1):
            m = min(len(mine), len(part) - n + 1)
            if m <= 0:
                break
            hashed, whole = hashed[:m] * np.uint64(0x100000001B3) + part[n - 1 : n - 1 + m] + np.uint64(1), whole[:m]
            if n > 2:
                whole = whole & ~gap[n - 2 : n - 2 + m]
            blank = gap[:m] & gap[n - 1 : n - 1 + m] if n <= 2 else np.zeros(m, bool)
            good = np.flatnonzero(whole & ~blank)
            yield ((hashed[good] ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int32), mine[good]


@dataclass
class LanguageModel:
    languages: list[str]
    bits: int
    #: languages x slots, in 1 / UNIT.
    log_likelihood: np.ndarray
    log_prior: np.ndarray
    config: LanguageConfig

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities, texts x languages, in 1 / UNIT, and whether each text has a letter."""
        words, lettered = words_of(texts)
        n = len(words.distinct)
        by_word = np.zeros((len(self.languages), n), np.int64)
        for slots, owners in grams(words, self.bits, self.config.longest, self.config.stretch):
            for k, row in enumerate(self.log_likelihood):
                by_word[k] += np.bincount(owners, row[slots], n).astype(np.int64)[:n]  # whole numbers, exact
        ends = np.append(0, np.cumsum(words.lengths))
        out = np.empty((len(texts), len(self.languages)), np.int64)
        for k in range(len(self.languages)):
            sums = np.append(0, np.cumsum(by_word[k][words.rows]))
            out[:, k] = sums[ends[1:]] - sums[ends[:-1]] + self.log_prior[k]
        return out, lettered

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The likeliest language, ties by name, with its posterior; texts without a letter are unknown, at 0."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        scores, lettered = self.scores(texts)
        best = scores.argmax(1)
        posterior = 1.0 / np.exp((scores - scores.max(1, keepdims=True)) / UNIT).sum(1)
        return [self.languages[b] if known else UNKNOWN for b, known in zip(best.tolist(), lettered.tolist())], np.where(lettered, posterior, 0.0)


def held_out(doc_id: Column, config: LanguageConfig) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % config.folds == config.fold


def _sampled_counts(docs: DataFrame, drawn: DataFrame, bits: int, config: LanguageConfig) -> DataFrame:
    """(language, slot, n) of the drawn rows; of rows that repeat a doc_id the one with the least hash counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, int] = {}
        for batch, texts in grouped(batches, "text"):
            for doc_id, language, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), texts):
                if mark >= least.get(doc_id, mark + 1):
                    continue  # a repeat that an earlier one stands for; so a task gives few rows for each drawn doc_id
                least[doc_id] = mark
                words, _ = words_of([text])
                repeats = np.bincount(words.rows, minlength=len(words.distinct))
                total = np.zeros(1 << bits)
                for slots, owners in grams(words, bits, config.longest, config.stretch):
                    total += np.bincount(slots, repeats[owners], 1 << bits)
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id]), pa.array([language], pa.string()), pa.array([mark]), pa.array([at.astype(np.int32)], pa.list_(pa.int32())), pa.array([total[at].astype(np.int64)], pa.list_(pa.int64()))],
                    ["doc_id", "lang", "mark", "slots", "counts"],
                )

    rows = docs.join(F.broadcast(drawn), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < F.col("below"))
    rows = rows.select("doc_id", "lang", "text", F.xxhash64("lang", "text").alias("mark")).mapInArrow(count, "doc_id long, lang string, mark long, slots array<int>, counts array<long>")
    one = rows.groupBy("doc_id").agg(F.min_by(F.struct("lang", "slots", "counts"), "mark").alias("row"))
    pairs = one.select("row.lang", F.inline(F.arrays_zip(F.col("row.slots").alias("slot"), F.col("row.counts").alias("n"))))
    return pairs.groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, config: LanguageConfig | None = None) -> LanguageModel:
    """Fit on the rows outside the held-out fold that have a lang and a doc_id."""
    config = config or LanguageConfig()
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    rows = rows.where(~held_out(F.col("doc_id"), config)).where("lang is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(config.max_languages).collect()
    sizes = sorted((r.lang, r.n) for r in sizes)
    languages, bits = [name for name, _ in sizes], slot_bits(len(sizes), config)
    if not sizes:
        return LanguageModel([], bits, np.zeros((0, 1 << bits), np.int32), np.zeros(0, np.int64), config)
    drawn = docs.sparkSession.createDataFrame([(name, int(min(1.0, config.max_rows / n) * (1 << 31))) for name, n in sizes], "lang string, below long")
    found = _sampled_counts(rows, drawn, bits, config).toPandas()  # max_cells rows at most
    counts = np.zeros((len(languages), 1 << bits))
    place = {name: k for k, name in enumerate(languages)}
    counts[found["lang"].map(place).to_numpy(int), found["slot"].to_numpy(int)] = found["n"].to_numpy(float)
    share = (counts + config.alpha) / (counts.sum(1, keepdims=True) + config.alpha * (1 << bits))
    prior = np.log(np.array([n for _, n in sizes]) / sum(n for _, n in sizes))
    return LanguageModel(languages, bits, np.rint(np.log(share) * UNIT).astype(np.int32), np.rint(prior * UNIT).astype(np.int64), config)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)  # max_cells numbers of four bytes at most

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in grouped(batches, "text"):
            names, posteriors = sent.value.predict(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(posteriors, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.select("doc_id", F.coalesce(held_out(F.col("doc_id"), model.config), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame, config: LanguageConfig | None = None) -> DataFrame:
    """Learn from the rows outside the held-out fold, predict for all.

    Defined cases: a null text, an empty one and one without a letter are ``und`` with
    score 0; so is every text where no row has a lang to learn; a null doc_id is neither
    held out nor learned from; rows that repeat a doc_id are learned once; equal scores
    go to the smaller name; repeated rows get equal answers; an empty table gives no
    rows; lang and source are no input of a prediction, other columns are ignored.
    """
    return identify(docs, train(docs, config))
