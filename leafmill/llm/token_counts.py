"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only.

Batches are cut by text size, not by rows. Long texts are split at safe boundaries:
no piece of the model holds a word mark after another character (checked when the
model is loaded), so the place before a run of spaces is never inside a token and
the parts' counts add up to the whole's. Each distinct part of a batch is encoded once.

Defined cases: null and empty texts have zero tokens and zero bytes; repeated rows
count one by one; a null doc_id stays null; an empty table gives no rows; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from leafmill.llm.chunks import grouped, spaced_of
from leafmill.runtime import ship_package

WORD_MARK = "▁"


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.splits = not any(WORD_MARK in p.lstrip(WORD_MARK) for p in pieces)

    def count(self, texts: list[str]) -> np.ndarray:
        if not self.splits:
            return np.array([len(ids) for ids in self.library.encode(texts, num_threads=1)], np.int64)
        parts = spaced_of([t.replace(WORD_MARK, " ") for t in texts])  # one and the same to the model
        # The library puts a word mark before each part: the space that the split took away. A part of nothing is that mark.
        counts = np.array([len(ids) or 1 for ids in self.library.encode(parts.distinct.to_pylist(), num_threads=1)], np.int64)
        running = np.append(0, np.cumsum(counts[parts.rows]))[np.append(0, np.cumsum(parts.lengths))]
        return np.diff(running)


@lru_cache(maxsize=4)
def piece_counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(model)
        for batch, texts in grouped(batches, "text"):
            counts = counter.count(texts)
            sizes = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(sizes), pa.array(counts), pa.array(counts > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
