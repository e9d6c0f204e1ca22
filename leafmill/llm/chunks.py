"""Batches of whole texts, cut into chunks of which each distinct one is worked on once.

A *chunk* is a stretch of text whose encoding does not depend on its neighbours.
Nothing is kept from batch to batch, so memory is bounded by the batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts of so many bytes are worked on together.
BATCH_BYTES = 3_000_000
#: A run of spaces with what follows it; at the end of a text, with nothing.
_SPACED = re.compile(r" *[^ ]+| +\Z")


def ranges(values: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[first : first + count] of every range, in a row."""
    ends = np.cumsum(counts)
    return values[np.repeat(firsts - (ends - counts), counts) + np.arange(int(counts.sum()))]


class Chunks:
    """Texts as runs of chunks: ``distinct`` ones, and for every text a range of ``rows``, numbers of distinct ones."""

    def __init__(self, keys: pa.Array, firsts: np.ndarray, lengths: np.ndarray):
        encoded = keys.dictionary_encode()
        self.distinct, self.lengths = encoded.dictionary, lengths
        self.rows = ranges(encoded.indices.to_numpy(), firsts, lengths)

    def joined(self, separator: str = "") -> str:
        """All distinct chunks as one text."""
        whole = pa.ListArray.from_arrays([0, len(self.distinct)], self.distinct)
        return pc.binary_join(whole, pa.scalar(separator, self.distinct.type))[0].as_py()

    def gather(self, values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The integers of all texts in a row and the bounds of each, for ``counts`` integers to a distinct chunk, in a row."""
        starts, own = np.cumsum(counts) - counts, counts[self.rows]
        ends = np.append(0, np.cumsum(own))[np.append(0, np.cumsum(self.lengths))]
        return ranges(values, starts[self.rows], own), ends.tolist()


def words_of(texts: list[str]) -> Chunks:
    """Cut at white space, which goes. Unlike Python, the control characters 1C to 1F are none."""
    split = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
    offsets = split.offsets.to_numpy()
    return Chunks(split.values, offsets[:-1].astype(np.int64), np.diff(offsets).astype(np.int64))


def spaced_of(texts: list[str]) -> Chunks:
    """Cut before each run of spaces, of which the first one goes; the first chunk counts as having lost one, too."""
    regular = np.array([bool(t and t[0] != " " and t[-1] != " " and "  " not in t) for t in texts], bool)
    split = pc.split_pattern(pa.array([t for t, r in zip(texts, regular) if r], pa.large_string()), " ")
    others = []
    for text, plain in zip(texts, regular):
        if not plain:
            # A space is put before every text, as its first chunk then has one to lose.
            others.append([x[1:] for x in _SPACED.findall(" " + text)] if text else [])
    lengths, firsts = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    offsets = split.offsets.to_numpy()
    lengths[regular], firsts[regular] = np.diff(offsets), offsets[:-1]
    lengths[~regular] = [len(o) for o in others]
    firsts[~regular] = len(split.values) + np.cumsum(lengths[~regular]) - lengths[~regular]
    return Chunks(pa.concat_arrays([split.values, pa.array([p for o in others for p in o], pa.large_string())]), firsts, lengths)


@lru_cache(maxsize=1)
def _trim():
    import ctypes

    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library, which has its own ways
        return lambda keep: 0


def release_memory() -> None:
    """Give back what a batch has freed: workers live on and share their executor's memory with others."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def grouped(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with about equal bytes of text; null texts count as empty ones.

    A text longer than the bound travels alone.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column)).fill_null("")
        first = size = 0
        for i, n in enumerate(pc.binary_length(texts).to_pylist()):
            if i > first and size + n > max_bytes:
                yield batch.slice(first, i - first), texts.slice(first, i - first).to_pylist()
                first, size = i, 0
            size += n
        yield batch.slice(first), texts.slice(first).to_pylist()
        del batch, texts
        release_memory()
