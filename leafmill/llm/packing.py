"""Packing documents into fixed token windows by order-preserving dynamic programming.

Documents keep the order in which their scan partition holds them. Cuts may fall
after a document, after a sentence or line, or - inside a sentence longer than a
window - after every full window. Among all such cuttings the program minimises

    padding + penalty of each cut inside a document + a constant per sequence

exactly, with a monotone queue over the reachable window starts. A sequence is
padded to the window unless its length is a power of two, so those lengths are
extra, padding-free transitions.

The program runs over a stream. Sequences are given out as soon as the best cuttings
of all places from which a later sequence may start agree on them, so what is given
out is what one run over the whole shard would give; the rest is carried on. Texts
may be such that they never agree (all documents of half a window, say). Memory stays
bounded by giving out the cheapest cutting once ``atoms_at_most`` are waiting, which
costs at most one more cut, ``window + forced_cut + per_sequence``, each time.

Defined cases: a null or empty text is one end token; repeated rows are packed one
by one; a null doc_id stays null; ties go to the latest window start, then to the
plain transition; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from leafmill.llm.chunks import grouped
from leafmill.llm.tokenizers_fast import json_tokenizer
from leafmill.runtime import ship_package

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_tokens long, padded_tokens long"
)
SEQUENCE_BITS = 33


@dataclass(frozen=True)
class PackingCosts:
    window: int = 2048
    sentence_cut: float = 8.0
    forced_cut: float = 32.0
    per_sequence: float = 24.0
    #: Power-of-two lengths below this one are not sought.
    least_bucket: int = 64
    #: The program is run whenever so many atoms are new.
    atoms_at_once: int = 30_000
    atoms_at_most: int = 480_000

    @property
    def buckets(self) -> tuple[int, ...]:
        sizes, size = [], self.least_bucket
        while size < self.window:
            sizes.append(size)
            size *= 2
        return tuple(sizes)


def padding(length: int, window: int) -> int:
    return 0 if length & (length - 1) == 0 else window - length


def back_pointers(ends: list[int], penalties: list[float], costs: PackingCosts) -> list[int]:
    """For every number of atoms, how many of them come before the last sequence of their cheapest cutting."""
    window, n = costs.window, len(ends)
    totals = [0, *ends]
    # Where a sequence of a power-of-two length can end, and its start: (end, start), in order.
    places = np.array(totals, np.int64)
    hits = []
    for size in costs.buckets:
        at = np.searchsorted(places, places - size)
        j = np.flatnonzero((places[at] == places - size) & (places >= size))
        hits.append(np.stack([j, at[j]], 1))
    exact = np.concatenate([*hits, [[n + 1, 0]]])
    exact = exact[np.argsort(exact[:, 0], kind="stable")].tolist()
    best, back = [0.0] * (n + 1), [0] * (n + 1)
    keys = [0.0] * (n + 1)  # best + total, what a window start costs whoever pads up to the window
    queue, head, e = [0], 0, 0
    fixed, (exact_end, exact_start) = costs.per_sequence + window, exact[0]
    for j in range(1, n + 1):
        total = totals[j]
        least = total - window
        while totals[queue[head]] < least:
            head += 1
        i = queue[head]
        value = keys[i] - total + fixed
        while exact_end == j:
            price = best[exact_start] + costs.per_sequence
            if price <= value:
                value, i = price, exact_start
            e += 1
            exact_end, exact_start = exact[e]
        value += penalties[j - 1]
        best[j], back[j] = value, i
        key = keys[j] = value + total
        while len(queue) > head and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    return back


def best_cuts(ends: list[int], penalties: list[float], costs: PackingCosts) -> list[int]:
    """Indices into ``ends`` (running token totals after each atom) at which the cheapest sequences end."""
    return _path(back_pointers(ends, penalties, costs), len(ends))


def _path(back: list[int], j: int) -> list[int]:
    cuts = []
    while j:
        cuts.append(j - 1)
        j = back[j]
    return cuts[::-1]


def settled(back: list[int], ends: list[int], window: int) -> int:
    """The largest number of atoms that is a cut in the best cutting of every place a later sequence may start from."""
    n = len(ends)
    if ends[-1] < window:
        return 0
    first = int(np.searchsorted(ends, ends[-1] - window, "right")) + 1  # later sequences start here or after
    heads, far = set(range(first, n + 1)), n
    while len(heads) > 1:
        while far not in heads:
            far -= 1
        heads.discard(far)
        heads.add(back[far])
    return heads.pop()


def atoms_of(n_tokens: int, breaks: np.ndarray, costs: PackingCosts) -> tuple[list[int], list[float]]:
    """Token offsets at which a document may be cut and what each cut costs; the last one is its end.

    ``breaks`` ascend.
    """
    places = [x for x in breaks.tolist() if 0 < x < n_tokens]
    places.append(n_tokens)
    out, price, at = [], [], 0
    for end in places:
        while end - at > costs.window:
            at += costs.window
            out.append(at)
            price.append(costs.forced_cut)
        out.append(end)
        price.append(costs.sentence_cut)
        at = end
    price[-1] = 0.0
    return out, price


class _Shard:
    """Packs a stream of documents; holds the documents of the sequences that are not closed yet."""

    def __init__(self, shard: int, costs: PackingCosts):
        self.costs, self.base, self.made = costs, shard << SEQUENCE_BITS, 0
        self.ends: list[int] = []
        self.prices: list[float] = []
        self.total, self.due = 0, costs.atoms_at_once
        self.docs: list[tuple] = []  # (doc_id, ids, tokens already packed, stream position of the first one left)

    def add(self, doc_id, ids: np.ndarray, breaks: np.ndarray) -> list[tuple]:
        places, price = atoms_of(len(ids), breaks, self.costs)
        self.docs.append((doc_id, ids, 0, self.total))
        total = self.total
        self.ends += [total + x for x in places]
        self.prices += price
        self.total += len(ids)
        return self.solve(False) if len(self.ends) >= self.due else []

    def solve(self, last: bool) -> list[tuple]:
        if not self.ends:
            return []
        back = back_pointers(self.ends, self.prices, self.costs)
        n = len(self.ends)
        cuts = _path(back, n if last else settled(back, self.ends, self.costs.window))
        if not last and n - (cuts[-1] + 1 if cuts else 0) >= self.costs.atoms_at_most:
            cuts = _path(back, n)[:-1]
        kept = cuts[-1] + 1 if cuts else 0
        self.due = max(self.costs.atoms_at_once, min(2 * (n - kept), self.costs.atoms_at_most))
        if not cuts:
            return []
        rows, at, which = [], 0, 0
        docs = self.docs
        for cut in cuts:
            until = self.ends[cut]
            length, offset = until - at, 0
            padded = length + padding(length, self.costs.window)
            while at < until:
                doc_id, ids, done, first = docs[which]
                take = min(until, first + len(ids) - done) - at
                piece = ids[done : done + take]
                rows.append((doc_id, done, take, zlib.crc32(piece.astype("<u4").tobytes()), len(ids), self.base + self.made, offset, length, padded, piece))
                offset += take
                at += take
                docs[which] = (doc_id, ids, done + take, at)
                if done + take == len(ids):
                    which += 1
            self.made += 1
        self.docs = [(d, ids, done, first - at) for d, ids, done, first in docs[which:]]
        self.ends = [x - at for x in self.ends[kept:]]
        self.prices = self.prices[kept:]
        self.total -= at
        return rows


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, costs: PackingCosts | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the piece's ids, from which the sequences can be written.

    Each scan partition is a shard of its own, so nothing is shuffled; a shard pads
    its last sequence only. Sequence ids carry the shard in their high bits.
    """
    costs = costs or PackingCosts()
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = json_tokenizer(tokenizer)
        shard = _Shard(TaskContext.get().partitionId(), costs)

        def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(rows), 4096):
                columns = list(zip(*rows[a : a + 4096]))
                arrays = [pa.array(c, pa.int64()) for c in columns[:9]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "padded_tokens"]
                if with_ids:
                    arrays.append(pa.array([c.tolist() for c in columns[9]], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

        for batch, texts in grouped(batches, "text"):
            ids_of = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            for doc_id, (ids, breaks) in zip(ids_of, coder.encode(texts, breaks=True)):
                ids = np.append(ids, np.uint32(end_id)).astype(np.uint32)
                yield from out(shard.add(doc_id, ids, breaks))
        yield from out(shard.solve(True))

    schema = SCHEMA + (", ids array<long>" if with_ids else "")
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)
