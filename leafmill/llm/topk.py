"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates are dealt into blocks, each of which stays in one task while the queries
stream past it, some hundreds at a time: the block is sorted once per dimension. The
queries read all lists in step, each from the ends that their signs prefer; rows met for
the first time are scored in full, for all of these queries in one matrix product. Once
no unseen row can reach a query's kth best score - the sum of the lists' current
contributions lies below it - the query stops. Ties are kept by going on while the bound
equals the kth score.

Blocks are searched in waves of twice as many each time. A query takes its kth best
score so far along to the next wave, whose blocks answer with no lesser scores and stop
once their bounds fall below it. A wave is as large as all before it, so it holds about
k better rows for each query: results grow with the number of waves, not of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.runtime import cut, ship_package

FOUND = "query_id long, vec_id long, score long"
LEAST, MOST = -(2**63), 2**63 - 1
#: So many queries search a block together, and so many rows are scored for them at once.
QUERIES, ROWS = 512, 4096


def quantized(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v): floor(scale * component) of the usable vectors, held at the ends of a long."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = "vec_id is not null and embedding is not null and size(embedding) > 0 and not exists(embedding, c -> c is null or isnan(c) or abs(c) = double('infinity'))"
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v"))


class SortedLists:
    """The sorted lists of one candidate block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest_query: int):
        keep = np.argsort(ids, kind="stable")
        self.ids, vectors = ids[keep], vectors[keep]
        largest = float(np.abs(vectors.astype(np.float64)).max(initial=1)) * max(1.0, float(largest_query)) * max(1, vectors.shape[1])
        # The narrowest type in which every inner product of such numbers is exact; object stands for Python's integers.
        self.kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64 if largest < 2**62 else object
        self.vectors = np.ascontiguousarray(vectors.astype(self.kind))
        # Lists in the narrowest types, filled one by one: this is most of what a task holds.
        narrow = next(t for t in (np.int16, np.int32, np.int64) if not vectors.size or (np.iinfo(t).min <= vectors.min() and vectors.max() <= np.iinfo(t).max))
        self.order = np.empty((vectors.shape[1], len(self.ids)), np.int32)
        self.sorted = np.empty((vectors.shape[1], len(self.ids)), narrow)
        for d in range(vectors.shape[1]):
            self.order[d] = np.argsort(vectors[:, d], kind="stable")
            self.sorted[d] = vectors[self.order[d], d]
        self.reads = 0

    def _products(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        found = queries @ self.vectors[rows].T
        return np.clip(found, LEAST, MOST).astype(np.int64) if self.kind is object else found

    def search(self, query_id: int, query: np.ndarray, k: int, floor: int | None = None, first_depth: int = 32) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best that reach the floor, by score and then by smaller id; rows of the query's own id are left out."""
        return self.search_all(np.array([query_id]), query[None], k, np.array([LEAST if floor is None else floor]), first_depth)[1:]

    def search_all(self, ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray, first_depth: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, row number, score) of every query's k best, as ``search`` gives them; a floor of ``LEAST`` is none.

        The queries read in step, from each end that one of them prefers, so that a row that
        any of them meets is scored for all that still run, in one product.
        """
        n, typed = len(self.ids), queries.astype(self.kind)
        positive, negative = np.maximum(typed, 0), np.minimum(typed, 0)
        # A row of a query's own id takes one of its places until it is dropped.
        places = k + int((np.searchsorted(self.ids, ids, "right") - np.searchsorted(self.ids, ids)).max(initial=0))
        least = floors.astype(np.int64 if self.kind is object else self.kind)
        running, best = np.arange(len(ids)), (np.zeros(0, np.int64),) * 3
        seen, depth, until = np.zeros(n, bool), 0, min(n, first_depth)
        left = n
        while left:
            # No row unseen reaches beyond the first entries unread.
            bound = positive[running] @ self.sorted[:, n - 1 - depth].astype(self.kind) + negative[running] @ self.sorted[:, depth].astype(self.kind)
            running = running[(np.clip(bound, LEAST, MOST).astype(np.int64) if self.kind is object else bound) >= least[running]]
            if not len(running):
                break
            up, down = (queries[running] > 0).any(0), (queries[running] < 0).any(0)
            hit = np.full(n, not (up.any() or down.any()))  # every score is zero
            hit[self.order[up, n - until : n - depth]] = True
            hit[self.order[down, depth:until]] = True
            self.reads += (until - depth) * int(up.sum() + down.sum())
            fresh = np.flatnonzero(hit & ~seen)
            seen |= hit
            left -= len(fresh)
            for first in range(0, len(fresh), ROWS):
                rows = fresh[first : first + ROWS]
                scores = self._products(typed[running], rows)
                of, at = np.nonzero(_highest(scores, least[running], places))
                others = self.ids[rows[at]] != ids[running[of]]
                of, at = of[others], at[others]
                best = _merged(best, (running[of], rows[at], scores[of, at].astype(np.int64)), k)
                full = np.flatnonzero(np.append(best[0][k - 1 :] == best[0][: len(best[0]) - k + 1], False)) + k - 1 if len(best[0]) >= k else []
                least[best[0][full]] = best[2][full]
            depth, until = until, min(n, 2 * until)
        return best


def _highest(scores: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """Which scores of each row reach its ``least``; where many do, only those that the row's k highest hold, ties to the first."""
    hits = scores >= least[:, None]
    many = np.flatnonzero(np.count_nonzero(hits, axis=1) > 4 * k)
    cut_at = scores.shape[1] - k
    if len(many) and cut_at > 0:
        some = scores[many]
        kth = np.partition(some, cut_at, axis=1)[:, cut_at, None]
        ties = some == kth
        hits[many] &= (some > kth) | (ties & (np.cumsum(ties, axis=1, dtype=np.int32) <= k))
    return hits


def _merged(best: tuple[np.ndarray, ...], more: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The k best of each query (number, row, score) of both, by query, score and row."""
    if not len(more[0]):
        return best
    of, rows, scores = (np.concatenate(both) for both in zip(best, more))
    order = np.lexsort((rows, ~scores, of))
    of, rows, scores = of[order], rows[order], scores[order]
    keep = np.arange(len(of)) - np.searchsorted(of, of) < k
    return of[keep], rows[keep], scores[keep]


def _widths(lists: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for every length of the lists."""
    sizes = lists.value_lengths().to_numpy()
    out = []
    for width in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == width)
        out.append((rows, lists.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), width)))
    return out


class _Block:
    """One candidate block while it grows, then its sorted lists by vector length."""

    def __init__(self, largest_query: float):
        self.largest_query, self.parts, self.lists = largest_query, {}, None

    def add(self, ids: np.ndarray, vectors: pa.ListArray) -> None:
        for rows, matrix in _widths(vectors):
            self.parts.setdefault(matrix.shape[1], []).append((ids[rows], matrix))

    def answer(self, ids: np.ndarray, queries: pa.ListArray, floors: np.ndarray, k: int) -> pa.RecordBatch:
        if self.lists is None:
            self.lists = {w: SortedLists(np.concatenate([i for i, _ in own]), np.concatenate([m for _, m in own]), self.largest_query) for w, own in self.parts.items()}
            self.parts = {}
        found = [[np.zeros(0, np.int64)] * 3]
        for rows, matrix in _widths(queries):  # vectors of different lengths have no inner product
            if lists := self.lists.get(matrix.shape[1]):
                of, best, scores = lists.search_all(ids[rows], matrix, k, floors[rows])
                found.append([ids[rows][of], lists.ids[best], scores])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found)], ["query_id", "vec_id", "score"])


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, query_block: int = 1024, candidate_block: int = 131_072) -> DataFrame:
    """query_id, rank, vec_id, score of every query's k best candidates.

    Both frames are (vec_id, v) as ``quantized`` gives them. Rows are dealt by hash of
    vec_id and a serial salt, so that neither repeated ids nor repeated vectors can fill
    one block. A candidate is shuffled once; only while a wave has fewer candidate blocks
    than there are cores is it copied for several groups of queries, of ``query_block`` or more.
    """
    spark = candidates.sparkSession
    ship_package(spark)
    queries, candidates = cut(queries), cut(candidates)
    n_rows, cores = candidates.count(), spark.sparkContext.defaultParallelism
    n_queries, largest = queries.agg(F.count("*"), F.max(F.array_max(F.transform("v", lambda c: F.abs(c.cast("double")))))).first()
    c_blocks = max(1, -(-n_rows // candidate_block))
    deal = F.monotonically_increasing_id()  # ids of the checkpointed rows: the same on every attempt
    spread = lambda n: F.pmod(F.xxhash64("vec_id", deal), F.lit(n)).cast("int")
    blocks = candidates.select("vec_id", "v", spread(c_blocks).alias("cb"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best, first = None, 0
    while first < c_blocks:
        until = min(c_blocks, 2 * first + 1)
        groups = max(1, min(-(-n_queries // query_block), -(-cores // (until - first))))
        asked = queries.select("vec_id", "v", spread(groups).alias("qg"))
        if best is None:
            asked = asked.withColumn("floor", F.lit(None).cast("long"))
        else:
            kth = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
            # A query id may stand for several vectors; each then goes with the floor of all of them, which is theirs together.
            asked = asked.join(kth, asked["vec_id"] == kth["query_id"], "left").drop("query_id")
        wave = blocks.where((F.col("cb") >= first) & (F.col("cb") < until))
        found = _wave(asked, wave, range(first, until), groups, k, largest)
        found = found if best is None else best.drop("rank").unionByName(found)
        best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        first = until
        if first < c_blocks:
            best = cut(best)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _wave(queries: DataFrame, candidates: DataFrame, blocks: range, groups: int, k: int, largest: float) -> DataFrame:
    """(query_id, vec_id, score): what the blocks answer to the queries (vec_id, v, qg, floor), k rows a query and block at most."""
    every = lambda r: F.explode(F.sequence(F.lit(r.start), F.lit(r.stop - 1)))
    q = queries.select("vec_id", "v", F.lit(True).alias("asks"), "qg", "floor").withColumn("cb", every(blocks))
    c = candidates.select("vec_id", "v", F.lit(False).alias("asks"), "cb", F.lit(None).cast("long").alias("floor")).withColumn("qg", every(range(groups)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = None, None
        for batch in batches:
            place = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1, 2)], 1)
            turns = np.append(np.flatnonzero((np.diff(place, axis=0, prepend=place[:1] - 1) != 0).any(1)), len(place)).tolist()
            for a, b in zip(turns[:-1], turns[1:]):
                if tuple(place[a, :2].tolist()) != at:
                    block, at = _Block(largest), tuple(place[a, :2].tolist())
                ids, vectors = batch.column(3).to_numpy()[a:b], batch.column(4).slice(a, b - a)
                if not place[a, 2]:
                    block.add(ids, vectors)
                    continue
                floors = batch.column(5).slice(a, b - a).fill_null(LEAST).to_numpy()
                for first in range(0, b - a, QUERIES):
                    yield block.answer(ids[first : first + QUERIES], vectors.slice(first, QUERIES), floors[first : first + QUERIES], k)

    order = ["cb", "qg", "asks"]
    # A block and group is a task of its own; dealt by hash, some would wait behind others while cores are idle.
    place = ((F.col("cb") - blocks.start) * groups + F.col("qg")).cast("int")
    tasks = q.select(*order, "vec_id", "v", "floor").unionByName(c.select(*order, "vec_id", "v", "floor")).repartitionById(len(blocks) * groups, place).sortWithinPartitions(*order)
    return tasks.mapInArrow(search, FOUND)


def top_k_of_table(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """Top k of the rows whose vec_id is divisible by ``every``, against all rows but those of their own vec_id.

    Defined cases: vectors that are null, empty or hold null, NaN or infinite
    components and rows without a vec_id take no part; components and scores beyond a
    long are held at its ends; repeated (vec_id, vector) rows count once; fewer than k candidates give as many rows; vectors of another length
    than the query's are no candidates; an empty table gives no rows; other columns
    are ignored.
    """
    rows = quantized(vectors).distinct()
    return top_k(rows.where(F.col("vec_id") % every == 0), rows, k)
