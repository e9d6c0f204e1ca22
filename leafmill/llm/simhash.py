"""SimHash near-duplicates by vantage-point trees over 64-bit fingerprints.

Search runs over distinct fingerprints. By the pigeonhole principle two fingerprints
that differ in at most 3 bits differ in at most 1 bit of their upper or of their lower
half, so one forest searches each half with radius 1. Distances to a vantage point
obey the triangle bound: a pair within radius r has distances to it that differ by r
at most. At every node the fingerprints up to the threshold go inside, the others
outside, and those inside whose distance lies within r of the threshold also *visit*
the outside branch; all other branches are pruned. Each pair is thus met exactly
where one of its ends lives and the other lives or visits.

The upper levels of the trees are grown on a bounded sample of fingerprints and
route every fingerprint to shards, with the visits over shard boundaries; the lower
levels are grown inside each shard. Shards report a spanning forest of their links,
never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.chunks import grouped
from leafmill.llm.components import connected
from leafmill.runtime import cut, ship_package

SEED = 42
HALVES = (np.uint64(0xFFFFFFFF00000000), np.uint64(0x00000000FFFFFFFF))


@dataclass(frozen=True)
class SimHashConfig:
    words: int = 3
    radius: int = 3
    #: Fingerprints that the routing levels are grown on: a hash sample of about this size. It bounds the shards
    #: to some ten thousand a half; beyond, shards grow with the data, at nine bytes a fingerprint.
    sample: int = 60_000
    #: Shards are cut until their share of the sample stands for about so many fingerprints.
    shard: int = 6_000
    #: Below so many, a branch compares directly.
    leaf: int = 48


# --- fingerprints ---------------------------------------------------------------------------------------------------


def fingerprint(text: str, words: int = 3) -> int:
    """Bit b is set if over half of the shingle hashes have it set."""
    from xxhash import xxh64_intdigest

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(parts)
    if not n:
        return 0
    joined = b" ".join(parts)
    if n <= words:
        return xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, parts), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - words + 1].tolist()
    return majority(np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[words - 1 :].tolist())], "<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have set."""
    total = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 15):  # bounds the bit matrix of very long texts
        total += np.unpackbits(hashes[a : a + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes), bitorder="little").tobytes(), "little")


def named_or_marked(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, text): a row without a doc_id is known by a digest of its text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("doc_id").isNull(), text_mark()).alias("mark"), "text")


def text_mark() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def with_fingerprints(docs: DataFrame, config: SimHashConfig | None = None) -> DataFrame:
    """(doc_id, mark, fp) of every row; fp is the fingerprint as a signed long."""
    config = config or SimHashConfig()
    ship_package(docs.sparkSession)
    words = config.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in grouped(batches, "text"):
            prints = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints)], ["doc_id", "mark", "fp"])

    return named_or_marked(docs).mapInArrow(run, "doc_id long, mark string, fp long")


# --- vantage-point trees --------------------------------------------------------------------------------------------


def _split(values: np.ndarray, first: int, radius: int) -> tuple[int, np.uint64, int, int, int] | None:
    """(half, vantage point, threshold, radius, 0) of a useful cut, or None.

    The tree's own half is tried first; fingerprints that agree there are told apart by
    the other half, in which such a pair may still differ by the full radius.
    """
    n = len(values)
    for half, reach in ((first, 1), (1 - first, radius)):
        best = None
        for pick in (n // 3, n // 2, n - 1):
            vantage = values[pick]
            distance = np.bitwise_count((values ^ vantage) & HALVES[half])
            count = np.bincount(distance, minlength=34)
            inside = np.cumsum(count)
            balance = np.minimum(inside, n - inside)
            crossing = np.array([count[max(0, t - reach + 1) : t + 1].sum() for t in range(34)])
            gain = np.where(balance >= max(1, n // 8), balance - 0.7 * crossing, -1e18)
            t = int(np.argmax(gain))
            if gain[t] > -1e18 and (best is None or gain[t] > best[0]):
                best = (gain[t], vantage, t)
        if best:
            return half, best[1], best[2], reach, 0
    return None


class RoutingTree:
    """The upper levels for one half, grown on a sample; leaves are shards."""

    def __init__(self, sample: np.ndarray, half: int, leaf: int, radius: int):
        self.nodes: list[tuple | None] = []
        self.shards = 0
        todo = [(sample, self._new())]
        while todo:
            values, at = todo.pop()
            cut_at = _split(values, half, radius) if len(values) > leaf else None
            if cut_at is None:
                self.nodes[at] = (self.shards,)
                self.shards += 1
                continue
            own, vantage, threshold, reach, _ = cut_at
            distance = np.bitwise_count((values ^ vantage) & HALVES[own])
            inner, outer = self._new(), self._new()
            self.nodes[at] = (own, int(vantage), threshold, reach, inner, outer)
            todo += [(values[distance <= threshold], inner), (values[distance > threshold], outer)]

    def _new(self) -> int:
        self.nodes.append(None)
        return len(self.nodes) - 1

    def route(self, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(shard, rows of values, whether they live there or visit)."""
        everyone = np.arange(len(values))
        todo = [(0, everyone, np.zeros(0, np.int64))]
        while todo:
            at, home, visit = todo.pop()
            if not len(home) and not len(visit):
                continue
            node = self.nodes[at]
            if len(node) == 1:
                yield node[0], home, True
                yield node[0], visit, False
                continue
            half, vantage, threshold, reach, inner, outer = node
            mask, point = HALVES[half], np.uint64(vantage)
            d_home = np.bitwise_count((values[home] ^ point) & mask).astype(np.int64)
            d_visit = np.bitwise_count((values[visit] ^ point) & mask).astype(np.int64)
            todo.append((inner, home[d_home <= threshold], visit[d_visit <= threshold + reach]))
            crossing = home[(d_home <= threshold) & (d_home > threshold - reach)]
            todo.append((outer, home[d_home > threshold], np.concatenate([crossing, visit[d_visit > threshold - reach]])))


class _Forest:
    """Links found so far among local rows, as labels; keeps one spanning link per merge."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        """Take the links (left, right); only those between rows of different labels are looked at one by one."""
        a, b = self.label[left], self.label[right]
        apart = np.flatnonzero(a != b)
        while len(apart):
            # One link of every pair of labels; what it merges falls out of the rest at once.
            _, firsts = np.unique(np.minimum(a[apart], b[apart]) * len(self.label) + np.maximum(a[apart], b[apart]), return_index=True)
            merged: dict[int, int] = {}

            def root(x: int) -> int:
                while merged.get(x, x) != x:
                    merged[x] = merged.get(merged[x], merged[x])
                    x = merged[x]
                return x

            for k in apart[firsts].tolist():
                x, y = root(int(a[k])), root(int(b[k]))
                if x != y:
                    merged[max(x, y)] = min(x, y)
                    self.links.append((int(left[k]), int(right[k])))
            if merged:
                to = np.arange(len(self.label))
                for x in merged:
                    to[x] = root(x)
                self.label = to[self.label]
            a, b = self.label[left], self.label[right]
            apart = np.flatnonzero(a != b)


def _compare(values: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, forest: _Forest, same: bool) -> None:
    """Direct comparison in blocks; ``same`` halves the work where both sides are the same rows."""
    for a in range(0, len(left), 256):
        rows = left[a : a + 256]
        for b in range(a if same else 0, len(right), 4096):
            columns = right[b : b + 4096]
            near = np.bitwise_count(values[rows][:, None] ^ values[columns][None, :]) <= radius
            i, j = np.nonzero(near)
            if len(i):
                i, j = rows[i], columns[j]
                own = i != j
                i, j = i[own], j[own]
                forest.join(i, j)


def shard_links(values: np.ndarray, lives: np.ndarray, half: int, config: SimHashConfig) -> list[tuple[int, int]]:
    """A spanning forest, as row pairs, of the links that this shard's lower tree meets."""
    forest = _Forest(len(values))
    todo = [(np.flatnonzero(lives), np.flatnonzero(~lives))]
    while todo:
        home, visit = todo.pop()
        if not len(home):
            continue
        cut_at = _split(values[home], half, config.radius) if len(home) > config.leaf else None
        if cut_at is None:
            _compare(values, home, home, config.radius, forest, True)
            if len(visit):
                _compare(values, visit, home, config.radius, forest, False)
            continue
        own, vantage, threshold, reach, _ = cut_at
        mask = HALVES[own]
        d_home = np.bitwise_count((values[home] ^ vantage) & mask).astype(np.int64)
        d_visit = np.bitwise_count((values[visit] ^ vantage) & mask).astype(np.int64)
        todo.append((home[d_home <= threshold], visit[d_visit <= threshold + reach]))
        crossing = home[(d_home <= threshold) & (d_home > threshold - reach)]
        todo.append((home[d_home > threshold], np.concatenate([crossing, visit[d_visit > threshold - reach]])))
    return forest.links


def fingerprint_links(prints: DataFrame, config: SimHashConfig | None = None) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``fp`` within the radius."""
    config = config or SimHashConfig()
    spark = prints.sparkSession
    ship_package(spark)
    total = prints.count()
    # The sample's expected size is a parameter; it only shapes the shards, and every fingerprint is routed through them.
    below = int(min(1.0, config.sample / max(1, total)) * (1 << 31))
    sample = prints.select("fp").where(F.pmod(F.xxhash64("fp"), F.lit(1 << 31)) < below).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    sample = np.random.default_rng(3).permutation(np.sort(sample))
    leaf = max(8, int(config.shard * len(sample) / max(1, total)))
    trees = [RoutingTree(sample, half, leaf, config.radius) for half in (0, 1)]
    sent = spark.sparkContext.broadcast(trees)  # under two nodes per sampled fingerprint
    shards = sum(t.shards for t in trees)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            base = 0
            for half, tree in enumerate(sent.value):
                for shard, rows, lives in tree.route(values):
                    if len(rows):
                        n = len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, base + shard, np.int32)), pa.array(np.full(n, half, np.int32)), pa.array(values[rows].view(np.int64)), pa.array(np.full(n, lives))],
                            ["shard", "half", "fp", "lives"],
                        )
                base += tree.shards

    def search(group: pa.Table) -> pa.Table:
        values = group.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(values, kind="stable")
        lives = group.column("lives").to_numpy(zero_copy_only=False).astype(bool)[order]
        values = values[order]
        links = shard_links(values, lives, group.column("half")[0].as_py(), config)
        pairs = np.array(links, np.int64).reshape(-1, 2)
        signed = values.view(np.int64)
        return pa.table({"a": pa.array(signed[pairs[:, 0]]), "b": pa.array(signed[pairs[:, 1]])})

    routed = prints.select("fp").mapInArrow(route, "shard int, half int, fp long, lives boolean")
    return routed.groupBy("shard").applyInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, config: SimHashConfig | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Defined cases: a null or empty text has fingerprint zero and links like any other;
    texts of fewer words than a shingle hash as a whole; repeated rows get equal
    answers; rows whose doc_id is null take part, and component_id is the least doc_id
    that is not null (null if there is none); an empty table gives no rows; only doc_id
    and text are read.
    """
    rows = _in_components(docs, config or SimHashConfig())
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _in_components(docs: DataFrame, config: SimHashConfig) -> DataFrame:
    rows = cut(with_fingerprints(docs, config))
    return rows.join(components_of(rows, config), "fp")


def components_of(rows: DataFrame, config: SimHashConfig) -> DataFrame:
    """(fp, root, component_id) for rows (doc_id, fp); component_id is null where no row of a component has a doc_id."""
    prints = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected(fingerprint_links(prints, config))
    labelled = prints.join(roots, prints.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    return labelled.join(ids, "root").select("fp", "root", "component_id")


def keep_one(docs: DataFrame, config: SimHashConfig | None = None) -> DataFrame:
    """The documents of which one stands for each component.

    That is the one of the least doc_id, and of rows that repeat this doc_id any one.
    A component of rows without a doc_id keeps one row, of the text with the least
    digest; beside a row that has one, none of them stays. Defined cases: null and empty
    texts are one text; all columns are kept, whatever their names; an empty table gives
    no rows.
    """
    return stand_ins(docs, _in_components(docs, config or SimHashConfig()))


def stand_ins(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents that ``keep_one`` keeps, for rows (doc_id, mark, root, component_id)."""
    columns = docs.columns
    # Texts are shuffled once: the join by doc_id leaves rows where dropping repeats of it wants them.
    ids = rows.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    marks = rows.where("component_id is null").groupBy("root").agg(F.min("mark").alias("kept_mark")).select("kept_mark").distinct()
    named = docs.where(docs["doc_id"].isNotNull())
    named = named.join(ids, named["doc_id"].cast("long") == ids["kept_id"], "left_semi").dropDuplicates(["doc_id"])
    nameless = docs.where(docs["doc_id"].isNull()).select(text_mark().alias("own_mark"), F.struct(*columns).alias("own"))
    nameless = nameless.join(marks, F.col("own_mark") == F.col("kept_mark"), "left_semi").dropDuplicates(["own_mark"])
    return named.unionByName(nameless.select("own.*")).select(*columns)
