"""Embedding near-duplicates by counting collisions of query-centred windows on many projections.

Vectors are normalised and projected onto fixed random directions. Two vectors of
cosine t differ on each projection by a normal variable of deviation sqrt(2 - 2t), so
a window around a query on a sorted projection catches a true partner with a known
probability, and the number of windows that catch it is binomial. The count a pair
must reach is calibrated from that: the largest one that pairs at the threshold
still reach with probability ``recall``. Pairs that reach it are verified by cosine in
double precision.

Vectors with equal labels and equal directions are collapsed first and count by their
number. The rest is dealt by label, length and the signs of ``bits`` more projections;
``bits`` grows with the logarithm of a label's size, so that a cell holds about one
block, and as many tables of such cells are made as it takes to bring a pair at the
threshold into one cell with probability ``1 - loss``. Work and shuffled rows thus grow
with the rows times the number of tables, not with the square of a label. A pair counts in
the first table that brings it together. A crowded cell is cut into salted blocks and
tasks are pairs of blocks: no task holds more than two blocks, whatever one label or
one group of near copies holds. A task reports each vector's number of partners and a
spanning forest of the links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import acos, ceil, comb, erf, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.components import connected
from leafmill.runtime import cut, ship_package


@dataclass(frozen=True)
class CollisionConfig:
    cosine: float = 0.98
    projections: int = 24
    #: Half-width of the counted windows, in deviations of a pair at the threshold.
    window: float = 2.0
    #: Half-width of the window within which pairs are counted at all; it misses such a pair with probability 0.0005.
    routing: float = 3.5
    recall: float = 0.999
    #: Probability that no table of cells brings such a pair together.
    loss: float = 0.0005
    most_bits: int = 20
    block: int = 2048
    seed: int = 11

    @property
    def deviation(self) -> float:
        return sqrt(2 - 2 * self.cosine)

    @property
    def least_count(self) -> int:
        p, m = erf(self.window / sqrt(2)), self.projections
        tail, count = 0.0, m + 1
        while count > 0 and tail < self.recall:
            count -= 1
            tail += comb(m, count) * p**count * (1 - p) ** (m - count)
        return count

    def tables(self, bits: int) -> int:
        """How many tables of ``bits`` signs a pair at the threshold needs."""
        together = (1 - acos(self.cosine) / pi) ** bits
        return 1 if together >= 1 else ceil(log(self.loss) / log(1 - together))


def directions(width: int, config: CollisionConfig) -> np.ndarray:
    """Two leading directions, of which the first one orders a block, then the counted ones; fixed by the seed."""
    return np.random.default_rng(config.seed).standard_normal((2 + config.projections, width))


def sign_codes(units: np.ndarray, config: CollisionConfig, tables: int) -> np.ndarray:
    """One integer of ``most_bits`` signs for each row and table."""
    planes = np.random.default_rng(config.seed + 1).standard_normal((units.shape[1], config.tables(config.most_bits), config.most_bits))[:, :tables]
    signs = (units @ planes.reshape(units.shape[1], -1)).reshape(len(units), tables, config.most_bits) > 0
    return signs @ (1 << np.arange(config.most_bits, dtype=np.int64))


def collide(left: np.ndarray, right: np.ndarray, config: CollisionConfig) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i of left, j of right), in parts, whose windows collide often enough and whose cosine verifies."""
    axes = directions(left.shape[1], config)
    half, least, reach = np.float32(config.window * config.deviation), config.least_count, config.routing * config.deviation
    # Both sides in the order of the leading projection: a run of left rows meets a run of right ones.
    lead_left, lead_right = left @ axes[0], right @ axes[0]
    by_left, by_right = np.argsort(lead_left, kind="stable"), np.argsort(lead_right, kind="stable")
    lead_left, lead_right = lead_left[by_left], lead_right[by_right]
    p_left, p_right = (left[by_left] @ axes[2:].T).astype(np.float32), (right[by_right] @ axes[2:].T).astype(np.float32)
    for a in range(0, len(left), 256):
        own = p_left[a : a + 256]
        m = len(own)
        first, until = np.searchsorted(lead_right, [lead_left[a] - reach, lead_left[a + m - 1] + reach])
        part = p_right[first:until]
        n = len(part)
        if not n:
            continue
        orders = np.argsort(part, axis=0, kind="stable")
        count = np.zeros(m * n, np.uint8)
        for k in range(own.shape[1]):
            ranked = part[orders[:, k], k]
            low = np.searchsorted(ranked, own[:, k] - half, "left")
            sizes = np.searchsorted(ranked, own[:, k] + half, "right") - low
            ends = np.cumsum(sizes)
            at = np.repeat(low - (ends - sizes), sizes) + np.arange(int(ends[-1]))
            # Within one projection a pair collides once at most, so plain indexed addition is enough.
            count[orders[at, k] + np.repeat(np.arange(m) * n, sizes)] += 1
        hit = np.flatnonzero(count >= least)
        i, j = by_left[hit // n + a], by_right[hit % n + first]
        for b in range(0, len(i), 1 << 16):
            ib, jb = i[b : b + (1 << 16)], j[b : b + (1 << 16)]
            good = np.einsum("ij,ij->i", left[ib], right[jb]) >= config.cosine
            yield ib[good], jb[good]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row of every component after the links (i, j)."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        new = np.arange(len(root))
        np.minimum.at(new, np.maximum(a, b), np.minimum(a, b))
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        root = new[root]


def links(vectors: DataFrame, config: CollisionConfig | None = None) -> DataFrame:
    """Rows (vec_id, partners, other): a part of a vector's number of partners, and a vector it is tied to.

    ``vectors`` is (label, vec_id, unit, weight), vec_id unique; a partner counts ``weight`` times.
    """
    config = config or CollisionConfig()
    ship_package(vectors.sparkSession)
    vectors = vectors.withColumn("width", F.size("unit"))
    counts = vectors.groupBy("label", "width").agg(F.count("*").alias("n"))
    bits = F.least(F.lit(config.most_bits), F.ceil(F.log2(F.col("n") / config.block)))
    counts = counts.select("label", "width", F.greatest(F.lit(0), bits).cast("int").alias("bits"))
    tables_of = [config.tables(b) for b in range(config.most_bits + 1)]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            kinds = np.stack([whole.column(k).to_numpy(zero_copy_only=False) for k in (4, 5)], 1).astype(np.int64)
            for width, bits in np.unique(kinds, axis=0).tolist():
                batch = whole.filter(pa.array((kinds == (width, bits)).all(1)))
                codes = sign_codes(_matrix(batch.column(2)), config, tables_of[bits]) & ((1 << bits) - 1)
                lists = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, codes.shape[1], dtype=np.int32), pa.array(codes.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], lists], ["label", "vec_id", "unit", "weight", "width", "codes"])

    rows = vectors.join(counts, ["label", "width"]).select("label", "vec_id", "unit", "weight", "width", "bits")
    # Written once with all its codes; a vector's copies, one a table, are made on the way to their cells.
    coded = cut(rows.mapInArrow(code, "label string, vec_id long, unit array<double>, weight long, width int, codes array<int>"))
    placed = coded.select("*", F.posexplode("codes").alias("table", "code")).withColumn("codes", F.slice("codes", 1, F.col("table")))
    cell = ["label", "width", "table", "code"]
    # Under one crowded cell to a block of rows, so this side stays small beside the other.
    crowded = placed.groupBy(cell).agg(F.ceil(F.count("*") / config.block).cast("int").alias("blocks")).where("blocks > 1")
    tasks = placed.join(crowded, cell, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    tasks = tasks.withColumn("own", F.pmod(F.xxhash64("vec_id", "table"), F.col("blocks")).cast("int"))
    tasks = tasks.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = tasks.select(*cell, F.least("own", "to").alias("s"), F.greatest("own", "to").alias("t"), "vec_id", "unit", "weight", "codes", (F.col("own") <= F.col("to")).alias("first"))

    def search(group: pa.Table) -> pa.Table:
        ids, weights = group.column("vec_id").to_numpy(), group.column("weight").to_numpy().astype(np.float64)
        units, table = _matrix(group.column("unit")), group.column("table")[0].as_py()
        is_first = group.column("first").to_numpy(zero_copy_only=False).astype(bool)
        alone = group.column("s")[0].as_py() == group.column("t")[0].as_py()
        left = np.flatnonzero(is_first)
        right = left if alone else np.flatnonzero(~is_first)
        before = _matrix(group.column("codes"))[:, :table]
        partners, root = np.zeros(len(ids)), np.arange(len(ids))
        for i, j in collide(units[left], units[right], config) if len(left) and len(right) else ():
            i, j = left[i], right[j]
            fresh = (i != j) & ~(before[i] == before[j]).any(1)  # not met in an earlier table
            i, j = i[fresh], j[fresh]
            partners += np.bincount(i, weights[j], len(ids))
            if not alone:
                partners += np.bincount(j, weights[i], len(ids))
            root = _merge(root, i, j)
        met = np.flatnonzero(partners)
        return pa.table({"vec_id": pa.array(ids[met]), "partners": pa.array(partners[met].astype(np.int64)), "other": pa.array(ids[root[met]])})

    return tasks.groupBy(*cell, "s", "t").applyInArrow(search, "vec_id long, partners long, other long")


def usable(vectors: DataFrame) -> DataFrame:
    """(label, vec_id, unit) of the vectors that can link, one row per vec_id."""
    fine = "label is not null and vec_id is not null and embedding is not null and size(embedding) > 0 and not exists(embedding, c -> c is null or isnan(c) or abs(c) = double('infinity'))"
    rows = vectors.where(fine).select(F.col("label").cast("string").alias("label"), F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: c.cast("double")).alias("x"))
    # Divided by the largest component first, so that no square overflows or vanishes; 0.0 is added as -0.0 is no other number.
    rows = rows.withColumn("most", F.array_max(F.transform("x", lambda c: F.abs(c)))).where("most > 0")
    rows = rows.select("label", "vec_id", F.transform("x", lambda c: c / F.col("most")).alias("x"))
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c)))
    rows = rows.select("label", "vec_id", F.transform("x", lambda c: c / F.col("norm") + 0.0).alias("unit"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "unit")).alias("r")).select("r.label", "vec_id", "r.unit")


def near_duplicates(vectors: DataFrame, config: CollisionConfig | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Defined cases: vectors that are null, empty, zero or hold null, NaN or infinite
    components, and rows without label or vec_id, link with nothing (a null vec_id has
    a null component and is not kept); rows that repeat a vec_id are one vector - the
    least (label, vector) - and get equal answers; vectors of different lengths do not
    link; an empty table gives no rows; other columns are ignored.
    """
    config = config or CollisionConfig()
    own = cut(usable(vectors))
    # Equal vectors of a label are one, with a weight, so no group of copies is paired.
    distinct = cut(own.groupBy("label", "unit").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight")))
    copies = own.join(distinct.where("weight > 1").withColumnRenamed("vec_id", "first"), ["label", "unit"]).select("vec_id", "first", (F.col("weight") - 1).alias("same"))
    found = cut(links(distinct, config))
    degree = found.groupBy("vec_id").agg(F.sum("partners").alias("partners")).withColumnRenamed("vec_id", "first")
    roots = connected(found.select(F.col("vec_id").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "first")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(copies, "vec_id", "left")
    rows = rows.select("vec_id", F.coalesce("first", "vec_id").alias("first"), F.coalesce("same", F.lit(0)).alias("same"))
    out = rows.join(degree, "first", "left").join(roots, "first", "left")
    component = F.coalesce("root", "first")
    n_links = (F.col("same") + F.coalesce("partners", F.lit(0))).cast("long")
    return out.select("vec_id", n_links.alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
