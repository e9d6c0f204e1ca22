"""Near-duplicates by exact similarity of word shingles: what the corpus pipeline asks of operator 10.

Two texts are near copies if the Jaccard similarity of their sets of five-word
shingles is 0.8 or more. A pair at 0.8 differs in about ten of 64 SimHash bits, far
more than vantage-point trees can search, so two searches propose: the trees of
``simhash`` tie texts whose fingerprints over these shingles lie within three bits, and
MinHash bands tie texts that agree on all rows of a band. A pair at 0.8 shares none of
the 20 bands of 5 rows once in 2,800 times, a closer pair less often.

Each proposal is a bucket of shingle sets, and every two sets of a bucket are settled
on the sets themselves. Sets that buckets tie together are a family. The sets of a family
of up to ``family`` members travel once, to one task that settles them all. In a larger
family all are compared with its least set first, then with the least set of each of
their buckets that is in another class by then; what is linked is one class. Buckets
that still hold several classes are dealt into blocks: the sets outside the bucket's
largest class meet each other and the blocks of that class, two blocks a task. No task
holds more, whatever one family holds, and sets of one class are never paired.

Defined cases: words and short, null or empty texts as in ``simhash``: a text of
fewer words than a shingle is one shingle, a text without words equals any other such.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.chunks import grouped
from leafmill.llm.components import connected
from leafmill.llm.simhash import SEED, SimHashConfig, fingerprint_links, majority, named_or_marked, stand_ins
from leafmill.runtime import cut, ship_package


@dataclass(frozen=True)
class ShingleConfig:
    words: int = 5
    similarity: float = 0.8
    bands: int = 20
    rows: int = 5
    #: Sets of a family that one task settles as a whole.
    family: int = 256
    #: Sets to a block of a crowded bucket of a larger one.
    block: int = 384


def shingle_hashes(text: str, words: int = 5) -> np.ndarray:
    """The hashes of a text's word shingles, repeats included; one of no bytes where there are no words."""
    from xxhash import xxh64_intdigest

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(parts)
    joined = b" ".join(parts)
    if n <= words:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - words + 1].tolist()
    return np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[words - 1 :].tolist())], np.uint64)


def shingles(text: str, words: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles."""
    return np.unique(shingle_hashes(text, words))


def _key(own: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(own.tobytes(), SEED)


def _factors(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 2**64, (count, 1), np.uint64) | np.uint64(1), rng.integers(0, 2**64, (count, 1), np.uint64)


def min_hashes(own: np.ndarray, factors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One minimum for each multiply-shift hash over a shingle set."""
    least = None
    for a in range(0, len(own), 4096):  # bounds the matrix of very long texts
        part = ((own[None, a : a + 4096] * factors[0] + factors[1]) >> np.uint64(32)).min(1)
        least = part if least is None else np.minimum(least, part)
    return least.astype(np.uint32)


def _buckets(own: np.ndarray, factors: tuple[np.ndarray, np.ndarray], config: ShingleConfig) -> list[int]:
    from xxhash import xxh64_intdigest

    bands = min_hashes(own, factors).reshape(config.bands, config.rows)
    return [xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(bands)]


def _sketches(docs: DataFrame, config: ShingleConfig) -> DataFrame:
    """(doc_id, mark, key, buckets, fp): the key stands for the shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors(config.bands * config.rows)
        for batch, texts in grouped(batches, "text"):
            prints, keys, flat = [], [], []
            for text in texts:
                hashes = shingle_hashes(text, config.words)
                own = np.unique(hashes)
                prints.append(majority(hashes))
                keys.append(_key(own))
                flat.append(_buckets(own, factors, config))
            prints, keys, flat = (np.array(x, np.uint64).view(np.int64) for x in (prints, keys, flat))
            places = pa.array(np.arange(0, flat.size + 1, config.bands, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys), pa.ListArray.from_arrays(places, pa.array(flat.ravel())), pa.array(prints)], ["doc_id", "mark", "key", "buckets", "fp"])

    return named_or_marked(docs).mapInArrow(run, "doc_id long, mark string, key long, buckets array<long>, fp long")


def _sets(docs: DataFrame, config: ShingleConfig) -> DataFrame:
    """(key, root, own): each row's shingle set as bytes; ``docs`` is (root, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in grouped(batches, "text"):
            sets = [shingles(t, config.words) for t in texts]
            keys = np.array([_key(s) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "root", "own"])

    return docs.select("root", "text").mapInArrow(run, "key long, root long, own binary")


def alike(left: int, right: int, common: np.ndarray | int, config: ShingleConfig) -> np.ndarray | bool:
    return common >= config.similarity * (left + right - common) - 1e-9


def settle(sets: list[np.ndarray], classes: np.ndarray, config: ShingleConfig) -> list[tuple[int, int]]:
    """Index pairs that link all classes which hold two sets of the wanted similarity.

    The sets' common shingles are counted through lists of the sets that hold each
    shingle; sets of one class, as far as it is known by then, are not compared.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, tokens, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    lists = np.repeat(np.arange(n), sizes)[np.argsort(tokens, kind="stable")]
    firsts = np.cumsum(holders) - holders
    at = np.cumsum(sizes) - sizes
    _, label = np.unique(classes, return_inverse=True)
    rare = np.bincount(label)[label] * 2 <= n  # sets of a class that holds most of them are met from the other side
    out = []
    for i in np.flatnonzero(rare).tolist():
        own = tokens[at[i] : at[i] + sizes[i]]
        own = own[holders[own] > 1]
        common = np.zeros(n, np.int64)
        step = max(1, 2_000_000 // n)  # bounds the gathered lists
        for k in range(0, len(own), step):
            part = own[k : k + step]
            ends = np.cumsum(holders[part])
            places = np.repeat(firsts[part] - (ends - holders[part]), holders[part]) + np.arange(ends[-1])
            common += np.bincount(lists[places], minlength=n)
        for j in np.flatnonzero(alike(sizes, sizes[i], common, config) & (label != label[i])).tolist():
            if label[j] != label[i]:
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def _verified(pairs: DataFrame, sets: DataFrame, config: ShingleConfig) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose sets have the wanted similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (map(np.frombuffer, batch.column(k).to_pylist(), repeat(np.uint64)) for k in (2, 3))
            good = [bool(alike(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), config)) for x, y in zip(left, right)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(sets.select(F.col("key").alias("a"), F.col("own").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("own").alias("y")), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _between_classes(members: DataFrame, sets: DataFrame, config: ShingleConfig) -> DataFrame:
    """Links (a, b) between the classes of every bucket, for rows (bucket, key, class)."""
    held = members.groupBy("bucket", "class").agg(F.count("*").alias("n"))
    split = held.groupBy("bucket").agg(F.max(F.struct("n", "class")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("classes")).where("classes > 1")
    blocks = lambda n: F.ceil(n / config.block).cast("int")
    split = split.select("bucket", F.col("top.class").alias("main"), blocks(F.col("top.n")).alias("mains"), blocks(F.col("n") - F.col("top.n")).alias("others"))
    salt = lambda n: F.pmod(F.xxhash64("key", "bucket"), F.col(n)).cast("int")
    rest = members.join(split, "bucket")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    other = rest.where("class <> main").withColumn("s", salt("others"))
    other_other = other.withColumn("t", F.explode(upto("others"))).select("bucket", F.lit(False).alias("main"), F.least("s", "t").alias("s"), F.greatest("s", "t").alias("t"), "key", "class")
    other_main = other.withColumn("t", F.explode(upto("mains"))).select("bucket", F.lit(True).alias("main"), "s", "t", "key", "class")
    main_other = rest.where("class = main").withColumn("t", salt("mains")).withColumn("s", F.explode(upto("others"))).select("bucket", F.lit(True).alias("main"), "s", "t", "key", "class")
    tasks = other_other.unionByName(other_main).unionByName(main_other).join(sets, "key")

    return tasks.groupBy("bucket", "main", "s", "t").applyInArrow(lambda group: _search(group, "class", config), "a long, b long")


def _search(group: pa.Table, classes: str | None, config: ShingleConfig) -> pa.Table:
    """Links (a, b) between the classes of a group of sets, each set its own class if ``classes`` names no column."""
    keys, firsts = np.unique(group.column("key").to_numpy(), return_index=True)
    own = group.column("own")
    sets = [np.frombuffer(own[k].as_py(), np.uint64) for k in firsts.tolist()]
    links = settle(sets, group.column(classes).to_numpy()[firsts] if classes else np.arange(len(keys)), config)
    pairs = keys[np.array(links, np.int64).reshape(-1, 2)]
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def _large_links(members: DataFrame, sets: DataFrame, config: ShingleConfig) -> DataFrame:
    """Links (a, b) that connect what is alike in the large families, for rows (bucket, hub, key, root)."""
    stars = members.where("key <> root").select(F.col("root").alias("a"), F.col("key").alias("b")).distinct()
    first = cut(_verified(stars, sets, config))
    # The root of a family is its least key, so a verified star needs no search for its component.
    tied = first.select(F.col("b").alias("key"), F.col("a").alias("class"))
    classed = members.join(tied, "key", "left").withColumn("class", F.coalesce("class", "key"))
    hubs = tied.select(F.col("key").alias("hub"), F.col("class").alias("hub_class"))
    apart = classed.join(hubs, "hub", "left").where("class <> coalesce(hub_class, hub) and key <> hub").select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct()
    second = cut(_verified(apart, sets, config))
    known = first.unionByName(second)
    classes = connected(known)
    labelled = members.drop("root").join(classes.withColumnRenamed("node", "key"), "key", "left").select("bucket", "key", F.coalesce("root", "key").alias("class"))
    return known.unionByName(_between_classes(labelled, sets, config))


def components_of(docs: DataFrame, rows: DataFrame, config: ShingleConfig) -> DataFrame:
    """(key, root, component_id) for the sketched ``rows`` of ``docs``."""
    prints = cut(rows.groupBy("key").agg(F.min("doc_id").alias("least"), F.any_value("buckets").alias("buckets"), F.any_value("fp").alias("fp")))
    trees = connected(fingerprint_links(prints.select("fp").distinct(), SimHashConfig(words=config.words)))
    near = prints.select("key", "fp").join(trees.withColumnRenamed("node", "fp"), "fp", "left").select("key", F.xxhash64(F.lit("fp"), F.coalesce("root", "fp")).alias("bucket"))
    held = prints.select("key", F.explode("buckets").alias("bucket")).unionByName(near)
    sizes = held.groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("hub"), F.bit_xor(F.xxhash64("key")).alias("mark")).where("n > 1")
    # Of buckets with the same members one is enough.
    sizes = sizes.groupBy("hub", "n", "mark").agg(F.min("bucket").alias("bucket"))
    members = cut(held.join(sizes.select("bucket", "hub"), "bucket").select("bucket", "hub", "key"))
    families = connected(members.where("key <> hub").select(F.col("hub").alias("a"), F.col("key").alias("b")))
    families = cut(families.join(families.groupBy("root").agg(F.count("*").alias("size")), "root").select(F.col("node").alias("key"), "root", (F.col("size") > config.family).alias("large")))
    wanted = families.join(prints.select("key", "least"), "key")
    # One row stands for each set: the one of its least doc_id, or any where none has one.
    named = docs.join(wanted.where("least is not null").select(F.col("least").alias("wanted_id"), "root").distinct(), F.col("doc_id").cast("long") == F.col("wanted_id"))
    nameless = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("root"), "text")
    found = _sets(named.select("root", "text"), config)
    found = found.unionByName(_sets(nameless, config).drop("root").join(wanted.where("least is null").select("key", "root"), "key"))
    small, large = families.where("not large").select("root").distinct(), families.where("large").select("key", "root")
    whole = found.join(small, "root", "left_semi").groupBy("root").applyInArrow(lambda group: _search(group, None, config), "a long, b long")
    own = cut(found.join(large.select("key"), "key", "left_semi").select("key", "own").dropDuplicates(["key"]))
    crowded = members.join(large, "key")
    links = _large_links(crowded, own, config) if not large.isEmpty() else crowded.select(F.col("key").alias("a"), F.col("key").alias("b"))
    roots = connected(whole.unionByName(links))
    labelled = cut(prints.select("key", "least").join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", "least", F.coalesce("root", "key").alias("root")))
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    return labelled.join(ids, "root").select("key", "root", "component_id")


def _in_components(docs: DataFrame, config: ShingleConfig) -> DataFrame:
    ship_package(docs.sparkSession)
    rows = cut(_sketches(docs, config))
    return rows.select("doc_id", "mark", "key").join(components_of(docs, rows, config), "key")


def near_duplicates(docs: DataFrame, config: ShingleConfig | None = None) -> DataFrame:
    """doc_id and component_id (the least doc_id that is not null, null if there is none) of every row.

    Defined cases: those of the module's head; repeated rows get equal answers; rows
    without a doc_id take part; an empty table gives no rows; only doc_id and text are read.
    """
    return _in_components(docs, config or ShingleConfig()).select("doc_id", "component_id")


def keep_one(docs: DataFrame, config: ShingleConfig | None = None) -> DataFrame:
    """The documents of which one stands for each component, by the rules and defined cases of ``simhash.keep_one``."""
    return stand_ins(docs, _in_components(docs, config or ShingleConfig()))
