"""Merkle manifest of a dataset: a hash tree per language, one tree over their roots, and a proof for every document.

Leaves are hashed by Spark at the scan; texts go no further. Rows are ranged and sorted
by language and doc_id, and their places follow from the sizes of the sorted parts. A
language's places are cut into aligned buckets of ``2**bits`` leaves, whose root lies on
one level of the tree whatever its neighbours are. Executors fold a bucket with DuckDB,
level by level, by ordered ``string_agg`` and ``sha256`` over Arrow tables. The roots of
the buckets are the nodes of a smaller tree that is folded the same way, until one node
a language is left. Then paths go down again: a bucket's own path to the root is joined
with it, and a second DuckDB pass gives each leaf its siblings and folds them.

A path is a list of steps, one a level: the sibling's hash after ``L`` or ``R``, the side
it stands on, or nothing where a node is alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.runtime import cut, ship_package


@dataclass(frozen=True)
class MerkleConfig:
    #: Buckets are of 2**bits leaves.
    bits: int = 13
    #: Broadcast the sizes of the sorted parts up to so many rows.
    small: int = 50_000


# --- leaves ---------------------------------------------------------------------------------------------------------


def field(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(n_chars: Column) -> Column:
    return F.unhex(F.sha2(F.concat(field(F.col("doc_id")), field(F.col("source")), field(F.col("lang")), field(n_chars), field(F.col("text"))), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, tampered) of every row; ``tampered`` is null where tampering changes nothing.

    ``tree`` names the language so that none comes first and the others follow by their bytes.
    """
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text")
    chosen = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    one_more = F.col("n_chars").cast("decimal(20,0)") + 1
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    return rows.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf(F.col("n_chars")).alias("leaf"), F.when(chosen, leaf(one_more)).alias("tampered"))


def placed(rows: DataFrame, order: list[str], config: MerkleConfig) -> DataFrame:
    """The rows with ``pos``, their place in their tree by ``order``, and ``total``, the tree's size.

    ``row`` settles ties between rows that repeat, so that ranges split them, too.
    """
    keys = [F.col("tree"), *[F.asc_nulls_first(c) for c in order], F.col("row")]
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("row"))
    rows = rows.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    runs = rows.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")  # a row for each part
    runs = cut(runs.select("tree", "part", "first", (F.sum("n").over(tree.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(tree).alias("total")))
    if runs.count() <= config.small:
        runs = F.broadcast(runs)
    return rows.join(runs, ["tree", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("part", "at", "first", "before")


# --- the block engine -----------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def engine():
    """This worker's DuckDB; a bucket's tables replace those of the one before."""
    import duckdb

    return duckdb.connect(config={"threads": 1, "memory_limit": "512MB"})


def levels_of(total: int, bits: int) -> int:
    """How many levels a bucket of a tree of so many nodes has above it, within the bucket."""
    return min(bits, max(0, total - 1).bit_length())


def fold(nodes: pa.Table, levels: int) -> str:
    """Fill table ``node`` (level, pos, hash) from nodes (pos, hash) upwards; the hash at the top.

    Two consecutive nodes become one; a last one that is alone is hashed alone.
    """
    db = engine()
    db.register("given", nodes)
    db.execute("CREATE OR REPLACE TEMP TABLE node AS SELECT 0 AS level, pos, hash FROM given")
    for level in range(levels):
        db.execute(f"INSERT INTO node SELECT {level + 1}, pos >> 1, sha256(string_agg(hash, '' ORDER BY pos)) FROM node WHERE level = {level} GROUP BY pos >> 1")
    return db.execute(f"SELECT hash FROM node WHERE level = {levels}").fetchall()[0][0]


def local(group: pa.Table, bits: int) -> pa.Table:
    """(pos, hash), places counted from the bucket's start: its start is a multiple of its size, so sides stay."""
    first = group.column("bucket")[0].as_py() << bits
    return pa.table({"pos": pa.array([p - first for p in group.column("pos").to_pylist()], pa.int64()), "hash": group.column("hash").cast(pa.string())})


def bucket_root(group: pa.Table, bits: int) -> pa.Table:
    total = group.column("total")[0].as_py()
    top = fold(local(group, bits), levels_of(total, bits))
    above = -(-total // (1 << bits))
    return pa.table({"tree": group.column("tree")[:1], "pos": group.column("bucket")[:1], "total": pa.array([above], pa.int64()), "hash": pa.array([top])})


PATHS = "SELECT n.pos, list(CASE WHEN s.hash IS NULL THEN '' WHEN (n.pos >> l.level) & 1 = 1 THEN 'L' || s.hash ELSE 'R' || s.hash END ORDER BY l.level) AS path FROM (SELECT pos FROM node WHERE level = 0) n, (SELECT unnest(range({levels})) AS level) l LEFT JOIN node s ON s.level = l.level AND s.pos = xor(n.pos >> l.level, 1) GROUP BY n.pos ORDER BY n.pos"


def node_paths(group: pa.Table, above: pa.Table, bits: int) -> pa.Table:
    """(tree, pos, path, top) of inner nodes: their steps in the bucket, then the bucket's own."""
    levels = levels_of(group.column("total")[0].as_py(), bits)
    nodes = local(group, bits)
    fold(nodes, levels)
    rest, top = above.column("path")[0].as_py(), above.column("top")[0].as_py()
    own = dict(engine().execute(PATHS.format(levels=levels)).fetchall()) if levels else {}
    n = group.num_rows
    return pa.table({"tree": group.column("tree"), "pos": group.column("pos"), "path": pa.array([own.get(p, []) + rest for p in nodes.column("pos").to_pylist()], pa.list_(pa.string())), "top": pa.array([top] * n, pa.string())})


def witnesses(group: pa.Table, above: pa.Table, bits: int) -> pa.Table:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root) of a bucket's leaves."""
    db, levels = engine(), levels_of(group.column("total")[0].as_py(), bits)
    nodes = local(group, bits)
    fold(nodes, levels)
    path, subroot, root = (above.column(c)[0].as_py() for c in ("path", "subroot", "top"))
    db.register("start", nodes.append_column("now", group.column("tampered").cast(pa.string())))
    db.execute("CREATE OR REPLACE TEMP TABLE climb AS SELECT pos, coalesce(now, hash) AS now, '' AS proof FROM start")
    for level in range(levels):
        db.execute(
            f"CREATE OR REPLACE TEMP TABLE climb AS SELECT c.pos, sha256(CASE WHEN s.hash IS NULL THEN c.now WHEN (c.pos >> {level}) & 1 = 1 THEN s.hash || c.now ELSE c.now || s.hash END) AS now, "
            f"c.proof || coalesce(s.hash, '') AS proof FROM climb c LEFT JOIN (SELECT pos, hash FROM node WHERE level = {level}) s ON s.pos = xor(c.pos >> {level}, 1)"
        )
    now = "now"
    for step in path:
        now = f"sha256({now})" if not step else f"sha256('{step[1:]}' || {now})" if step[0] == "L" else f"sha256({now} || '{step[1:]}')"
    outer = "".join(step[1:] for step in path)
    found = db.sql(f"SELECT sha256(proof || '{outer}') AS proof_sha256, {now} AS folded_root FROM climb ORDER BY pos").to_arrow_table().combine_chunks()
    order = nodes.column("pos").to_numpy().argsort()
    group, n = group.take(pa.array(order)), group.num_rows
    return pa.table(
        {
            "doc_id": group.column("doc_id"), "leaf": group.column("hash").cast(pa.string()), "subroot": pa.array([subroot] * n), "root": pa.array([root] * n),
            "proof_sha256": found.column("proof_sha256").cast(pa.string()), "folded_root": found.column("folded_root").cast(pa.string()),
        }
    )


# --- trees over buckets ---------------------------------------------------------------------------------------------


def bucketed(nodes: DataFrame, bits: int) -> DataFrame:
    return nodes.withColumn("bucket", F.expr(f"shiftright(pos, {bits})"))


def folded(nodes: DataFrame, bits: int) -> DataFrame:
    """The bucket roots as nodes (tree, pos, total, hash)."""

    def root(group: pa.Table) -> pa.Table:
        return bucket_root(group, bits)

    groups = bucketed(nodes.select("tree", "pos", "total", "hash"), bits).groupBy("tree", "bucket")
    return cut(groups.applyInArrow(root, "tree string, pos long, total long, hash string"))


def towers(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """The nodes of every tree folded again and again; the last has one node a tree."""
    out = [folded(nodes, bits)]
    while out[-1].agg(F.max("total")).first()[0] not in (None, 1):
        out.append(folded(out[-1], bits))
    return out


def descend(levels: list[DataFrame], paths: DataFrame, bits: int) -> DataFrame:
    """Paths (tree, pos, path, top) of the nodes of the first level, from those of the last level's."""

    def extended(group: pa.Table, above: pa.Table) -> pa.Table:
        return node_paths(group, above, bits)

    for nodes in reversed(levels[:-1]):
        above = paths.withColumnRenamed("pos", "bucket")
        paths = _cogrouped(bucketed(nodes, bits), above).applyInArrow(extended, "tree string, pos long, path array<string>, top string")
    return paths


def _cogrouped(nodes: DataFrame, above: DataFrame):
    return nodes.groupBy("tree", "bucket").cogroup(above.groupBy("tree", "bucket"))


def manifest(docs: DataFrame, config: MerkleConfig | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Defined cases: null fields are hashed as ``-``; a null lang is a language of its own
    before all others, and not the empty one; rows without a doc_id come first in their
    language and are not tampered with; rows that share a doc_id follow by their leaves,
    and equal rows are leaves of their own; tampering counts without overflow; a table
    of one row is its own root, with the proof of no siblings; an empty table gives no
    rows; other columns are ignored.
    """
    config = config or MerkleConfig()
    spark, bits = docs.sparkSession, config.bits
    ship_package(spark)
    rows = placed(cut(leaves(docs)), ["doc_id", "leaf"], config)
    rows = rows.select("tree", "pos", "total", "doc_id", F.lower(F.hex("leaf")).alias("hash"), F.lower(F.hex("tampered")).alias("tampered"))
    inner = towers(rows, bits)
    # The languages' roots are the nodes of one more tree; there, ``name`` is the language.
    subroots = inner[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("hash"))
    outer_nodes = cut(placed(subroots, ["name"], config))
    outer = towers(outer_nodes, bits)
    tops = outer[-1].select("tree", "pos", F.array().cast("array<string>").alias("path"), F.col("hash").alias("top"))
    outer_paths = descend([outer_nodes, *outer], tops, bits)
    paths = outer_nodes.join(outer_paths, ["tree", "pos"]).select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", "top")
    subs = inner[-1].select("tree", F.col("hash").alias("subroot"))
    above = descend(inner, paths, bits).withColumnRenamed("pos", "bucket").join(subs, "tree")

    def proven(group: pa.Table, above: pa.Table) -> pa.Table:
        return witnesses(group, above, bits)

    found = _cogrouped(bucketed(rows, bits), above).applyInArrow(proven, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


#: The same in DuckDB, by recursion over whole levels.
MERKLE_SQL = """
WITH RECURSIVE
b AS (
  SELECT doc_id, source, lang, n_chars, text,
    xor(list_reduce(
      list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS UBIGINT))),
      lambda c, x: list_reduce(
        list_prepend(xor(c, x), CAST(range(8) AS UBIGINT[])),
        lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, CAST(3988292384 AS UBIGINT)) ELSE y >> 1 END)), CAST(4294967295 AS UBIGINT)) % 7 = 0 AS tamper
  FROM documents),
f AS (
  SELECT doc_id, lang, tamper,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM b),
h AS (
  SELECT doc_id, lang,
    sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') || tail) AS leaf,
    CASE WHEN tamper AND n_chars IS NOT NULL
      THEN sha256(head || strlen(CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR)) || ':' || CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR) || tail) END AS tampered
  FROM f),
d AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM h),
inside(lang, level, pos, hash, n) AS (
  SELECT lang, 0, pos, leaf, n FROM d
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2 FROM inside WHERE n > 1 GROUP BY lang, level, pos // 2, n),
subs AS (
  SELECT lang, hash AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM inside WHERE n = 1),
outside(level, pos, hash, n) AS (
  SELECT 0, pos, subroot, n FROM subs
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2 FROM outside WHERE n > 1 GROUP BY level, pos // 2, n),
top AS (SELECT hash AS root, level AS height FROM outside WHERE n = 1),
inner_steps AS (
  SELECT x.id, x.k, x.side, s.hash
  FROM (SELECT d.id, d.lang, unnest(range(subs.height)) AS k, (d.pos >> k) & 1 AS side, xor(d.pos >> k, 1) AS other
        FROM d JOIN subs ON subs.lang IS NOT DISTINCT FROM d.lang) x
  LEFT JOIN inside s ON s.lang IS NOT DISTINCT FROM x.lang AND s.level = x.k AND s.pos = x.other),
outer_steps AS (
  SELECT x.id, x.below + x.k AS k, x.side, s.hash
  FROM (SELECT d.id, subs.height AS below, unnest(range(top.height)) AS k, (subs.pos >> k) & 1 AS side, xor(subs.pos >> k, 1) AS other
        FROM d JOIN subs ON subs.lang IS NOT DISTINCT FROM d.lang, top) x
  LEFT JOIN outside s ON s.level = x.k AND s.pos = x.other),
steps AS (SELECT * FROM inner_steps UNION ALL SELECT * FROM outer_steps),
proofs AS (SELECT id, string_agg(coalesce(hash, ''), '' ORDER BY k) AS proof FROM steps GROUP BY id),
climb(id, k, now) AS (
  SELECT id, 0, coalesce(tampered, leaf) FROM d
  UNION ALL
  SELECT c.id, c.k + 1, sha256(CASE WHEN s.hash IS NULL THEN c.now WHEN s.side = 1 THEN s.hash || c.now ELSE c.now || s.hash END)
  FROM climb c JOIN steps s ON s.id = c.id AND s.k = c.k),
ends AS (SELECT id, arg_max(now, k) AS folded_root FROM climb GROUP BY id)
SELECT d.doc_id, d.leaf, subs.subroot, top.root, sha256(coalesce(p.proof, '')) AS proof_sha256, e.folded_root, e.folded_root = top.root AS verified
FROM d JOIN subs ON subs.lang IS NOT DISTINCT FROM d.lang JOIN ends e ON e.id = d.id LEFT JOIN proofs p ON p.id = d.id, top
"""
