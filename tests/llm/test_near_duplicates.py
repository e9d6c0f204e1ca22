import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

import corpus_pipeline
from leafmill.llm import components, embedding_dedup, shingle_dedup, simhash, topk
from tests.llm.common import awkward, docs, prose


def union(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(80)] + [(5, 5)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union({n for e in edges for n in e}, edges)
    assert all(got.get(n, n) == w for n, w in want.items())
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = [w for w in text.translate({c: c + 32 for c in range(65, 91)}).encode().replace(b"\x0b", b" ").split() if w]
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies():
    rows = [(100 + i, prose(50, 400) + f" tail{i % 9}") for i in range(40)]
    rows += [(200 + i, prose(60 + i, 120)) for i in range(30)] + [(300 + i, prose(60, 120)) for i in range(10)]
    return rows


def test_simhash(spark):
    rows = awkward() + near_copies()
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(docs(spark, rows)).collect()}
    prints = [(d, plain_fingerprint(t or "")) for d, t, *_ in rows]
    values = sorted({p for _, p in prints})
    root = union(values, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3])
    least = {}
    for d, p in prints:
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    assert got == {(d, f"{p:016x}"): least.get(root[p]) for d, p in prints}
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_keep_one(spark):
    rows = awkward() + near_copies()
    frame = docs(spark, rows)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    groups = {r.component_id for r in simhash.near_duplicates(frame).collect()}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(g for g in groups if g is not None)
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["no id at all"]


@pytest.mark.parametrize("operator,words,near", [(simhash, 3, lambda a, b: (plain_fingerprint(a) ^ plain_fingerprint(b)).bit_count() <= 3), (shingle_dedup, 5, lambda a, b: len(plain_shingles(a) & plain_shingles(b)) >= 0.8 * len(plain_shingles(a) | plain_shingles(b)))])
def test_keep_one_of_nameless_copies(spark, operator, words, near):
    """Rows without a doc_id that copy documents with one, copy one another, stand alone, or have no text."""
    base = [prose(700 + k, 150) for k in range(6)]
    rows = [(1, base[0]), (None, base[0]), (None, base[0] + " more"), (None, base[1]), (None, base[1] + " x"), (None, base[1]), (None, base[2])]
    rows += [(7, base[3] + " y"), (8, base[3]), (8, base[3]), (None, base[3]), (None, None), (None, ""), (None, base[4]), (None, "of few words"), (None, "of few words")]
    root = union(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if near(rows[i][1] or "", rows[j][1] or "")])
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(root[i], []).append(row)
    frame = docs(spark, rows)
    kept = operator.keep_one(frame)
    assert kept.columns == frame.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(groups)
    for own in groups.values():
        named = [d for d, _ in own if d is not None]
        mine = [g for g in got if g in own]
        assert len(mine) == 1 and mine[0][0] == (min(named) if named else None)


def edited(seed, words, every):
    """Prose of which every so many-th word is exchanged."""
    return " ".join(f"new{k}" if k % every == every - 1 else w for k, w in enumerate(prose(seed, words).split()))


def plain_shingles(text):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_pipeline_keeps_one_of_near_copies(spark):
    rows = awkward() + near_copies()
    for k, every in enumerate((30, 50, 70, 100, 200)):
        rows += [(400 + 10 * k, prose(90 + k, 600)), (401 + 10 * k, edited(90 + k, 600, every))]
    own = [(d, plain_shingles(t or "")) for d, t, *_ in rows]
    alike = [(i, j) for i in range(len(own)) for j in range(i) if len(own[i][1] & own[j][1]) >= 0.8 * len(own[i][1] | own[j][1])]
    root = union(range(len(own)), alike)
    least = {}
    for i, (d, _) in enumerate(own):
        if d is not None:
            least[root[i]] = min(d, least.get(root[i], d))
    frame = docs(spark, rows)
    got = sorted(map(tuple, shingle_dedup.near_duplicates(frame).collect()), key=str)
    assert got == sorted(((d, least.get(root[i])) for i, (d, _) in enumerate(own)), key=str)
    kept = corpus_pipeline.near_duplicate_stage(spark, frame, "")
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(least.values()))
    assert {440, 430, 420} <= set(least.values()) and not {441, 431, 421} & set(least.values())
    assert shingle_dedup.keep_one(docs(spark, [])).count() == 0


@pytest.mark.parametrize("leaf,shard", [(8, 60), (48, 400)])
def test_vantage_trees_lose_no_link(spark, leaf, shard):
    rng = np.random.default_rng(leaf)
    base = rng.integers(0, 2**63, 1500, dtype=np.int64).view(np.uint64)
    near, hot = base[:500].copy(), np.full(300, base[9])
    for _ in range(3):
        near ^= np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)
        hot ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    values = np.unique(np.concatenate([base, near, hot]))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    config = simhash.SimHashConfig(leaf=leaf, shard=shard)
    links = [(r.a, r.b) for r in simhash.fingerprint_links(frame, config).collect()]
    signed = values.view(np.int64).tolist()
    pairs = np.argwhere(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3, 1))
    assert union(signed, links) == union(signed, [(signed[i], signed[j]) for i, j in pairs])


VECTORS = "vec_id long, embedding array<float>, label int, v string, unit string, score long"


def vectors():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(260):
        x = rng.standard_normal(16)
        rows.append((i, (x / np.linalg.norm(x)).astype(np.float32).tolist(), i % 3))
    for i in range(160):  # a crowd around one vector, and close pairs around the threshold
        x = np.array(rows[4][1] if i < 90 else rows[i][1]) + rng.standard_normal(16) * (0.03 if i < 90 else 0.05)
        rows.append((1000 + i, x.astype(np.float32).tolist(), rows[4][2] if i < 90 else rows[i][2]))
    rows += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, [None] * 16, 0), (2004, rows[4][1], None), (None, rows[4][1], 1), (4, rows[4][1], rows[4][2])]
    return rows


def usable(e):
    return e is not None and all(x is not None and np.isfinite(x) for x in e)


def test_embedding_dedup_against_brute_force(spark):
    rows = vectors()
    frame = spark.createDataFrame([(*r, "a", "b", 3) for r in rows], VECTORS)
    config = embedding_dedup.CollisionConfig(block=64)
    got = {r.vec_id: tuple(r)[1:] for r in embedding_dedup.near_duplicates(frame, config).collect()}
    nodes = {i: (np.array(e, float) / np.linalg.norm(np.array(e, float)), c) for i, e, c in rows if i is not None and c is not None and usable(e) and any(e)}
    edges = {(a, b) for a in nodes for b in nodes if a < b and nodes[a][1] == nodes[b][1] and nodes[a][0] @ nodes[b][0] >= 0.98}
    root = union({i for i, _, _ in rows if i is not None}, edges)
    found = sum(got[i][0] for i in root) / 2
    assert 0.98 * len(edges) <= found <= len(edges)
    same = sum(got[i][1] == root[i] for i in root)
    assert same >= 0.98 * len(root) and all(got[i][2] == (got[i][1] == i) for i in root)
    assert got[None] == (0, None, False)
    assert frame.count() == embedding_dedup.near_duplicates(frame, config).count()
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_count_is_calibrated():
    config = embedding_dedup.CollisionConfig()
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.9801 * x + np.sqrt(1 - 0.9801**2) * side
    axes = embedding_dedup.directions(64, config)[2:].T
    counts = (np.abs((x - y) @ axes) <= config.window * config.deviation).sum(1)
    assert (counts >= config.least_count).mean() > 0.98


@pytest.mark.parametrize("block", [16, 4096])
def test_top_k_against_brute_force(spark, block):
    rows = vectors()
    frame = spark.createDataFrame([(*r, "a", "b", 3) for r in rows], VECTORS)
    usable_rows = topk.quantized(frame).distinct()
    got = topk.top_k(usable_rows.where("vec_id % 20 = 0"), usable_rows, 20, query_block=block, candidate_block=4 * block)
    got = sorted(map(tuple, got.collect()))
    own = {i: np.floor(64 * np.array(e, float)).astype(int) for i, e, _ in rows if i is not None and usable(e)}
    want = []
    for q in sorted(own):
        if q % 20 == 0:
            best = sorted(((-int(own[q] @ v), i) for i, v in own.items() if i != q))[:20]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == want
    assert topk.top_k_of_table(frame.limit(0)).count() == 0
    assert topk.top_k_of_table(frame.where("vec_id in (20, 21, 22)")).count() == 2


def test_threshold_algorithm_stops_early():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-3, 4, (20_000, 3))
    lists = topk.SortedLists(np.arange(20_000), vectors, 90)
    rows, scores = lists.search(-1, np.array([90, 1, 0]), 5)
    want = np.lexsort((np.arange(20_000), -(vectors @ [90, 1, 0])))[:5]
    assert rows.tolist() == want.tolist() and lists.reads < 2 * 20_000


def test_queries_search_together(monkeypatch):
    """Hundreds of queries share the rows they meet and their products; ties, own ids and floors as for each alone."""
    rng, asked = np.random.default_rng(6), []
    vectors = np.repeat(rng.integers(-9, 10, (700, 16)), 3, axis=0)
    ids, queries = np.arange(2100) // 2, np.concatenate([rng.integers(-9, 10, (300, 16)), np.zeros((1, 16), np.int64), vectors[:4]])
    query_ids = np.append(np.arange(301) * 5, [0, 0, 1, 1])
    floors = np.where(np.arange(305) % 3, topk.LEAST, 500)
    lists, products = topk.SortedLists(ids, vectors, 9), topk.SortedLists._products
    monkeypatch.setattr(topk.SortedLists, "_products", lambda self, q, rows: asked.append(len(q)) or products(self, q, rows))
    of, rows, scores = lists.search_all(query_ids, queries, 7, floors)
    for i, (own, query) in enumerate(zip(query_ids, queries)):
        found = sorted((-int(s), r) for r, s in enumerate(vectors @ query) if ids[r] != own and s >= floors[i])[:7]
        assert [(-s, r) for r, s in zip(rows[of == i].tolist(), scores[of == i].tolist())] == found
    assert max(asked) > 250 and len(asked) < 20


def test_embedding_dedup_of_lengths_copies_and_extremes(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((30, 8)).astype(np.float32)
    rows = [(i, base[i].tolist(), 1) for i in range(30)] + [(100 + i, base[3].tolist(), 1) for i in range(50)] + [(200 + i, (base[3] * np.float32(4)).tolist(), 1) for i in range(5)]
    rows += [(300, [1.0, 2.0], 1), (301, [1.0, 2.0], 1), (302, [2.0, 4.0], 2), (303, [1e30, 1e30], 3), (304, [1e-30, 1e-30], 3), (305, [1e38, 1e38], 3), (306, [-0.0, 1.0], 4), (307, [0.0, 1.0], 4)]
    frame = spark.createDataFrame([(*r, "a", "b", 3) for r in rows], VECTORS)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame).collect()}
    assert all(got[i] == (55, 3, i == 3) for i in (3, *range(100, 150), *range(200, 205)))
    assert got[300] == (1, 300, True) and got[301] == (1, 300, False) and got[302] == (0, 302, True)
    assert [got[i] for i in (303, 304, 305)] == [(2, 303, True), (2, 303, False), (2, 303, False)]
    assert got[306] == (1, 306, True) and got[307] == (1, 306, False)


def test_embedding_cells_count_each_pair_once(spark):
    """Many small cells in many tables against one block: the same links, but for the stated loss."""
    rng = np.random.default_rng(4)
    base = rng.standard_normal((400, 32))
    base = np.repeat(base, 4, axis=0) + 0.02 * rng.standard_normal((1600, 32))
    frame = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(base.astype(np.float32))], "vec_id long, embedding array<float>, label int")
    want = {tuple(r) for r in embedding_dedup.near_duplicates(frame, embedding_dedup.CollisionConfig(block=4096)).collect()}
    got = {tuple(r) for r in embedding_dedup.near_duplicates(frame, embedding_dedup.CollisionConfig(block=50)).collect()}
    assert embedding_dedup.CollisionConfig().tables(5) > 5 and len(want & got) >= 0.995 * len(want)
    assert sum(r[1] for r in got) <= sum(r[1] for r in want)


def test_crowded_buckets_are_settled_in_blocks(spark):
    """Families of which no member is like all others, cut into blocks far smaller than a bucket."""
    rng = random.Random(9)
    rows = []
    for family in range(3):
        words = prose(700 + family, 300).split()
        for k in range(40):
            own = [f"x{rng.random()}" if rng.random() < 0.004 * (k % 7) else w for w in words]
            rows.append((1000 * family + k, " ".join(own)))
    own = {d: plain_shingles(t) for d, t in rows}
    root = union(own, [(a, b) for a in own for b in own if a < b and len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b])])
    for family, block in ((256, 384), (10, 384), (10, 3)):
        got = shingle_dedup.near_duplicates(docs(spark, rows), shingle_dedup.ShingleConfig(family=family, block=block)).collect()
        assert {r.doc_id: r.component_id for r in got} == root


def test_top_k_of_extremes_and_lengths(spark):
    rows = [(20, [1e9, 1.0]), (21, [1e9, -1e9]), (22, [3e38, 3e38]), (23, [-3e38, 1.0]), (24, [1e9, 5.0]), (40, [1.0, 2.0, 3.0]), (41, [1.0, 0.0, 0.0]), (60, [0.0, 0.0]), (61, [2.0, 2.0]), (80, [2e8, 2e8])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k_of_table(frame).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    clamp = lambda x: max(-(2**63), min(2**63 - 1, x))
    own = {i: [clamp(int(np.floor(64 * x))) for x in e] for i, e in rows}
    for q in (20, 40, 60, 80):
        best = sorted((-clamp(sum(a * b for a, b in zip(own[q], v))), i) for i, v in own.items() if i != q and len(v) == len(own[q]))
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
