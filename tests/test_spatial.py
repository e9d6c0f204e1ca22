"""The spatial join against all pairs, and on one page of very many boxes."""

import random
import time

import pytest

from leafmill.operators import geometry, spatial

SCHEMA = "doc_id string, page int, x0 double, y0 double, x1 double, y1 double, n int"
INF, NAN = float("inf"), float("nan")


def box(rng, kind):
    x, y = (rng.gauss(300, 5), rng.gauss(10, 3)) if kind == "cluster" else (rng.uniform(0, 600), rng.uniform(0, 800))
    w, h = {"word": (rng.uniform(2, 60), 8), "rule": (600, 0.5), "post": (0.0, 800), "dot": (0.0, 0.0), "frame": (500, 700), "cluster": (rng.uniform(0, 0.2), 0.1)}[kind]
    return (x, y, x + w, y + h)


def made(seed, n, kinds, doc="d"):
    rng = random.Random(seed)
    return [(doc, 1, *box(rng, rng.choice(kinds)), k) for k in range(n)]


ODD = [("d", 1, None, 0.0, 1.0, 1.0, -1), ("d", 1, NAN, 0.0, 1.0, 1.0, -2), (None, 1, 0.0, 0.0, 9.0, 9.0, -3), ("d", None, 0.0, 0.0, 9.0, 9.0, -4), ("d", 1, 500.0, 600.0, 100.0, 20.0, -5), ("d", 1, -INF, 5.0, INF, 6.0, -6), ("e", 1, 0.0, 0.0, 9.0, 9.0, -7), ("d", 1, 8.0, 8.0, 8.0, 8.0, -8), ("d", 1, 8.0, 8.0, 8.0, 8.0, -8)]


def plain(left, right):
    good = lambda r: r[0] is not None and r[1] is not None and all(c is not None and c == c for c in r[2:6])
    out = []
    for a in filter(good, left):
        for b in filter(good, right):
            meets = lambda i: min(a[i], a[i + 2]) <= max(b[i], b[i + 2]) and min(b[i], b[i + 2]) <= max(a[i], a[i + 2])
            if a[:2] == b[:2] and meets(2) and meets(3):
                out.append((a[6], b[6]))
    return sorted(out)


@pytest.mark.parametrize("least", [256, 8])
@pytest.mark.parametrize("n,left,right", [(20, ["word"], ["frame"]), (700, ["word"], ["word", "rule"]), (600, ["word", "rule", "dot", "post"], ["frame", "word", "dot"]), (700, ["cluster", "frame"], ["cluster", "rule", "post"]), (300, ["dot"], ["dot"])])
def test_every_pair_once(spark, monkeypatch, n, left, right, least):
    monkeypatch.setattr(spatial, "CROWDED", least)
    a, b = made(1, n, left) + ODD + made(3, 5, left, "e"), made(2, n // 2, right) + ODD + [("d", 1, 0.0, 0.0, 600.0, 800.0, 9999)]
    pairs = spatial.touching(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA))
    assert sorted((r.n, r.r_n) for r in pairs.collect()) == plain(a, b)
    assert pairs.columns == ["doc_id", "page", "x0", "y0", "x1", "y1", "n", "r_x0", "r_y0", "r_x1", "r_y1", "r_n"]


def test_without_boxes_and_without_crowds(spark):
    some, none = spark.createDataFrame(made(1, 400, ["word"]), SCHEMA), spark.createDataFrame([], SCHEMA)
    assert spatial.touching(some, none).count() == 0 == spatial.touching(none, some).count()
    assert geometry.exclude_regions(some, none).count() == 400 and geometry.exclude_regions(none, some).count() == 0


@pytest.mark.parametrize("least", [256, 8])
def test_exclusions_on_a_crowded_page_equal_those_of_all_pairs(spark, monkeypatch, least):
    monkeypatch.setattr(spatial, "CROWDED", least)
    words, regions = made(5, 900, ["word", "dot"]) + ODD, made(6, 30, ["word", "frame"]) + ODD[4:]
    regions = [r for r in regions if r[6] not in (3, 4)]
    left, right = spark.createDataFrame(words, SCHEMA), spark.createDataFrame(regions, SCHEMA)
    kept = sorted(r.n for r in geometry.exclude_regions(left, right).collect())
    over = lambda a, b: a[:2] == b[:2] and None not in a[:6] and a[2] < b[4] and b[2] < a[4] and a[3] < b[5] and b[3] < a[5]
    assert kept == sorted(w[6] for w in words if not any(over(w, r) for r in regions))
    inside = sorted(r.n for r in geometry.drop_inside(left, right).collect())
    centre = lambda a: ((a[2] + a[4]) / 2, (a[3] + a[5]) / 2)
    within = lambda a, b: a[:2] == b[:2] and None not in a[:6] and b[2] <= centre(a)[0] <= b[4] and b[3] <= centre(a)[1] <= b[5]
    assert inside == sorted(w[6] for w in words if not any(within(w, r) for r in regions))


def test_a_page_of_200000_boxes(spark):
    """Words side by side, each beside a stamp of its own, under some rules and in one frame: the pairs are a few per box."""
    words = spark.range(200_000).selectExpr("'d' doc_id", "1 page", "cast(id % 500 as double) * 20 x0", "cast(id div 500 as double) * 20 y0", "cast(id % 500 as double) * 20 + 12 x1", "cast(id div 500 as double) * 20 + 8 y1")
    stamps = spark.range(100_000).selectExpr("'d' doc_id", "1 page", "cast(id % 500 as double) * 20 + 6 x0", "cast(id div 500 as double) * 20 + 4 y0", "cast(id % 500 as double) * 20 + 14 x1", "cast(id div 500 as double) * 20 + 9 y1")
    rules = spark.range(20).selectExpr("'d' doc_id", "1 page", "0.0D x0", "cast(id as double) * 400 + 1 y0", "9999.0D x1", "cast(id as double) * 400 + 2 y1")
    began = time.time()
    assert spatial.touching(words, stamps.unionAll(rules)).count() == 100_000 + 20 * 500
    assert geometry.exclude_regions(words, stamps).count() == 100_000
    assert time.time() - began < 120
