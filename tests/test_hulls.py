"""Hulls of parts that belong together against restarting after every merge, and very many parts."""

import random
import time

import pytest

from leafmill.operators import hulls, reading_order

TOGETHER = hulls.pieces_of_one(6.0, 0.8)


def plain(boxes, together):
    out = []
    for b in sorted(boxes, key=lambda b: (b[1], b[0])):
        out.append(tuple(b))
        while pair := next(((i, j) for i in range(len(out)) for j in range(i + 1, len(out)) if together(out[i], out[j])), None):
            a, c = out[pair[0]], out.pop(pair[1])
            out[pair[0]] = (min(a[0], c[0]), min(a[1], c[1]), max(a[2], c[2]), max(a[3], c[3]))
    return sorted(out, key=lambda h: (h[1], h[0]))


@pytest.mark.parametrize("together", [TOGETHER, lambda a, b: hulls.near(a, b, 6.0)])
def test_hulls_of_random_pages(together):
    rng = random.Random(1)
    for k in range(250):
        side, boxes = rng.choice([5, 20, 60, 150]), []
        for _ in range(rng.randrange(35)):
            x, y, w, h = (rng.uniform(0, 300), rng.uniform(0, 300), rng.uniform(0, side), rng.uniform(0, side)) if k % 2 else (rng.randrange(300), rng.randrange(300), rng.randrange(side), rng.randrange(side))
            boxes.append((x, y, x + w, y + h))
        found = hulls.grown(boxes, together, 6.0)
        assert [h for h, _ in found] == plain(boxes, together)
        assert sorted(i for _, parts in found for i in parts) == list(range(len(boxes)))
        assert all(h == tuple(f(boxes[i][c] for i in parts) for c, f in enumerate((min, min, max, max))) for h, parts in found)


def test_twenty_thousand_parts():
    rng = random.Random(2)
    scattered = [(x, y, x + 20, y + 8) for x, y in ((rng.uniform(0, 6000), rng.uniform(0, 8000)) for _ in range(20_000))]
    tiled = [(10.0 * (k % 141), 10.0 * (k // 141), 10.0 * (k % 141) + 9, 10.0 * (k // 141) + 9) for k in range(20_000)]
    heaped = [(x, y, x + rng.uniform(1, 60), y + rng.uniform(1, 60)) for x, y in ((rng.uniform(0, 300), rng.uniform(0, 300)) for _ in range(20_000))]
    for boxes, least in ((scattered, 15_000), (tiled, 1), (heaped, 1)):
        began = time.process_time()
        assert len(hulls.grown(boxes, TOGETHER, 6.0)) >= least
        assert time.process_time() - began < 10


def test_figures_keep_out_icons_and_backgrounds(spark):
    images = [
        ("d", 1, 100.0, 100.0, 200.0, 200.0, 400, 400), ("d", 1, 203.0, 100.0, 300.0, 200.0, 970, 200), ("d", 1, 400.0, 100.0, 500.0, 200.0, 49, 400), ("d", 1, 400.0, 300.0, 420.0, 400.0, 400, 400),
        ("d", 1, 0.0, 400.0, 100.0, 500.0, None, None), ("d", 2, 0.0, 0.0, 600.0, 760.0, 5000, 99), ("d", 3, 0.0, 0.0, 600.0, 760.0, 60, 60), ("d", 4, None, 0.0, 600.0, 760.0, 60, 60),
    ]
    frame = spark.createDataFrame(images, "doc_id string, page int, x0 double, y0 double, x1 double, y1 double, pixels_x int, pixels_y int")
    sizes = spark.createDataFrame([("d", k, 600.0, 800.0) for k in range(1, 5)], "doc_id string, page int, width double, height double")
    texts = spark.createDataFrame([("d", 1, "x" * 500), ("d", 2, "x" * 200), ("d", 3, "x" * 199)], "doc_id string, page int, text string")
    got = sorted((r.page, r.x0, r.y0, r.x1, r.y1, r.dpi) for r in reading_order.figure_regions(frame, sizes, texts).collect())
    assert got == [(1, 0.0, 400.0, 100.0, 500.0, 72), (1, 100.0, 100.0, 300.0, 200.0, 300), (3, 0.0, 0.0, 600.0, 760.0, 72)]
