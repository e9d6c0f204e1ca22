"""Ruled grids against a search over all crossings, and what becomes of stamps and odd drawings."""

import random

from leafmill.operators import grids

DRAWN = "doc_id string, page int, item string, x0 double, y0 double, x1 double, y1 double"
WORDS = "doc_id string, page int, block_no int, line_no int, word_no int, text string, x0 double, y0 double, x1 double, y1 double, a double, b double"
SNAP = grids.SNAP


def word(text, x, y, k=0, a=1.0, b=0.0, page=1):
    return ("d", page, 0, k, 0, text, x - 2.0, y - 2.0, x + 2.0, y + 2.0, a, b)


def found(spark, drawings, words=()):
    rows = grids.ruled_tables(spark.createDataFrame(drawings, DRAWN), spark.createDataFrame(list(words), WORDS)).collect()
    return {(r.doc_id, r.page, r.table_no): (r.rows, (r.x0, r.y0, r.x1, r.y1)) for r in rows}


def plain_cells(drawings):
    """All crossings with all crossings, for drawings that need no snapping."""
    flat = sorted({(d[4], d[3], d[5]) for d in drawings if d[4] == d[6]})
    tall = sorted({(d[3], d[4], d[6]) for d in drawings if d[3] == d[5]})
    on = lambda at, a, b: a - SNAP <= at <= b + SNAP
    cross = {(x, y) for y, a, b in flat for x, c, d in tall if on(x, a, b) and on(y, c, d)}
    over = lambda y, x0, x1: any(at == y and on(x0, a, b) and on(x1, a, b) for at, a, b in flat)
    down = lambda x, y0, y1: any(at == x and on(y0, a, b) and on(y1, a, b) for at, a, b in tall)
    out = set()
    for x, y in cross:
        spans = [(d, c) for c, d in cross if c > x and d > y and (c, y) in cross and (x, d) in cross and over(y, x, c) and over(d, x, c) and down(x, y, d) and down(c, y, d)]
        if spans:
            d, c = min(spans)
            out.add((x, y, c, d))
    return out


def test_cells_of_random_rules_equal_those_of_a_plain_search(spark):
    rng = random.Random(4)
    drawings = []
    for page in range(1, 25):
        for k in rng.sample(range(12), 8):
            a, b = sorted(rng.sample(range(0, 240, 20), 2))
            drawings += [("d", page, "l", float(a), 20.0 * k, float(b), 20.0 * k)]
        for k in rng.sample(range(12), 8):
            a, b = sorted(rng.sample(range(0, 240, 20), 2))
            drawings += [("d", page, "l", 20.0 * k, float(a), 20.0 * k, float(b))]
    frame = spark.createDataFrame(drawings, DRAWN)
    got = {}
    for r in grids.cells(grids.crossings(grids.ruled_lines(frame))).collect():
        got.setdefault(r.page, set()).add((r.x0, r.y0, r.x1, r.y1))
    want = {page: plain_cells([d for d in drawings if d[1] == page]) for page in range(1, 25)}
    assert got == {page: cells for page, cells in want.items() if cells} and sum(map(len, got.values())) > 40


def test_rows_merged_cells_stamps_and_sideways_text(spark):
    boxes = [("d", 1, "re", 100.0, 100.0 + 30 * k, 300.0, 130.4 + 30 * k) for k in range(3)]
    rules = [("d", 1, "l", 200.0, 100.0, 200.5, 160.0), ("d", 1, "re", 99.0, 129.0, 301.0, 130.0), ("d", 1, "l", 0.0, 0.0, 90.0, 80.0), ("d", 1, "c", 0.0, 0.0, 300.0, 1.0), ("d", 1, "l", None, 1.0, 1.0, 1.0), ("d", 2, "re", 0.0, 0.0, 9.0, 9.0)]
    words = [word("a", 150, 115), word("b", 250, 115, 1), word("c", 150, 145, 2), word("two", 120, 175, 4), word("one", 120, 165, 3), word("wide", 280, 165, 3), word("far", 400, 115)]
    sideways = [("d", 1, 0, 9, k, t, 248.0, 150.0 - 5 * k, 252.0, 152.0 - 5 * k, 0.0, 1.0) for k, t in enumerate("xyz")]
    got = found(spark, boxes + rules + boxes, words + sideways)
    assert [v[0] for v in got.values()] == [[["a", "b"], ["c", "x y z"], ["one wide\ntwo", ""]]]
    assert set(got) == {("d", 1, 0)}
    x0, y0, x1, y1 = got["d", 1, 0][1]
    assert abs(x0 - 100) < 1.1 and abs(y0 - 100) < 1.1 and abs(x1 - 300) < 1.1 and abs(y1 - 190) < 1.1


def test_tables_apart_and_nothing_drawn(spark):
    two = [("d", 1, "re", x + 10.0 * i, 50.0, x + 10.0 * i + 10, 60.0) for x in (0, 100) for i in range(2)]
    got = found(spark, two, [word("l", 5, 55), word("r", 115, 55)])
    assert {k: v[0] for k, v in got.items()} == {("d", 1, 0): [["l", ""]], ("d", 1, 1): [["", "r"]]}
    assert found(spark, []) == {} and found(spark, two[:1]) == {}


def test_a_large_grid(spark):
    """100 x 100 cells; all crossings with all crossings would be a hundred million."""
    rules = [("d", 1, "l", 0.0, 10.0 * k, 1000.0, 10.0 * k) for k in range(101)] + [("d", 1, "l", 10.0 * k, 0.0, 10.0 * k, 1000.0) for k in range(101)]
    words = [("d", 1, 0, i, j, f"{i}-{j}", 10.0 * j + 4, 10.0 * i + 4, 10.0 * j + 6, 10.0 * i + 6, 1.0, 0.0) for i in range(100) for j in range(100)]
    ((rows, _),) = found(spark, rules, words).values()
    assert rows == [[f"{i}-{j}" for j in range(100)] for i in range(100)]


def test_a_page_walked_once_equals_windows_and_joins(spark):
    """Random rules, with pieces, near misses and sideways words, by both ways; few drawings take few shuffles."""
    rng = random.Random(9)
    drawings, words = [], []
    for page in range(1, 31):
        for _ in range(14):
            a, b = sorted(rng.sample(range(0, 200, 20), 2))
            at = 20.0 * rng.randrange(10) + rng.choice((0.0, 0.0, 1.5))
            drawings.append(("d", page, "l", float(a), at, float(b), at) if rng.random() < 0.5 else ("d", page, "l", at, float(b), at, float(a)))
        drawings += [("d", page, rng.choice(("re", "c")), 20.0, 40.0, 140.0 + k, 120.0) for k in range(2)]
        for k in range(40):
            x, y, turned = 5.0 * rng.randrange(40), 5.0 * rng.randrange(40), rng.random() < page % 3 / 2
            words.append(("d", page, k % 3, k % 7, k, rng.choice(("a", " b ", None)), x, y, x + 4, y + 6, 0.0 if turned else 1.0, rng.choice((-1.0, 1.0)) if turned else 0.0))
    drawn, said = spark.createDataFrame(drawings, DRAWN), spark.createDataFrame(words, WORDS)
    walked = grids.ruled_tables(drawn, said)
    assert walked._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2
    rows = lambda frame: sorted(frame.collect())
    assert rows(walked) and rows(walked) == rows(grids._crowded_tables(drawn, said).select(*walked.columns))


def _random_page(rng):
    """Pieces, near misses, boxes and words; now and then a sideways word, a repeated number, or something missing."""
    drawn, said = [], []
    for _ in range(rng.randrange(24)):
        a, b = sorted(rng.sample(range(0, 200, 20), 2))
        at, a = 20.0 * rng.randrange(10) + rng.choice((0.0, 0.0, 1.5, 0.7, 0.1, 2.9)), a + rng.choice((0.0, 0.0, 2.0, 4.0))
        drawn.append(("l", a, at, float(b), at) if rng.random() < 0.5 else ("l", at, float(b), at, a))
    for _ in range(rng.randrange(6)):
        x, y = 20.0 * rng.randrange(6), 20.0 * rng.randrange(6)
        drawn.append((rng.choice(("re", "re", "c", None)), x, y + rng.choice((0.0, 0.3)), x + 20 * rng.randrange(3), rng.choice((y + 20 * rng.randrange(4), None, float("nan")))))
    for k in range(rng.randrange(40)):
        x, y, turned = 5.0 * rng.randrange(40), 5.0 * rng.randrange(40), rng.random() < 0.02
        said.append((k % 3, k % 7, rng.choice((k, k, k, k, None if rng.random() < 0.1 else 3)), rng.choice(("a", " b ", "é", None if rng.random() < 0.1 else "z")), x, y, x + 4, rng.choice((y + 6, y + 6, None)), 0.0 if turned else 1.0, float(turned)))
    return drawn, said


def test_pages_worked_on_together_equal_those_walked(monkeypatch):
    import pyarrow as pa

    from leafmill.operators import grid_batches

    rng, corners = random.Random(5), [(c, pa.float64()) for c in ("x0", "y0", "x1", "y1")]
    shape = pa.struct([("item", pa.string()), *corners])
    word_ = pa.struct([*[(c, pa.int64()) for c in ("block_no", "line_no", "word_no")], ("text", pa.string()), *corners, ("a", pa.float64()), ("b", pa.float64())])
    pages = [_random_page(rng) for _ in range(400)] + [([], []), (None, None)]
    of = lambda rows, kind: pa.array([None if own is None else [dict(zip((f.name for f in kind), row)) for row in own] for own in rows], pa.list_(kind))
    shapes, words = of([d for d, _ in pages], shape), of([w for _, w in pages], word_)
    whole = lambda box: all(v is not None and v == v for v in box)
    want = []
    for drawn, said in pages:
        tables = grids._tables_of([d for d in drawn or () if whole(d[1:])], [(w[3], *w[4:8], *w[:3], *w[8:]) for w in said or () if whole(w[4:8])])
        want.append([dict(zip(("table_no", "rows", "x0", "y0", "x1", "y1"), t)) for t in tables])
    assert grids._tables_at_once(shapes, words).to_pylist() == want
    assert grids._tables_at_once(shapes.slice(9, 80), words.slice(9, 80)).to_pylist() == want[9:89]
    together, left = grid_batches.tables_of(shapes, words, SNAP)
    assert sum(map(len, together.to_pylist())) > 50 and 0 < left.sum() < 100
    monkeypatch.setattr(grid_batches, "PAIRS", 20)
    assert grids._tables_at_once(shapes, words).to_pylist() == want


def test_tables_of_page_rows_crowded_ones_too(spark):
    boxes = [("re", 10.0 * i, 10.0 * j, 10.0 * i + 10, 10.0 * j + 10) for i in range(17) for j in range(16)]
    said = [(0, 0, 0, "in", 11.0, 11.0, 14.0, 14.0, 1.0, 0.0)]
    box = "x0: double, y0: double, x1: double, y1: double"
    schema = f"doc_id string, page int, drawings array<struct<item: string, {box}>>, words array<struct<block_no: int, line_no: int, word_no: int, text: string, {box}, a: double, b: double>>"
    frame = spark.createDataFrame([("d", 1, boxes[:18], said), ("d", 2, boxes, said), ("d", 3, [], said), ("d", 4, None, None)], schema)
    got = {r.page: [(t.table_no, t.rows, (t.x0, t.y0, t.x1, t.y1)) for t in r.native or ()] for r in grids.found_in(frame, "words").collect()}
    table = lambda rows, columns: [["in" if (i, j) == (1, 1) else "" for j in range(columns)] for i in range(rows)]
    assert got[2] == [(0, table(16, 17), (0.0, 0.0, 170.0, 160.0))] and got[3] == got[4] == []
    assert got[1] == [(0, table(16, 2), (0.0, 0.0, 20.0, 160.0))]
