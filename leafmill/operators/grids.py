"""Tables that ruling lines draw, as windows and joins over the drawings and words of all pages.

Lines that lie within a tolerance are one line (a run of places without a larger gap),
and so are the pieces of a line that nearly meet. Where a horizontal and a vertical piece
cross is found by the spatial join. A cell is four crossings: its corner's nearest one to
the right that goes on downwards, the nearest one below that goes on to the right, and the
one that closes it. Cells that share a corner are one table. The words whose centre a cell
holds are its text; words that are stamps are kept out by not being given. Pages that come
as rows with arrays are worked on by hundreds (``grid_batches``).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.operators import grid_batches, spatial, tables
from leafmill.operators.geometry import SKEW
from leafmill.operators.reading_order import CHUNK, by_page
from leafmill.operators.spatial import CORNERS, KEY
from leafmill.runtime import cut, ship_package

#: Lines and ends of lines so near to one another, in points, are the same.
SNAP = 3.0
#: White space as ``functions.text.strip`` knows it.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def edges(drawings: DataFrame) -> DataFrame:
    """(doc_id, page, axis h|v, at, a, b): straight lines, thin shapes, and the four sides of rectangles."""
    x0, x1, y0, y1 = F.least("x0", "x1"), F.greatest("x0", "x1"), F.least("y0", "y1"), F.greatest("y0", "y1")
    side = lambda a, b, c, d: F.struct(a.alias("l"), b.alias("t"), c.alias("r"), d.alias("u"))
    own, sides = F.array(side(x0, y0, x1, y1)), F.array(side(x0, y0, x1, y0), side(x0, y1, x1, y1), side(x0, y0, x0, y1), side(x1, y0, x1, y1))
    thin = F.least(x1 - x0, y1 - y0) <= SNAP
    parts = F.when(F.col("item") == "c", None).when(thin, own).when(F.col("item") == "re", sides)
    each = drawings.select(*KEY, F.inline(parts))
    w, h = F.col("r") - F.col("l"), F.col("u") - F.col("t")
    axis = F.when((w > h) & (w >= SNAP), "h").when(h >= SNAP, "v")
    found = each.withColumn("axis", axis).where("axis is not null")
    flat = F.col("axis") == "h"
    return found.select(*KEY, "axis", F.when(flat, (F.col("t") + F.col("u")) / 2).otherwise((F.col("l") + F.col("r")) / 2).alias("at"), F.when(flat, F.col("l")).otherwise(F.col("t")).alias("a"), F.when(flat, F.col("r")).otherwise(F.col("u")).alias("b"))


def ruled_lines(drawings: DataFrame) -> DataFrame:
    """(doc_id, page, axis, line, piece, at, a, b): edges snapped to common lines, and joined along them.

    ``line`` numbers the lines of an axis by their place, ``at`` is the mean of the places
    that a line was snapped from.
    """
    axis = [*KEY, "axis"]
    by_place = Window.partitionBy(*axis).orderBy("at")
    before = F.col("at") - F.lag("at").over(by_place)
    runs = edges(drawings).withColumns({"apart": (before > SNAP).cast("int"), "fresh": F.coalesce(before > 0, F.lit(True))})
    runs = runs.withColumn("line", F.coalesce(F.sum("apart").over(by_place), F.lit(0)))
    line = Window.partitionBy(*axis, "line")
    along = line.orderBy("a", "b")
    reach = F.max("b").over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumns({"mean": F.sum(F.when(F.col("fresh"), F.col("at"))).over(line) / F.count_if("fresh").over(line), "gap": (F.col("a") > reach + SNAP).cast("int")})
    runs = runs.withColumn("piece", F.coalesce(F.sum("gap").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0)))
    return runs.groupBy(*axis, "line", "piece").agg(F.first("mean").alias("at"), F.min("a").alias("a"), F.max("b").alias("b"))


def crossings(lines: DataFrame) -> DataFrame:
    """(doc_id, page, h, v, top, left, y, x): where a horizontal piece h and a vertical piece v meet; top and left number their lines."""
    name = F.struct("line", "piece")
    flat = lines.where("axis = 'h'").select(*KEY, (F.col("a") - SNAP).alias("x0"), F.col("at").alias("y0"), (F.col("b") + SNAP).alias("x1"), F.col("at").alias("y1"), name.alias("h"))
    tall = lines.where("axis = 'v'").select(*KEY, F.col("at").alias("x0"), (F.col("a") - SNAP).alias("y0"), F.col("at").alias("x1"), (F.col("b") + SNAP).alias("y1"), name.alias("v"))
    return spatial.touching(flat, tall).select(*KEY, "h", F.col("r_v").alias("v"), F.col("h.line").alias("top"), F.col("r_v.line").alias("left"), F.col("y0").alias("y"), F.col("r_x0").alias("x"))


def _next(flag: str, name: str, along: str) -> Column:
    """The ``name`` of the nearest later crossing on the same piece ``along`` that has the flag."""
    later = Window.partitionBy(*KEY, along).orderBy(F.desc(name)).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(F.when(F.col(flag), F.col(name)), ignorenulls=True).over(later)


def cells(points: DataFrame) -> DataFrame:
    """(doc_id, page, left, top, right, bottom, x0, y0, x1, y1) of the smallest closed rectangle below and right of each crossing, by height and then width."""
    points = points.withColumns({
        "down": F.lead("top").over(Window.partitionBy(*KEY, "v").orderBy("h")).isNotNull(),
        "across": F.lead("left").over(Window.partitionBy(*KEY, "h").orderBy("v")).isNotNull(),
    })
    points = points.withColumns({"v2": _next("down", "v", "h"), "h2": _next("across", "h", "v")})
    starts = points.where("down and across and v2 is not null and h2 is not null").select(*KEY, "h", "v", "left", "top", "x", "y", "h2", "v2")
    corner = points.select(*KEY, F.col("h").alias("h2"), F.col("v").alias("v2"), F.col("left").alias("right"), F.col("top").alias("bottom"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    found = starts.join(corner, [*KEY, "h2", "v2"])
    # Where the nearest two do not close - a line ends on the way - all that follow on both pieces are tried.
    open_ = starts.join(corner.select(*KEY, "h2", "v2"), [*KEY, "h2", "v2"], "left_anti").drop("h2", "v2")
    rights = points.where("down").select(*KEY, "h", F.col("v").alias("v2"))
    downs = points.where("across").select(*KEY, "v", F.col("h").alias("h2"))
    tried = open_.join(rights, [*KEY, "h"]).where("v2 > v").join(downs, [*KEY, "v"]).where("h2 > h").join(corner, [*KEY, "h2", "v2"])
    same = [*KEY, "h", "v"]
    closed = tried.groupBy(*same).agg(F.min(F.struct("h2", "v2", "left", "top", "x", "y", "right", "bottom", "x1", "y1")).alias("c")).select(*KEY, "c.*")
    shown = [*KEY, "left", "top", "right", "bottom", F.col("x").alias("x0"), F.col("y").alias("y0"), "x1", "y1"]
    return found.select(*shown).unionByName(closed.select(*shown))


def _tables(rows: list[tuple]) -> list[tuple]:
    """(table_no, row, col, corners) of a page's cells (top, left, right, bottom, corners): tables are cells linked by corners, two at least."""
    root = list(range(len(rows)))

    def top_of(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    seen: dict[tuple[int, int], int] = {}
    for k, (top, left, right, bottom, *_) in enumerate(rows):
        for point in ((left, top), (right, top), (left, bottom), (right, bottom)):
            root[top_of(k)] = top_of(seen.setdefault(point, k))
    groups: dict[int, list[tuple]] = {}
    for k, row in enumerate(rows):
        groups.setdefault(top_of(k), []).append(row)
    out = []
    found = sorted((own for own in groups.values() if len(own) > 1), key=lambda own: (min(r[0] for r in own), min(r[1] for r in own)))
    for number, own in enumerate(found):
        tops, lefts = ({at: k for k, at in enumerate(sorted({r[i] for r in own}))} for i in (0, 1))
        placed = {(tops[r[0]], lefts[r[1]]): r[4:] for r in reversed(own)}
        out += [(number, *at, *box) for at, box in sorted(placed.items())]
    return out


def placed_cells(found: DataFrame) -> DataFrame:
    """(doc_id, page, table_no, row, col, corners) of the cells, tables numbered from the top."""
    numbers = ["top", "left", "right", "bottom"]
    rows = found.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("page").cast("int").alias("page"), *[F.col(c).cast("long").alias(c) for c in numbers], *CORNERS)
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * 4]
    schema = "doc_id string, page int, table_no int, row int, col int, x0 double, y0 double, x1 double, y1 double"
    return by_page(rows, _tables, [*KEY, "table_no", "row", "col", *CORNERS], kinds, schema)


def cell_texts(own: DataFrame, words: DataFrame) -> DataFrame:
    """The cells with ``text``: their words by line, sideways ones read in their own direction."""
    cell = [*KEY, "table_no", "row", "col"]
    number = (F.col("block_no").cast("long") * 100_000 + F.col("line_no")) * 100_000 + F.col("word_no")
    inside = tables.in_cells(own, words.withColumn("char_no", number))
    by_line = inside.groupBy(*cell, "block_no", "line_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_no", "text"))), lambda w: w["text"]), " ").alias("line"))
    read = by_line.groupBy(*cell).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "line_no", "line"))), lambda w: w["line"]), "\n").alias("text"))
    turned = tables.sideways(inside).withColumnRenamed("read", "turned")
    return own.join(read, cell, "left").join(turned, cell, "left").withColumn("text", F.coalesce("turned", "text", F.lit(""))).drop("turned")


def _pieces(sides: list[tuple[float, float, float]]) -> list[tuple[tuple[int, int], float, float, float]]:
    """((line, piece), at, a, b) of one axis of a page, from its edges (at, a, b), as ``ruled_lines`` has them."""
    lines: list[list[tuple]] = []
    for side in sorted(sides):
        if not lines or side[0] - lines[-1][-1][0] > SNAP:
            lines.append([])
        lines[-1].append(side)
    out = []
    for number, own in enumerate(lines):
        places = sorted({side[0] for side in own})
        mean, piece = sum(places) / len(places), []
        for _, a, b in sorted(own, key=lambda side: side[1:]):
            if not piece or a > piece[-1][1] + SNAP:
                piece.append([a, b])
            elif b > piece[-1][1]:
                piece[-1][1] = b
        out += [((number, k), mean, a, b) for k, (a, b) in enumerate(piece)]
    return out


def _sides(drawn: Iterable[tuple]) -> tuple[list[tuple], list[tuple]]:
    """The horizontal and the vertical edges (at, a, b) of a page's drawings (item, corners), as ``edges`` has them."""
    flat, tall = [], []
    for item, x0, y0, x1, y1 in drawn:
        if item == "c":
            continue
        l, r, t, u = min(x0, x1), max(x0, x1), min(y0, y1), max(y0, y1)
        thin = min(r - l, u - t) <= SNAP
        for l, t, r, u in ((l, t, r, u),) if thin else ((l, t, r, t), (l, u, r, u), (l, t, l, u), (r, t, r, u)) if item == "re" else ():  # noqa: E741
            if r - l > u - t and r - l >= SNAP:
                flat.append(((t + u) / 2, l, r))
            elif u - t >= SNAP:
                tall.append(((l + r) / 2, t, u))
    return flat, tall


def _cells(flat: list[tuple], tall: list[tuple]) -> list[tuple]:
    """(top, left, right, bottom, corners) of the cells of a page's pieces, as ``crossings`` and ``cells`` find them."""
    on_h = {h: [(v, x) for v, x, a, b in tall if a - SNAP <= y <= b + SNAP and c - SNAP <= x <= d + SNAP] for h, y, c, d in flat}
    on_v: dict[tuple, list[tuple]] = {}
    for h, y, _, _ in flat:
        for v, _ in on_h[h]:
            on_v.setdefault(v, []).append((h, y))
    met = {(h, v) for h, own in on_h.items() for v, _ in own}
    lowest, rightmost = {v: own[-1][0] for v, own in on_v.items()}, {h: own[-1][0] for h, own in on_h.items() if own}
    rights = {h: [(v, x) for v, x in own if h != lowest[v]] for h, own in on_h.items()}
    downs = {v: [(h, y) for h, y in own if v != rightmost[h]] for v, own in on_v.items()}
    out = []
    for h, y, _, _ in flat:
        for k, (v, x) in enumerate(rights[h]):
            if v == rightmost[h]:
                continue
            below = downs[v]
            after = bisect_right(below, h, key=itemgetter(0))
            closed = next(((low, right) for low in below[after:] for right in rights[h][k + 1 :] if (low[0], right[0]) in met), None)
            if closed:
                (h2, y2), (v2, x2) = closed
                out.append((h[0], v[0], v2[0], h2[0], x, y, x2, y2))
    return sorted(out)


def _said(words: list[tuple]) -> str:
    """The text of a cell's words (block_no, line_no, word_no, text, x0, y0, y1, a, b), as ``cell_texts`` and ``tables.sideways`` read it."""
    last = lambda value: (value is None, value)
    upright = sum(a is not None and b is not None and abs(a) < SKEW <= abs(b) for *_, a, b in words)
    if 2 * upright <= len(words):
        if len(words) == 1:
            return words[0][3] or ""
        lines: dict[tuple, list[tuple]] = {}
        for block, line, word, text, *_ in words:
            lines.setdefault((block, line), []).append((word, text))
        read = []
        for (block, line), own in lines.items():
            joined = " ".join(t for _, t in sorted(own, key=lambda w: (w[0] is not None, w[0] or 0, last(w[1]))) if t is not None)
            read.append(((block is not None, block or 0), (line is not None, line or 0), joined))
        return "\n".join(joined for *_, joined in sorted(read))
    up = 2 * sum(b is not None and b > 0 for *_, b in words) >= len(words)
    sign = -1 if up else 1
    turned: dict[float, list[tuple]] = {}
    for block, line, word, text, x0, y0, y1, _, _ in words:
        number = None if None in (block, line, word) else (block * 100_000 + line) * 100_000 + word
        turned.setdefault(round(x0) * -sign, []).append((y0 * sign, (number is not None, number or 0), last(text), text, y0, y1))
    out = []
    for at, own in turned.items():
        own.sort(key=itemgetter(0, 1, 2))
        gaps = [None, *((was[4] - now[5]) if up else (now[4] - was[5]) for was, now in zip(own, own[1:]))]
        spaced = (f" {row[3]}" if gap is not None and gap > tables.WORD_GAP else row[3] for gap, row in zip(gaps, own) if row[3] is not None)
        out.append((at, "".join(spaced).strip(WHITE)))
    return "\n".join(text for _, text in sorted(out))


def _page_tables(rows: Iterator[tuple]) -> list[tuple]:
    """(table_no, rows, corners) of one page: its drawings come first, then its words stream past."""
    rows = iter(rows)
    drawn: list[tuple] = []
    for row in rows:
        if row[0]:
            return _tables_of(drawn, (r[1:] for r in chain([row], rows)))
        drawn.append(row[1:6])
    return _tables_of(drawn, ())


def _tables_of(drawn: list[tuple], words: Iterable[tuple]) -> list[tuple]:
    """The same from drawings (item, corners) and words (text, corners, block_no, line_no, word_no, a, b), which stream past the cells; these keep what they hold."""
    flat, tall = (_pieces(sides) for sides in _sides(drawn))
    found: dict[int, dict[tuple[int, int], tuple]] = {}
    for number, row, col, *box in _tables(_cells(flat, tall)):
        found.setdefault(number, {})[row, col] = tuple(box)
    if not found:
        return []
    bands: dict[float, list[tuple]] = {}
    for number, own in found.items():
        for (row, col), (x0, y0, x1, y1) in own.items():
            bands.setdefault(y0, []).append((x0, x1, y1, (number, row, col)))
    by_height = [(y0, max(c[2] for c in own), own) for y0, own in sorted(bands.items())]
    held: dict[tuple, list[tuple]] = {}
    for text, x0, y0, x1, y1, block, line, word_no, a, b in words:
        x, y = (x0 + x1) / 2, (y0 + y1) / 2
        for top, deepest, own in by_height:
            if top > y:
                break
            if y <= deepest:
                for left, right, bottom, cell in own:
                    if left <= x <= right and y <= bottom:
                        held.setdefault(cell, []).append((block, line, word_no, text, x0, y0, y1, a, b))
    out = []
    for number, own in found.items():
        last = max(col for _, col in own)
        texts = [[_said(held[number, row, col]) if (number, row, col) in held else "" for col in range(last + 1)] for row in sorted({row for row, _ in own})]
        x0, y0, x1, y1 = zip(*own.values())
        out.append((number, texts, min(x0), min(y0), max(x1), max(y1)))
    return out


def ruled_tables(drawings: DataFrame, words: DataFrame) -> DataFrame:
    """(doc_id, page, table_no, rows, corners) of the grids that the drawings (item, corners) rule.

    ``words`` has block_no, line_no, word_no, text, corners and the direction a, b. A page
    with few drawings is walked once, with its words streaming past; pages with more (or
    with corners at infinity) are worked on by windows and joins. Defined
    cases: a place in the grid without a cell of its own, as under a merged one, reads
    empty; lines that close no two cells draw no table; a null or NaN corner draws nothing;
    repeated drawings are one; empty frames give no tables.
    """
    whole = F.lit(True)
    for c in CORNERS:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    keyed = [F.col("doc_id").cast("string").alias("doc_id"), F.col("page").cast("int").alias("page")]
    drawn = drawings.where(whole).select(*keyed, "item", *[F.col(c).cast("double").alias(c) for c in CORNERS])
    said = words.withColumns({"doc_id": F.col("doc_id").cast("string"), "page": F.col("page").cast("int")})
    endless = F.greatest(*[F.abs(c) for c in CORNERS]) == float("inf")
    sizes = cut(drawn.groupBy(*KEY).agg(F.count("*").alias("n"), F.bool_or(endless).alias("endless")).select(*KEY, ((F.col("n") > spatial.CROWDED) | F.col("endless")).alias("crowded")))
    n, n_crowded = sizes.agg(F.count("*"), F.count_if("crowded")).first()
    if n <= spatial.SMALL:
        sizes = F.broadcast(sizes)
    few, many = sizes.where("not crowded").select(*KEY), sizes.where("crowded").select(*KEY)
    own = lambda rows, pages: rows.join(pages, list(KEY), "left_semi")
    none = lambda *names: [F.lit(None).cast("int").alias(name) for name in names]
    shapes = (own(drawn, few) if n_crowded else drawn).select(*KEY, F.lit(0).alias("kind"), F.col("item").alias("text"), *CORNERS, *none("block_no", "line_no", "word_no"), *[F.lit(None).cast("double").alias(c) for c in "ab"])
    spoken = own(said.where(whole), few).select(*KEY, F.lit(1).alias("kind"), "text", *[F.col(c).cast("double").alias(c) for c in CORNERS], *[F.col(c).cast("int").alias(c) for c in ("block_no", "line_no", "word_no")], *[F.col(c).cast("double").alias(c) for c in "ab"])
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.list_(pa.string())), *[pa.float64()] * 4]
    schema = "doc_id string, page int, table_no int, rows array<array<string>>, x0 double, y0 double, x1 double, y1 double"
    found = by_page(shapes.unionByName(spoken), _page_tables, [*KEY, "table_no", "rows", *CORNERS], kinds, schema, stream=True)
    return found.unionByName(_crowded_tables(own(drawn, many), own(said, many))) if n_crowded else found


FOUND = "array<struct<table_no:int,rows:array<array<string>>,x0:double,y0:double,x1:double,y1:double>>"


def _whole(x: Column) -> Column:
    out = F.lit(True)
    for c in CORNERS:
        out = out & x[c].isNotNull() & ~F.isnan(x[c].cast("double"))
    return out


def is_crowded(drawings: Column) -> Column:
    """Whether a page's drawings (an array) are for windows and joins: too many to be walked, or with corners at infinity."""
    many = F.when(F.size(drawings) > spatial.CROWDED, F.size(F.filter(drawings, _whole)) > spatial.CROWDED).otherwise(False)
    endless = lambda d: (F.greatest(*[F.abs(d[c].cast("double")) for c in CORNERS]) == float("inf")) & _whole(d)
    # Shapes are looked at one by one only where some corner is at infinity.
    somewhere = F.lit(False)
    for c in CORNERS:
        for end in (float("inf"), float("-inf")):
            somewhere = somewhere | F.coalesce(F.array_contains(drawings[c].cast("array<double>"), F.lit(end)), F.lit(False))
    return F.coalesce(many | F.when(somewhere, F.exists(drawings, endless)).otherwise(False), F.lit(False))


def tables_in(pages: DataFrame, words: str) -> DataFrame:
    """Adds ``native``, what ``ruled_tables`` finds, to pages with their ``drawings`` and words as arrays; null on crowded pages.

    Drawings and words travel to Python as they are, and only where there are two drawings,
    since one shape alone is no table; there all pages of a batch are worked on together.
    """
    ship_package(pages.sparkSession)

    @F.arrow_udf(FOUND)
    def walk(shapes: pa.Array, said: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], grid_batches.TABLES), *[_tables_at_once(shapes.slice(at, CHUNK), said.slice(at, CHUNK)) for at in range(0, len(shapes), CHUNK)]])

    drawn = pages.withColumn("_crowded", is_crowded(F.col("drawings")))
    ruled = ~F.col("_crowded") & (F.size("drawings") > 1)
    # Not to be worked out anew in each expression that uses it.
    once = walk.asNondeterministic()
    found = once(F.when(ruled, F.col("drawings")), F.when(ruled, F.col(words)))
    return drawn.withColumn("native", F.when(~F.col("_crowded"), found)).drop("_crowded")


def _tables_at_once(shapes: pa.ListArray, said: pa.ListArray) -> pa.ListArray:
    """The tables of some pages: of all at once, and one by one of those that are left."""
    found, left = grid_batches.tables_of(shapes, said, SNAP)
    alone = np.flatnonzero(left)
    if not len(alone):
        return found
    names, out = ("table_no", "rows", *CORNERS), []
    placed = lambda row: all(c is not None and c == c for c in row[1:5])
    for own, spoken in zip(_tuples(shapes.take(pa.array(alone)), grid_batches.SHAPE), _tuples(said.take(pa.array(alone)), grid_batches.WORD)):
        out.append([dict(zip(names, table)) for table in _tables_of([*filter(placed, own)], filter(placed, spoken))])
    order = np.arange(len(found))
    order[alone] = len(found) + np.arange(len(alone))
    return pa.concat_arrays([found, pa.array(out, grid_batches.TABLES)]).take(pa.array(order))


def found_in(pages: DataFrame, words: str) -> DataFrame:
    """Adds ``native`` to all pages (doc_id, page, drawings, words as arrays), crowded ones too, which alone are shuffled."""
    crowded = pages.where(is_crowded(F.col("drawings"))).select(*KEY, "drawings", F.col(words).alias("said"))
    found = tables_in(pages, words)
    if not crowded.limit(1).count():
        return found
    rows = lambda name: crowded.select(*KEY, F.inline(name))
    many = ruled_tables(rows("drawings"), rows("said")).groupBy(*KEY).agg(F.collect_list(F.struct("table_no", "rows", *CORNERS)).cast(FOUND).alias("_native"))
    return found.join(cut(many), list(KEY), "left").withColumn("native", F.coalesce("native", "_native")).drop("_native")


def _tuples(column: pa.ListArray, names: dict[str, pa.DataType]) -> Iterator[list[tuple]]:
    """The structs of each row of an array column as tuples of the named fields; none for null."""
    each = list(zip(*(c.to_pylist() for c in grid_batches.fields(column, names))))
    at = 0
    for n in column.value_lengths().to_pylist():
        yield each[at : at + (n or 0)]
        at += n or 0


def _crowded_tables(drawn: DataFrame, said: DataFrame) -> DataFrame:
    """The same for pages of many drawings."""
    filled = cell_texts(placed_cells(cells(crossings(ruled_lines(drawn)))), said)
    table = [*KEY, "table_no"]
    hull = [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]
    by_row = filled.groupBy(*table, "row").agg(F.map_from_entries(F.collect_list(F.struct("col", "text"))).alias("texts"), F.max("col").alias("last"), *hull)
    found = by_row.groupBy(*table).agg(F.transform(F.array_sort(F.collect_list(F.struct("row", F.map_entries("texts").alias("texts")))), lambda r: r["texts"]).alias("own"), F.max("last").alias("last"), *hull)
    rows = F.transform("own", lambda r: F.transform(F.sequence(F.lit(0), F.col("last")), lambda c: F.coalesce(F.try_element_at(F.map_from_entries(r), c), F.lit(""))))
    return found.select(*table, rows.alias("rows"), *CORNERS)
