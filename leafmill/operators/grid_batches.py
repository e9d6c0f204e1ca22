"""The ruled tables of many small pages at once: what ``grids`` finds page by page, over arrays of all their edges, crossings and words.

A page that needs more than the plain case - many crossings or words, cells whose nearest
corner does not close, sideways words, missing or repeated word numbers - is named in
``left`` and walked on its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from leafmill.operators.geometry import SKEW
from leafmill.operators.spatial import CORNERS

#: Pages with more pairs of lines, or of cells and words, are walked on their own.
PAIRS = 8192
TABLES = pa.list_(pa.struct([("table_no", pa.int32()), ("rows", pa.list_(pa.list_(pa.string()))), *[(c, pa.float64()) for c in CORNERS]]))

SHAPE = {"item": pa.string(), **{c: pa.float64() for c in CORNERS}}
WORD = {"text": pa.string(), **{c: pa.float64() for c in CORNERS}, **{c: pa.int32() for c in ("block_no", "line_no", "word_no")}, "a": pa.float64(), "b": pa.float64()}


def fields(column: pa.ListArray, names: dict[str, pa.DataType]) -> list[pa.Array]:
    """The named fields of an array column's structs, row after row."""
    items = column.flatten()
    own = dict(zip((f.name for f in items.type), items.flatten()))
    return [own[name].cast(kind, safe=False) for name, kind in names.items()]


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(sizes))


def _first(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    fresh = np.zeros(len(keys[0]), bool)
    fresh[:1] = True
    for key in keys:
        fresh[1:] |= key[1:] != key[:-1]
    return fresh


def _pairs(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the entries of two ascending arrays of page numbers that are of one page, in order."""
    sizes = np.bincount(right, minlength=n)
    times = sizes[left]
    a = np.repeat(np.arange(len(left)), times)
    return a, np.arange(len(a)) - np.repeat(_starts(times)[:-1], times) + _starts(sizes)[left[a]]


def _pieces(page: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray, snap: float) -> tuple[np.ndarray, ...]:
    """(page, line, at, a, b) of the joined edges of one axis, in order of page, line and piece."""
    if not len(page):
        return page, page, at, a, b
    order = np.lexsort((at, page))
    page, at, a, b = page[order], at[order], a[order], b[order]
    turn, step = _first(page), np.diff(at, prepend=at[:1])
    apart = turn | (step > snap)
    begins, line = np.flatnonzero(apart), np.cumsum(apart) - 1
    fresh = apart | (step != 0)
    # As exact as a sum with compensation.
    mean = (np.add.reduceat(np.where(fresh, at, 0.0).astype(np.longdouble), begins).astype(float)) / np.add.reduceat(fresh, begins, dtype=np.int64)
    order = np.lexsort((b, a, line))
    a, b, line = a[order], b[order], line[order]
    ends, rank = np.unique(b, return_inverse=True)
    reach = ends[np.maximum.accumulate(line * len(ends) + rank) % len(ends)]
    gap = _first(line)
    gap[1:] |= a[1:] > reach[:-1] + snap
    begins = np.flatnonzero(gap)
    own = line[begins]
    first_line = np.maximum.accumulate(np.where(turn, np.cumsum(apart) - 1, 0))
    number = line - first_line  # pages and lines ascend alike in both orders
    return page[begins], number[begins], mean[own], a[begins], np.maximum.reduceat(b, begins)


def _edges(shapes: pa.ListArray, page: np.ndarray, snap: float) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """(page, at, a, b) of the horizontal and of the vertical edges, as ``grids.edges`` has them."""
    item, *corners = fields(shapes, SHAPE)
    x0, y0, x1, y1 = (c.to_numpy(zero_copy_only=False) for c in corners)
    is_box = pc.fill_null(pc.equal(item, "re"), False).to_numpy(zero_copy_only=False)
    curve = pc.fill_null(pc.equal(item, "c"), False).to_numpy(zero_copy_only=False)
    l, r, t, u = np.minimum(x0, x1), np.maximum(x0, x1), np.minimum(y0, y1), np.maximum(y0, y1)
    thin = np.minimum(r - l, u - t) <= snap
    curve |= np.isnan(r - l) | np.isnan(u - t)  # a missing corner draws nothing either
    one, four = np.flatnonzero(thin & ~curve), np.flatnonzero(~thin & ~curve & is_box)
    sides = [(one, l, t, r, u), (four, l, t, r, t), (four, l, u, r, u), (four, l, t, l, u), (four, r, t, r, u)]
    page = page[np.concatenate([s[0] for s in sides])]
    l, t, r, u = (np.concatenate([s[k][s[0]] for s in sides]) for k in range(1, 5))  # noqa: E741
    flat = (r - l > u - t) & (r - l >= snap)
    tall = ~flat & (u - t >= snap)
    return (page[flat], ((t + u) / 2)[flat], l[flat], r[flat]), (page[tall], ((l + r) / 2)[tall], t[tall], u[tall])


def _next(flag: np.ndarray, along: np.ndarray) -> np.ndarray:
    """The number of the nearest later entry of the same run of ``along`` that has the flag, or -1."""
    n = len(flag)
    later = np.append(np.minimum.accumulate(np.where(flag, np.arange(n), n)[::-1])[::-1][1:], n)
    there = np.minimum(later, n - 1)
    return np.where((later < n) & (along[there] == along), there, -1)


def _cells(flat: tuple[np.ndarray, ...], tall: tuple[np.ndarray, ...], n: int, snap: float) -> tuple[np.ndarray, tuple[np.ndarray, ...], np.ndarray]:
    """(page, (top, left, right, bottom), corners) of the cells, sorted, and the pages left."""
    left = np.bincount(flat[0], minlength=n) * np.bincount(tall[0], minlength=n) > PAIRS
    flat, tall = (tuple(c[~left[own[0]]] for c in own) for own in (flat, tall))
    (page, top, y, c, d), (_, side, x, a, b) = flat, tall
    h, v = _pairs(page, tall[0], n)
    met = (a[v] - snap <= y[h]) & (y[h] <= b[v] + snap) & (c[h] - snap <= x[v]) & (x[v] <= d[h] + snap)
    h, v = h[met], v[met]
    if not len(h):
        return page[:0], (page[:0],) * 4, (y[:0],) * 4, left
    lowest, rightmost = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    np.maximum.at(lowest, v, h)
    np.maximum.at(rightmost, h, v)
    down, across = h != lowest[v], v != rightmost[h]
    right = _next(down, h)
    turned = np.lexsort((h, v))
    below = np.empty(len(h), np.int64)
    found = _next(across[turned], v[turned])
    below[turned] = np.where(found >= 0, turned[found], -1)
    start = np.flatnonzero(down & across & (right >= 0) & (below >= 0))
    h2, v2 = h[below[start]], v[right[start]]
    code, wanted = h * len(x) + v, h2 * len(x) + v2
    closed = code[np.minimum(np.searchsorted(code, wanted), len(code) - 1)] == wanted
    left[page[h[start[~closed]]]] = True
    start, h2, v2 = start[closed], h2[closed], v2[closed]
    h, v = h[start], v[start]
    keep = ~left[page[h]]
    h, v, h2, v2 = h[keep], v[keep], h2[keep], v2[keep]
    order = np.lexsort((top[h2], side[v2], side[v], top[h], page[h]))
    h, v, h2, v2 = h[order], v[order], h2[order], v2[order]
    return page[h], (top[h], side[v], side[v2], top[h2]), (x[v], y[h], x[v2], y[h2]), left


def _linked(page: np.ndarray, top: np.ndarray, left: np.ndarray, right: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """For every cell the first of those that are linked with it by shared corners."""
    wide = int(max(right.max(initial=0), bottom.max(initial=0))) + 1
    code = np.concatenate([(page * wide + across) * wide + down for across, down in ((left, top), (right, top), (left, bottom), (right, bottom))])
    points, at = np.unique(code, return_inverse=True)
    at, first = at.reshape(4, -1), np.arange(len(page))
    while len(page):
        least = np.full(len(points), len(page))
        np.minimum.at(least, at.ravel(), np.tile(first, 4))
        then = least[at].min(axis=0)
        then = np.minimum(then, then[then])
        if (then == first).all():
            break
        first = then
    return first


def _rank(table: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The place of a value among its table's distinct ones; tables are numbered from 0."""
    wide = int(value.max(initial=0)) + 1
    codes, at = np.unique(table * wide + value, return_inverse=True)
    return at - np.searchsorted(codes, table * wide)


def tables_of(shapes: pa.ListArray, said: pa.ListArray, snap: float) -> tuple[pa.ListArray, np.ndarray]:
    """The tables of pages from their shapes (item, corners) and words (text, corners, numbers, a, b), and the pages left, which have none here."""
    n = len(shapes)
    sizes = shapes.value_lengths().fill_null(0).to_numpy()
    flat, tall = (_pieces(*own, snap) for own in _edges(shapes, np.repeat(np.arange(n), sizes), snap))
    page, lines, corners, left = _cells(flat, tall, n, snap)

    def only(keep: np.ndarray) -> None:
        nonlocal page, lines, corners, first
        kept = np.cumsum(keep) - 1
        page, lines, corners, first = page[keep], tuple(x[keep] for x in lines), tuple(x[keep] for x in corners), kept[first[keep]]

    first = _linked(page, *lines)
    only(np.bincount(first, minlength=len(first))[first] > 1)

    # Words: which cells hold their centres.
    on = np.repeat(np.arange(n), said.value_lengths().fill_null(0).to_numpy())
    many = np.bincount(page, minlength=n) * np.bincount(on, minlength=n) > PAIRS
    left |= many
    only(~many[page])
    text, x0, y0, x1, y1, *rest = fields(said, WORD)
    x0, y0, x1, y1 = (c.to_numpy(zero_copy_only=False) for c in (x0, y0, x1, y1))
    near = np.flatnonzero(np.bincount(page, minlength=n)[on] > 0)
    x, y = ((x0 + x1) / 2)[near], ((y0 + y1) / 2)[near]
    w, cell = _pairs(on[near], page, n)
    inside = (corners[0][cell] <= x[w]) & (x[w] <= corners[2][cell]) & (corners[1][cell] <= y[w]) & (y[w] <= corners[3][cell])
    w, cell = near[w[inside]], cell[inside]
    missing = np.zeros(len(on), bool)
    for column in (text, *rest[:3]):
        missing |= column.is_null().to_numpy(zero_copy_only=False)
    block, line, number = (c.fill_null(0).to_numpy().astype(np.int64) for c in rest[:3])
    a, b = (c.fill_null(1.0).to_numpy() for c in rest[3:])
    odd = missing | ((np.abs(a) < SKEW) & (SKEW <= np.abs(b)))
    order = np.lexsort((number[w], line[w], block[w], cell))
    w, cell = w[order], cell[order]
    again = np.flatnonzero(~_first(cell, block[w], line[w], number[w]))
    left[on[w[odd[w]]]] = True
    left[on[w[again]]] = True
    fine = ~left[page]
    w, cell = w[fine[cell]], (np.cumsum(fine) - 1)[cell[fine[cell]]]
    only(fine)

    # The cells' texts: words to lines, lines to texts.
    begins = np.flatnonzero(_first(cell, block[w], line[w]))
    read = text.take(pa.array(w))
    if len(begins) < len(w):
        read = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(begins, len(w)), pa.int32()), read), " ")
    by_cell = _starts(np.bincount(cell[begins], minlength=len(page)))
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(by_cell, pa.int32()), read), "\n")

    # Tables in order of their first row and column; places without a cell read empty.
    heads = np.flatnonzero(first == np.arange(len(first)))
    leftmost = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(leftmost, first, lines[1])
    heads = heads[np.lexsort((heads, leftmost[heads], lines[0][heads], page[heads]))]
    number_of = np.zeros(len(first), np.int64)
    number_of[heads] = np.arange(len(heads))
    table = number_of[first]
    row, col = _rank(table, lines[0]), _rank(table, lines[1])
    height, width = np.zeros(len(heads), np.int64), np.zeros(len(heads), np.int64)
    np.maximum.at(height, table, row + 1)
    np.maximum.at(width, table, col + 1)
    base = _starts(height * width)
    place = base[table] + row * width[table] + col
    grid = np.full(int(base[-1]), len(page))
    grid[place[::-1]] = np.arange(len(page))[::-1]  # of two cells in one place the first
    shown = np.zeros(len(page), bool)
    shown[grid[grid < len(page)]] = True
    said_there = pa.concat_arrays([texts, pa.array([""], pa.string())]).take(pa.array(grid))
    rows = pa.ListArray.from_arrays(pa.array(_starts(np.repeat(width, height)), pa.int32()), said_there)
    rows = pa.ListArray.from_arrays(pa.array(_starts(height), pa.int32()), rows)
    hull = []
    for k, (pick, least) in enumerate(((np.minimum, np.inf), (np.minimum, np.inf), (np.maximum, -np.inf), (np.maximum, -np.inf))):
        edge = np.full(len(heads), least)
        pick.at(edge, table[shown], corners[k][shown])
        hull.append(pa.array(edge))
    of_page = _starts(np.bincount(page[heads], minlength=n))
    numbers = np.arange(len(heads)) - of_page[page[heads]]
    found = pa.StructArray.from_arrays([pa.array(numbers, pa.int32()), rows, *hull], fields=list(TABLES.value_type))
    return pa.ListArray.from_arrays(pa.array(of_page, pa.int32()), found).cast(TABLES), left
