"""Rectangles that belong together, grown into hulls: a small helper of the page operators.

Parts come one after another, from the top. A new part takes up with the first hull that
it belongs to, the grown hull with the first one that it then belongs to, and so on until
it belongs to none; a hull keeps the place of the first of its parts. Only what has just
grown can belong to something new, so that alone is looked at, and a grid of cells tells
what lies near it: with each growth only the cells that are new to the hull are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heapify, heappop
from math import floor

Box = tuple[float, float, float, float]
#: Cells across a page, at most.
ACROSS = 256


class _Grid:
    def __init__(self, boxes: list[Box], gap: float):
        n, self.gap = len(boxes), gap
        wide = max(b[2] for b in boxes) - min(b[0] for b in boxes)
        high = max(b[3] for b in boxes) - min(b[1] for b in boxes)
        self.cell = max(1.0, 2 * gap, sum(max(b[2] - b[0], b[3] - b[1]) for b in boxes) / n, max(wide, high) / ACROSS)
        self.held: dict[tuple[int, int], set[int]] = {}

    def reach(self, b: Box) -> tuple[int, int, int, int]:
        c, g = self.cell, self.gap
        return floor((b[0] - g) / c), floor((b[1] - g) / c), floor((b[2] + g) / c), floor((b[3] + g) / c)

    def cells(self, now: tuple[int, int, int, int], before: tuple[int, int, int, int] | None) -> Iterator[tuple[int, int]]:
        """The cells of ``now`` that ``before``, which lies within it, does not have."""
        x0, y0, x1, y1 = now
        if before is None:
            for x in range(x0, x1 + 1):
                for y in range(y0, y1 + 1):
                    yield x, y
            return
        a0, b0, a1, b1 = before
        for x in range(x0, x1 + 1):
            if a0 <= x <= a1:
                for y in range(y0, b0):
                    yield x, y
                for y in range(b1 + 1, y1 + 1):
                    yield x, y
            else:
                for y in range(y0, y1 + 1):
                    yield x, y


def grown(boxes: list[Box], together: Callable[[Box, Box], bool], gap: float) -> list[tuple[Box, list[int]]]:
    """The hulls, from the top and then the left, each with the numbers of its parts.

    ``together`` says whether two hulls belong together, which only those can that
    overlap once one of them is grown by ``gap``.
    """
    if not boxes:
        return []
    grid = _Grid(boxes, gap)
    hulls: dict[int, Box] = {}
    parts: dict[int, list[int]] = {}
    spans: dict[int, tuple[int, int, int, int]] = {}
    beside: dict[int, set[int]] = {}  # the hulls with which a hull shares a cell

    def enter(k: int, span: tuple[int, int, int, int]) -> None:
        """Put hull k into the cells of the span that it does not have yet."""
        own = beside[k]
        for cell in grid.cells(span, spans.get(k)):
            there = grid.held.setdefault(cell, set())
            for found in there:
                if found not in own and found != k:
                    own.add(found)
                    beside[found].add(k)
            there.add(k)
        spans[k] = span

    for now, new in enumerate(sorted(range(len(boxes)), key=lambda k: (boxes[k][1], boxes[k][0]))):
        hulls[now], parts[now], beside[now] = tuple(boxes[new]), [new], set()
        enter(now, grid.reach(hulls[now]))
        waiting = sorted(beside[now])
        while waiting:
            other = heappop(waiting)
            a, b = hulls[now], hulls[other]
            if not together(a, b):
                continue
            first, gone = min(now, other), max(now, other)
            for cell in grid.cells(spans.pop(gone), None):
                grid.held[cell].discard(gone)
            for found in beside.pop(gone):
                beside[found].discard(gone)
                if found != first:
                    beside[found].add(first)
                    beside[first].add(found)
            parts[first] += parts.pop(gone)
            del hulls[gone]
            hulls[first] = (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))
            enter(first, grid.reach(hulls[first]))
            now, waiting = first, list(beside[first])
            heapify(waiting)
    return [(hulls[k], sorted(parts[k])) for k in sorted(hulls, key=lambda k: (hulls[k][1], hulls[k][0], k))]


def near(a: Box, b: Box, gap: float) -> bool:
    return a[0] - gap < b[2] and b[0] < a[2] + gap and a[1] - gap < b[3] and b[1] < a[3] + gap


def pieces_of_one(gap: float, share: float) -> Callable[[Box, Box], bool]:
    """Near one another, and alike in most of the span of one side: slices of one picture are."""

    def together(a: Box, b: Box) -> bool:
        if not near(a, b, gap):
            return False
        for lo, hi in ((0, 2), (1, 3)):
            least = min(a[hi] - a[lo], b[hi] - b[lo])
            if least > 0 and min(a[hi], b[hi]) - max(a[lo], b[lo]) >= share * least:
                return True
        return False

    return together
