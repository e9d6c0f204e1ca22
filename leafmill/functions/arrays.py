"""Arrays of a page's rows, worked on where they are: no row is exploded, nothing is shuffled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once; inside a lambda an expression would be for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def runs(items: Column, same: Callable[[Column, Column], Column]) -> Column:
    """The items of a sorted array as arrays of neighbours that are ``same``."""

    def found(s: Column) -> Column:
        numbers = F.when(F.size(s) > 0, F.sequence(F.lit(1), F.size(s))).otherwise(F.array().cast("array<int>"))
        starts = F.filter(numbers, lambda i: (i == 1) | ~same(F.get(s, i - 1), F.get(s, i - 2)))
        return let(starts, lambda at: F.transform(at, lambda i, k: F.slice(s, i, F.coalesce(F.get(at, k + 1), F.size(s) + 1) - i)))

    return let(items, found)


def alike(*names: str) -> Callable[[Column, Column], Column]:
    """Whether two structs have the same values, nulls included, in these fields."""

    def same(a: Column, b: Column) -> Column:
        out = a[names[0]].eqNullSafe(b[names[0]])
        for name in names[1:]:
            out = out & a[name].eqNullSafe(b[name])
        return out

    return same
