"""Which rectangles of a page meet: an equi-join over grid cells whose sizes follow the data.

Most pages hold few rectangles, and their join by (doc_id, page) alone is cheap. On a
crowded page that join is quadratic, so its rectangles are dealt into cells. No single
cell size suits words, rules and page-wide frames at once; a rectangle therefore has a
*level* for each axis, the finest of the grids, each four times finer than the one
before, whose cells are at least as wide (high) as it is. Two rectangles meet on the
coarser of their levels. There the left one is found in one cell, that of its low
corner, and the right one in the few cells from which a left one of that level can
reach it. So every pair is met in exactly one cell, without repeats to remove, a
rectangle is dealt out at most a bounded number of times however large it is, and cells
hold rectangles of one pair of levels, near each other.

Frames have doc_id, page and the corners x0, y0, x1, y1; corners may come in either order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.runtime import cut

CORNERS = ("x0", "y0", "x1", "y1")
KEY = ("doc_id", "page")
#: A page with more rectangles on the right side than this is crowded; else the join by page reads no more than so many for each left one.
CROWDED = 256
#: The finest grid has about so many rectangles a cell if they lie evenly.
PER_CELL = 32
#: So many crowded pages travel to every task; more are joined by key.
SMALL = 50_000
DEEPEST = 8


def _low(d: str) -> Column:
    return F.least(F.col(f"{d}0"), F.col(f"{d}1")).cast("double")


def _high(d: str) -> Column:
    return F.greatest(F.col(f"{d}0"), F.col(f"{d}1")).cast("double")


def _whole() -> Column:
    """Whether all corners are numbers; greatest() and least() pass over nulls."""
    out = F.lit(True)
    for c in CORNERS:
        out = out & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return out


def crowded(left: DataFrame, right: DataFrame) -> DataFrame | None:
    """(doc_id, page, low, extent and depth of the grids) of crowded pages; None if there are none."""
    if right.where(_whole()).groupBy(*KEY).count().where(F.col("count") > CROWDED).count() == 0:
        return None
    ends = [f(d).alias(f"_{n}{d}") for d in "xy" for n, f in (("l", _low), ("h", _high))]
    each = left.where(_whole()).select(*KEY, *ends).unionAll(right.where(_whole()).select(*KEY, *ends))
    finite = lambda c: F.when(F.abs(F.col(c)) < 1e300, F.col(c))
    sizes = [F.count("*").alias("_n")] + [f(finite(f"_{n}{d}")).alias(f"_{n}{d}") for d in "xy" for n, f in (("l", F.min), ("h", F.max))]
    found = each.groupBy(*KEY).agg(*sizes).where(F.col("_n") > CROWDED)
    depth = F.least(F.lit(DEEPEST), F.ceil(F.log(F.col("_n") / PER_CELL) / F.log(F.lit(16.0)))).cast("int")
    found = found.select(*KEY, depth.alias("_depth"), *[c for d in "xy" for c in (F.col(f"_l{d}").alias(f"_from_{d}"), (F.col(f"_h{d}") - F.col(f"_l{d}")).alias(f"_extent_{d}"))])
    found = cut(found)
    n = found.count()
    return None if n == 0 else F.broadcast(found) if n <= SMALL else found


def _level(d: str) -> Column:
    """The finest level whose cells are no smaller; a hair more than exact, so that rounding cannot let one reach over two cells."""
    size = _high(d) - _low(d)
    finest = F.floor(F.log(F.col(f"_extent_{d}") / size) / F.log(F.lit(4.0)) - 1e-9)
    extent = F.col(f"_extent_{d}")
    level = F.when(size <= 0, F.col("_depth")).when(size >= extent, 0).otherwise(F.least(finest, F.col("_depth")))
    return F.greatest(F.lit(0), F.coalesce(F.when(extent > 0, level), F.lit(0))).cast("int")


def _cell(at: Column, d: str, level: Column) -> Column:
    """The number of the cell that a place falls into; places off the page fall into the outer cells."""
    cells = F.pow(F.lit(4.0), level)
    place = F.floor((at - F.col(f"_from_{d}")) / F.col(f"_extent_{d}") * cells)
    return F.coalesce(F.when(F.col(f"_extent_{d}") > 0, F.greatest(F.lit(0.0), F.least(place.cast("double"), cells - 1))), F.lit(0.0)).cast("int")


def touching(left: DataFrame, right: DataFrame, prefix: str = "r_", pages: DataFrame | None = None) -> DataFrame:
    """Pairs of a left and a right rectangle of one page that share a point, edges included, each once.

    The right one's columns, but for doc_id and page, get the prefix. Defined cases: null
    or NaN corners meet nothing; rows that repeat meet each; a null doc_id or page meets
    nothing; empty frames give no pairs. The pages' sizes are looked up first, by small
    aggregates, unless they are given as ``crowded`` finds them.
    """
    columns = left.columns
    theirs = [c for c in right.columns if c not in KEY]
    pages = crowded(left, right) if pages is None else pages
    other = right.where(_whole())
    own = left.where(_whole())
    shown = [*[F.col(f"_r.{k}").alias(f"_{k}") for k in KEY], *[F.col(f"_r.{c}").alias(f"{prefix}{c}") for c in theirs]]
    if pages is None:
        other = other.select(F.struct(*right.columns).alias("_r")).select(*shown)
        pairs = own.join(other, (F.col("doc_id") == F.col("_doc_id")) & (F.col("page") == F.col("_page")))
    else:
        own, other = (rows.join(pages, list(KEY), "left").withColumn("_level", F.struct(_level("x").alias("x"), _level("y").alias("y"))) for rows in (own, other))
        # Few levels a page are in use; uncrowded pages have one.
        levels = lambda rows, name: rows.where("_depth is not null").groupBy(*KEY).agg(F.collect_set("_level").alias(name))
        flat = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))
        seen = cut(levels(own, "_lefts").join(levels(other, "_rights"), list(KEY)))
        seen = F.broadcast(seen) if seen.count() <= SMALL else seen
        own, other = (rows.join(seen.select(*KEY, name), list(KEY), "left").withColumn("_meets", F.explode(F.when(F.col("_depth").isNull(), flat).otherwise(F.col(name)))) for rows, name in ((own, "_rights"), (other, "_lefts")))

        def meeting(d: str) -> Column:
            return F.least(F.col(f"_level.{d}"), F.col(f"_meets.{d}"))

        def upto(d: str) -> Column:
            return F.sequence(F.greatest(F.lit(0), _cell(_low(d), d, meeting(d)) - 1), _cell(_high(d), d, meeting(d)))

        own = own.select(*columns, F.col("_level").alias("_a"), F.col("_meets").alias("_b"), _cell(_low("x"), "x", meeting("x")).alias("_i"), _cell(_low("y"), "y", meeting("y")).alias("_j"))
        other = other.withColumn("_k", F.explode(upto("x"))).withColumn("_m", F.explode(upto("y")))
        other = other.select(F.struct(*right.columns).alias("_r"), F.col("_meets").alias("_c"), F.col("_level").alias("_d"), "_k", "_m").select(*shown, "_c", "_d", "_k", "_m")
        same = [F.col(a) == F.col(b) for a, b in (("doc_id", "_doc_id"), ("page", "_page"), ("_a", "_c"), ("_b", "_d"), ("_i", "_k"), ("_j", "_m"))]
        pairs = own.join(other, same)
    for d in "xy":
        a0, a1, b0, b1 = F.col(f"{d}0"), F.col(f"{d}1"), F.col(f"{prefix}{d}0"), F.col(f"{prefix}{d}1")
        pairs = pairs.where((F.least(a0, a1) <= F.greatest(b0, b1)) & (F.least(b0, b1) <= F.greatest(a0, a1)))
    return pairs.select(*columns, *[f"{prefix}{c}" for c in theirs])
