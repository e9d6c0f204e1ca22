"""Minimum-cost role repair and rendering of conversations.

A legal conversation is an optional system turn, then user and assistant turns that
alternate, the last being the assistant's. For each turn a dynamic program over the
automaton's states chooses, at least total cost, whether to keep or change its role,
to merge it into the turn before or to put one empty turn before it; an empty turn may
also follow the last one.

Conversations are split into blocks of ``block`` rows, so none is ever held whole,
whatever its turn numbers: those of more rows are sorted over many tasks, which gives
each row its rank. A first pass then gives each block's cheapest cost between any two
states (the program is a product of min-plus matrices), the few matrices of a
conversation fix the states at the block bounds, and the second pass solves every
block between its bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.runtime import cut, ship_package

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
#: Which state may follow which.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
INFINITY = float("inf")
OUT = "conv_id long, block long, first_turn long, n_turns int, cost double, actions string, roles string, rendered string, end_role string"
KEEP, MERGE, INSERT = "k", "m", "i"


@dataclass(frozen=True)
class RepairCosts:
    merge: float = 1.0
    relabel: float = 5.0
    #: A role that is null or unknown has to be given one.
    unknown: float = 0.5
    insert: float = 2.0


def role_state(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else 0


def moves(state: int, wanted: int, costs: RepairCosts) -> list[tuple[float, int, str, int]]:
    """(cost, new state, action, inserted state) of every way to take a turn whose own role is ``wanted`` (0: unknown)."""
    out = []
    for label in (SYSTEM, USER, ASSISTANT):
        price = costs.unknown if not wanted else 0.0 if label == wanted else costs.relabel
        if label in NEXT[state]:
            out.append((price, label, KEEP, 0))
        if label == state:
            out.append((price + costs.merge, label, MERGE, 0))
        for between in NEXT[state]:
            if label in NEXT[between]:
                out.append((price + costs.insert, label, INSERT, between))
    return out


_MOVES: dict[RepairCosts, list[list[list[tuple[float, int, str, int]]]]] = {}


def _table(costs: RepairCosts) -> list[list[list[tuple[float, int, str, int]]]]:
    if costs not in _MOVES:
        _MOVES[costs] = [[moves(s, w, costs) for w in range(4)] for s in range(4)]
    return _MOVES[costs]


def finish_cost(state: int, costs: RepairCosts) -> float:
    """What it takes to end legally: nothing after an assistant's turn (or without any), one empty turn after a user's."""
    return 0.0 if state in (START, ASSISTANT) else costs.insert if state == USER else 2 * costs.insert


def transfer(wanted: list[int], costs: RepairCosts) -> list[list[float]]:
    """The cheapest cost of a block from every state to every state."""
    rows, table = [], _table(costs)
    for entry in range(4):
        cost = [INFINITY] * 4
        cost[entry] = 0.0
        for w in wanted:
            new = [INFINITY] * 4
            for s in range(4):
                if cost[s] < INFINITY:
                    for price, label, _, _ in table[s][w]:
                        if cost[s] + price < new[label]:
                            new[label] = cost[s] + price
            cost = new
        rows.append(cost)
    return rows


def repair(wanted: list[int], costs: RepairCosts, entry: int = START, end: int | None = None) -> tuple[float, list[tuple[int, str, int]]]:
    """(cost, [(state, action, inserted state)]) of the cheapest path; ``end`` fixes the last state.

    Ties go to the earlier state in the order start, system, user, assistant, and then
    to keeping before merging before inserting.
    """
    table = _table(costs)
    cost = [INFINITY] * 4
    cost[entry] = 0.0
    steps = []
    for w in wanted:
        new, how = [INFINITY] * 4, [None] * 4
        for s in range(4):
            if cost[s] < INFINITY:
                for price, label, action, between in table[s][w]:
                    if cost[s] + price < new[label]:
                        new[label], how[label] = cost[s] + price, (s, action, between)
        steps.append(how)
        cost = new
    if end is None:
        end = min(range(4), key=lambda s: (cost[s] + finish_cost(s, costs), s))
        total = cost[end] + finish_cost(end, costs)
    else:
        total = cost[end]
    path, state = [], end
    for how in reversed(steps):
        before, action, between = how[state]
        path.append((state, action, between))
        state = before
    return total, path[::-1]


def render(path: list[tuple[int, str, int]], texts: list[str], state: int, closes: bool) -> tuple[str, str, str]:
    """(actions, roles, rendered text) of a solved block; ``state`` is where it ends."""
    turns: list[tuple[int, list[str]]] = []
    open_before = False
    for (label, action, between), text in zip(path, texts):
        if action == INSERT:
            turns.append((between, []))
        if action == MERGE:
            if turns:
                turns[-1][1].append(text)
                continue
            open_before = True
            turns.append((label, [text]))
        else:
            turns.append((label, [text]))
    if closes:
        while state not in (START, ASSISTANT):
            state = NEXT[state][0]
            turns.append((state, []))
    roles = "".join("sua"[r - 1] for r, _ in turns)
    parts = [f"<|{ROLES[r - 1]}|>\n" + "\n".join(t) + "\n" for r, t in turns]
    if open_before and parts:
        parts[0] = "\n".join(turns[0][1]) + "\n"  # goes on with the turn that the block before ended in
    return "".join(a for _, a, _ in path), roles, "".join(parts)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with the same (conv_id, block), which sorting has put together."""
    key, rows = None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for row in zip(*columns):
            if row[:2] != key:
                if rows:
                    yield key, rows
                key, rows = row[:2], []
            rows.append(row)
    if rows:
        yield key, rows


def _ranked(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` with the block of each row by its rank in its conversation; equal rows are told apart by their place."""
    # Ranges are found on a sample of their keys, so no whole text is one.
    keys = ["conv_id", "turn", "role", "head", "mark", "place"]
    marked = rows.withColumns({"head": F.substring("text", 1, 32), "mark": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    ordered = marked.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = cut(ordered.select("conv_id", "turn", "role", "text", F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().alias("at")))
    # One row per conversation and partition that it reaches into.
    firsts = ordered.groupBy(F.col("conv_id").alias("long_id"), F.col("slice").alias("long_slice")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("long_id").orderBy("long_slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    joined = ordered.join(firsts, F.col("conv_id").eqNullSafe(F.col("long_id")) & (F.col("slice") == F.col("long_slice")))
    return joined.select("conv_id", "turn", "role", "text", F.floor((F.col("before") + F.col("at") - F.col("first")) / block).cast("long").alias("block"))


def _bounds(long_rows: DataFrame, costs: RepairCosts) -> DataFrame:
    """The states in which every block of the long conversations is entered and left."""

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, part), own in _blocks(batches):
            flat = [x for row in transfer([role_state(r[3]) for r in own], costs) for x in row]
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([part], pa.int64()), pa.array([flat], pa.list_(pa.float64()))], ["conv_id", "block", "m"])

    ordered = long_rows.select("conv_id", "block", "turn", "role").repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role")
    transfers = ordered.mapInArrow(matrices, "conv_id long, block long, m array<double>")

    def bounds(group: pa.Table) -> pa.Table:
        order = group.sort_by("block").to_pylist()
        forward = [[0.0, INFINITY, INFINITY, INFINITY]]
        for row in order:
            now, m = forward[-1], row["m"]
            forward.append([min(now[s] + m[4 * s + e] for s in range(4)) for e in range(4)])
        state = min(range(4), key=lambda s: (forward[-1][s] + finish_cost(s, costs), s))
        out = []
        for k in range(len(order) - 1, -1, -1):
            m = order[k]["m"]
            entry = min(range(4), key=lambda s: (forward[k][s] + m[4 * s + state], s))
            out.append((order[k]["conv_id"], order[k]["block"], entry, state, k == len(order) - 1))
            state = entry
        columns = list(zip(*out))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("long_id", "part", "entry", "leave", "final"), columns, kinds)})

    # A conversation's matrices: sixteen numbers per block of turns.
    return transfers.groupBy("conv_id").applyInArrow(bounds, "long_id long, part long, entry int, leave int, final boolean")


def repair_conversations(turns: DataFrame, costs: RepairCosts | None = None, block: int = 4096) -> DataFrame:
    """One row per conversation and block: cost, actions (k keep or relabel, m merge, i insert before), roles, rendered text.

    Conversations of up to ``block`` rows are one row; the rendered texts of a longer
    one's rows, by ``block``, follow one another. Defined cases: turns are taken
    by turn number, then role, then text (over blocks, by its first 32 characters and then a hash), null first; a null or unknown role is given
    the cheapest one; null texts are empty; repeated rows are turns of their own; rows
    whose conv_id is null form one conversation; an empty table gives no rows; other columns are ignored.
    """
    costs = costs or RepairCosts()
    ship_package(turns.sparkSession)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    of = F.col("conv_id").eqNullSafe(F.col("long_id"))
    sizes = rows.groupBy(F.col("conv_id").alias("long_id")).agg(F.count("*").alias("n")).where(F.col("n") > block).select("long_id")
    if sizes.isEmpty():
        none = [F.lit(None).cast(kind).alias(name) for name, kind in (("entry", "int"), ("leave", "int"), ("final", "boolean"))]
        joined = rows.select("conv_id", F.lit(0).cast("long").alias("block"), "turn", "role", "text", *none)
    else:
        long_ones = cut(sizes)
        long_rows = _ranked(rows.join(long_ones, of, "left_semi"), block)
        placed = rows.join(long_ones, of, "left_anti").withColumn("block", F.lit(0).cast("long")).unionByName(long_rows)
        joined = placed.join(_bounds(long_rows, costs), of & (F.col("block") == F.col("part")), "left")
        joined = joined.select("conv_id", "block", "turn", "role", "text", "entry", "leave", "final")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "block", "first_turn", "n_turns", "cost", "actions", "roles", "rendered", "end_role"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.string(), pa.string(), pa.string(), pa.string()]
        waiting, size = [], 0
        for (conv, part), own in _blocks(batches):
            entry, leave, final = own[0][5:8]
            cost, path = repair([role_state(r[3]) for r in own], costs, START if entry is None else entry, leave)
            state = path[-1][0]
            closes = leave is None or final
            if leave is not None and final:
                cost += finish_cost(state, costs)
            actions, roles, text = render(path, [r[4] for r in own], state, closes)
            waiting.append((conv, part, own[0][2], len(own), cost, actions, roles, text, ROLES[state - 1]))
            size += len(text)
            if size > 4_000_000 or len(waiting) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*waiting), kinds)], names)
                waiting, size = [], 0
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*waiting), kinds)], names)

    return joined.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "text").mapInArrow(solve, OUT)
