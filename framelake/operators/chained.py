"""Greedy scans, where each chosen row decides which row is chosen next.

Packing records into blocks ("start a new block when the next record does not
fit") and throttled sampling ("emit when the last emission is old enough") are
sequential by definition, and a stream may be far too large for one task. Both
depend on the past through a single number: bytes used in the open block, or the
time of the last emission. So a sorted slice of a stream acts as a function of
that number, piecewise constant except for one piece that passes it through:

1. every slice computes its function, independently of the others;
2. the functions are composed, in groups of bounded size, level by level, which
   gives the state at the entry of every slice;
3. every slice runs once more from its now known entry state.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.operators.ordered import PART, ROW, lay_out
from framelake.session import durable

# Slices composed together by one task.
FAN_IN = 64
# Rows of a slice, which a task holds at once: a partition is cut into as many as it takes.
SLICE_ROWS = 1 << 18
# State before anything was emitted; low enough that adding a period is safe.
NEVER = -(1 << 60)

# A slice function: for entry states from lo[i] up to lo[i+1], the exit state is
# keep[i] * entry + add[i] and count[i] rows were chosen.
PIECES = "lo array<bigint>, keep array<bigint>, add array<bigint>, count array<bigint>"


def _merge_equal(pieces):
    """Join neighbouring pieces that behave alike."""
    lo, keep, add, count = pieces
    fresh = np.ones(len(lo), dtype=bool)
    fresh[1:] = (np.diff(keep) != 0) | (np.diff(add) != 0) | (np.diff(count) != 0)
    return lo[fresh], keep[fresh], add[fresh], count[fresh]


def _evaluate(pieces, state):
    lo, keep, add, count = pieces
    i = np.searchsorted(lo, state, side="right") - 1
    return int(keep[i] * state + add[i]), int(count[i])


def _compose(first, second):
    """The function "first, then second"."""
    out = []
    ends = np.append(first[0][1:], np.iinfo(np.int64).max)
    for lo, hi, keep, add, count in zip(first[0], ends, first[1], first[2], first[3]):
        if not keep:
            state, more = _evaluate(second, add)
            out.append((lo, 0, state, count + more))
            continue
        # Passed through (shifted by add): every piece of ``second`` it touches.
        for l2, k2, a2, c2, h2 in zip(*second, np.append(second[0][1:], np.iinfo(np.int64).max)):
            start, stop = max(lo, l2 - add), min(hi, h2 - add)
            if start < stop:
                out.append((start, k2, a2 + k2 * add, count + c2))
    columns = np.array(out, dtype=np.int64).T
    return _merge_equal(tuple(columns))


def _walk(starts, following, exit_state):
    """Exit state and number of chosen rows when the chain begins at each of
    ``starts`` (ascending). Chains that meet share the rest of the way."""
    known = {}
    for start in starts[::-1]:
        path, at = [], int(start)
        while at >= 0 and at not in known:
            path.append(at)
            at = int(following[at])
        state, chosen = known[at] if at >= 0 else (None, 0)
        for at in reversed(path):
            if state is None:
                state = int(exit_state[at])
            chosen += 1
            known[at] = (state, chosen)
    return [known[int(s)] for s in starts]


class Packing:
    """State: bytes used in the open block. Chosen rows: first records of blocks."""

    initial = 0

    def __init__(self, capacity: int):
        self.capacity = capacity

    def following(self, sizes):
        """For each record as the first of a block, the first record of the next."""
        ends = np.concatenate([[0], np.cumsum(sizes)])
        nxt = np.searchsorted(ends, ends[:-1] + self.capacity, side="right") - 1
        return ends, np.where(nxt < len(sizes), nxt, -1)

    def first(self, sizes, entry):
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = int(np.searchsorted(ends, self.capacity - entry, side="right")) - 1
        return at if at < len(sizes) else -1

    def pieces(self, sizes):
        ends, nxt = self.following(sizes)
        total = int(ends[-1])
        # Record j opens the first new block for entry states in
        # (capacity - ends[j+1], capacity - ends[j]].
        last = int(np.searchsorted(ends, self.capacity, side="right")) - 1
        starts = np.arange(min(last + 1, len(sizes)))
        results = _walk(starts, nxt, total - ends[:-1])
        rows = []
        if total <= self.capacity:
            rows.append((0, 1, total, 0))
        for j in starts[::-1]:
            lo = max(0, self.capacity - int(ends[j + 1]) + 1)
            if lo <= self.capacity - int(ends[j]):
                rows.append((lo, 0, *results[j]))
        return _merge_equal(tuple(np.array(rows, dtype=np.int64).T))


class Throttling:
    """State: time of the last emission. Chosen rows: emissions.

    Times within a slice are distinct and ascending.
    """

    initial = NEVER

    def __init__(self, period: int):
        self.period = period

    def following(self, times):
        nxt = np.searchsorted(times, times + self.period, side="left")
        return np.where(nxt < len(times), nxt, -1)

    def first(self, times, entry):
        at = int(np.searchsorted(times, entry + self.period, side="left"))
        return at if at < len(times) else -1

    def pieces(self, times):
        nxt = self.following(times)
        # Earlier slices end before this one begins, so only rows less than one
        # period after the first can be beaten by the entry state.
        reach = int(np.searchsorted(times, times[0] + self.period, side="left"))
        starts = np.arange(min(reach + 1, len(times)))
        results = _walk(starts, nxt, times)
        rows = []
        for j in starts:
            lo = NEVER if j == 0 else int(times[j - 1]) - self.period + 1
            rows.append((lo, 0, *results[j]))
        if len(starts) == len(times):
            rows.append((int(times[-1]) - self.period + 1, 1, 0, 0))
        return _merge_equal(tuple(np.array(rows, dtype=np.int64).T))


def _chain(rule, values, entry):
    """Positions chosen in a slice that is entered with a known state."""
    at = rule.first(values, entry)
    nxt = rule.following(values)
    nxt = nxt[1] if isinstance(nxt, tuple) else nxt
    chosen = []
    while at >= 0:
        chosen.append(at)
        at = int(nxt[at])
    return np.array(chosen, dtype=np.int64)


def _key_type(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def _read_pieces(row):
    return tuple(np.asarray(row[c], dtype=np.int64) for c in ("lo", "keep", "add", "count"))


def _entries(nodes: DataFrame, keys: list[str], key_ddl: str, initial: int) -> DataFrame:
    """Entry state and rows chosen before, for every slice in ``nodes``.

    ``nodes`` holds one function per (key, _node), in ascending _node order.
    """
    span = nodes.agg(F.max("_node")).first()[0]
    entry_ddl = f"{key_ddl}, _node bigint, _entry bigint, _before bigint"

    def run(group: pd.DataFrame, state: int, before: int) -> pd.DataFrame:
        group = group.sort_values("_node")
        states, counts = [], []
        for row in group.to_dict("records"):
            states.append(state)
            counts.append(before)
            state, more = _evaluate(_read_pieces(row), state)
            before += more
        return group[[*keys, "_node"]].assign(_entry=states, _before=counts)

    if span is None or span < FAN_IN:
        return nodes.groupBy(*keys).applyInPandas(lambda g: run(g, initial, 0), entry_ddl)

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_node")
        whole = None
        for row in group.to_dict("records"):
            pieces = _read_pieces(row)
            whole = pieces if whole is None else _compose(whole, pieces)
        head = group[[*keys, "_parent"]].head(1).rename(columns={"_parent": "_node"})
        return head.assign(**{n: [list(v)] for n, v in zip(("lo", "keep", "add", "count"), whole)})

    grouped = nodes.withColumn("_parent", F.expr(f"_node div {FAN_IN}"))
    parents = durable(grouped.groupBy(*keys, "_parent").applyInPandas(
        fold, f"{key_ddl}, _node bigint, {PIECES}"))
    above = _entries(parents, keys, key_ddl, initial).withColumnRenamed("_node", "_parent")

    def descend(group: pd.DataFrame, parent: pd.DataFrame) -> pd.DataFrame:
        return run(group, int(parent["_entry"].iloc[0]), int(parent["_before"].iloc[0]))

    return grouped.groupBy(*keys, "_parent").cogroup(
        above.groupBy(*keys, "_parent")).applyInPandas(descend, entry_ddl)


def _cut(rows: DataFrame) -> DataFrame:
    """Laid-out rows with ``_part`` as the number of a slice of at most ``SLICE_ROWS`` rows."""
    # Rows of a partition are numbered from 0 on in the lower bits.
    piece = F.expr(f"({ROW} & {(1 << 33) - 1}) div {SLICE_ROWS}")
    most = rows.agg(F.max(piece)).first()[0]
    return rows.withColumn(PART, F.col(PART) * F.lit((most or 0) + 1) + piece)


def _scan(rows: DataFrame, keys: list[str], value: str, rule, finish, finish_ddl: str) -> DataFrame:
    """Run ``rule`` over laid-out rows; ``finish(slice, chosen, before)`` shapes the output."""
    key_ddl, rows = _key_type(rows, keys), _cut(rows)

    def summarise(group: pd.DataFrame) -> pd.DataFrame:
        values = group.sort_values(ROW)[value].to_numpy(dtype=np.int64)
        head = group[[*keys, PART]].head(1).rename(columns={PART: "_node"})
        return head.assign(**{
            n: [list(v)] for n, v in zip(("lo", "keep", "add", "count"), rule.pieces(values))})

    slim = rows.select(*keys, PART, ROW, value)
    nodes = durable(slim.groupBy(*keys, PART).applyInPandas(
        summarise, f"{key_ddl}, _node bigint, {PIECES}"))
    entries = _entries(nodes, keys, key_ddl, rule.initial).withColumnRenamed("_node", PART)

    def apply(group: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(ROW)
        chosen = _chain(rule, group[value].to_numpy(dtype=np.int64), int(entry["_entry"].iloc[0]))
        return finish(group, chosen, int(entry["_before"].iloc[0]))

    return rows.groupBy(*keys, PART).cogroup(
        entries.groupBy(*keys, PART)).applyInPandas(apply, finish_ddl)


def pack_variable(records: DataFrame, capacity: int, stream: str, order: list[str],
                  length: str) -> DataFrame:
    """Fill blocks with records of varying length, in order, never splitting one.

    One row per block: its records, the bytes used and the bytes left over.
    Records longer than a block cannot be placed; get them from :func:`unpackable`.
    ``order`` may name the length column.
    """
    usable = records.filter(F.col(length).between(0, capacity)).select(
        stream, *[c for c in order if c != stream], F.col(length).cast("bigint").alias("_size"))
    rows = lay_out(usable, [stream], order).select(stream, PART, ROW, "_size")
    ddl = f"{_key_type(rows, [stream])}, block_id bigint, n bigint, used bigint"

    def finish(group, chosen, before):
        opened = np.zeros(len(group), dtype=np.int64)
        opened[chosen] = 1
        out = pd.DataFrame({
            stream: group[stream].to_numpy(), "block_id": before + np.cumsum(opened),
            "size": group["_size"].to_numpy()})
        return out.groupby([stream, "block_id"], as_index=False, dropna=False).agg(
            n=("size", "size"), used=("size", "sum"))

    slices = _scan(rows, [stream], "_size", Packing(capacity), finish, ddl)
    # A block may straddle slices: add its parts up.
    return slices.groupBy(stream, "block_id").agg(
        F.sum("n").alias("n_records"), F.sum("used").alias("used_bytes")).withColumn(
        "pad_bytes", F.lit(capacity) - F.col("used_bytes"))


def unpackable(records: DataFrame, capacity: int, length: str) -> DataFrame:
    return records.filter(~F.coalesce(F.col(length).between(0, capacity), F.lit(False)))


def progress_exact(rows: DataFrame, seconds: int, values: list[str], order: list[str],
                   stream: str = "stream_id", ts: str = "ts") -> DataFrame:
    """Emit a row when at least ``seconds`` passed since the last emitted one.

    The clock counts whole seconds, so within one second only the first row can
    be emitted; reducing to that row first bounds the work by elapsed time.
    """
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    first = (rows.withColumn("_v", F.struct(ts, *values)).withColumn("_o", F.struct(*order))
             .groupBy(stream, second.alias("_second")).agg(F.min_by("_v", "_o").alias("_v")))
    laid = lay_out(first, [stream], ["_second"])
    ddl = f"{_key_type(laid, [stream])}, _second bigint"

    def finish(group, chosen, _before):
        return group[[stream, "_second"]].iloc[chosen]

    emitted = _scan(laid.select(stream, PART, ROW, "_second"), [stream], "_second",
                    Throttling(seconds), finish, ddl)
    kept = emitted.select(F.col(stream).alias("_s"), F.col("_second").alias("_t"))
    same = F.col(stream).eqNullSafe(F.col("_s")) & (F.col("_second") == F.col("_t"))
    return laid.join(kept, same).select(
        stream, *[F.col("_v").getField(c).alias(c) for c in [ts, *values]])
