"""Greedy suppression of re-fires, a whole Arrow batch at a time.

A candidate fires if no fire of its key lies in the W seconds before it.  Which ones fire
depends on the last fire before them, so a key is cut into spans of a number of windows.
Within a span every candidate points to the next one that may fire after it (one search
over the seconds of all spans of a batch, each span moved behind the one before); following
these pointers for all spans at once gives their fires in as many steps as a span has
windows, whatever the number of keys.

A span starts with its first candidate, unless a fire before the span silences that.  So a
span also tells, as a step function, with which fire it would be left for every second at
which it can be entered (pointers doubled until they end; equal steps merged).  Only spans
that an earlier candidate of their key can reach are chained, in order of time, and only
spans that a fire does reach are walked again.  Keys whose candidates lie in one span, or
far apart, are done after the first pass.  A hot key's history is split over many tasks;
only its summaries, a few numbers for each span, meet in one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

FOLD_BUCKETS = 64  # windows in one span, at most
SPAN_SECONDS = 1 << 20  # a span of several windows is no longer: bounds its candidates, one a second


def _changes(table: pa.Table | pa.RecordBatch, n_keys: int) -> np.ndarray:
    """Numbers of the rows (without the first) whose keys differ from the row before."""
    n = table.num_rows
    out = np.zeros(max(n - 1, 0), bool)
    for c in table.columns[:n_keys]:
        a, b = c.slice(1), c.slice(0, n - 1)
        out |= np.asarray(pc.fill_null(pc.not_equal(a, b), False)) | (np.asarray(pc.is_null(a)) != np.asarray(pc.is_null(b)))
    return np.flatnonzero(out) + 1


def whole_groups(batches, n_keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups, equal in their first columns, of a sorted stream."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = _changes(batch, n_keys)
        goes_on = held and all(held[-1].column(i)[held[-1].num_rows - 1].as_py() == batch.column(i)[0].as_py() for i in range(n_keys))
        if not len(cuts) and (goes_on or not held):
            held.append(batch)
            continue
        last = int(cuts[-1]) if len(cuts) else 0
        done = [b for b in [*held, batch.slice(0, last)] if b.num_rows]
        if done:
            yield pa.Table.from_batches(done).combine_chunks()
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class Groups:
    """The groups of a table: rows ``start`` to ``end``; each row's group and next candidate."""

    def __init__(self, table: pa.Table, n_keys: int, sec: str, width: str):
        n = table.num_rows
        self.sec = np.asarray(table.column(sec)).astype(np.int64)
        self.width = np.asarray(table.column(width)).astype(np.int64)
        self.start = np.concatenate([[0], _changes(table, n_keys)])
        self.end = np.concatenate([self.start[1:], [n]])
        self.of = np.repeat(np.arange(len(self.start)), self.end - self.start)
        away = self.sec - self.sec[self.start][self.of]
        self.step = int(away.max() + self.width.max()) + 1
        self.line = away + self.of * self.step
        self.next = np.searchsorted(self.line, self.line + self.width, side="right")

    def after(self, last: np.ndarray) -> np.ndarray:
        """The first row of each group later than ``last`` plus the window."""
        away = np.clip(last + self.width[self.start] - self.sec[self.start], -1, self.step - 1)
        return np.searchsorted(self.line, away + np.arange(len(self.start)) * self.step, side="right")

    def walk(self, at: np.ndarray) -> np.ndarray:
        """Which rows fire if each group's first fire is row ``at`` (its end: none)."""
        fires = np.zeros(len(self.sec), bool)
        at, end = at[at < self.end], self.end[at < self.end]
        while len(at):
            fires[at] = True
            at = self.next[at]
            at, end = at[at < end], end[at < end]
        return fires

    def ends(self) -> np.ndarray:
        """The last row that fires, for each row, if that row fires."""
        p = np.where(self.next < self.end[self.of], self.next, np.arange(len(self.sec)))
        while (p[p] != p).any():
            p = p[p]
        return p


def _first_pass(n_keys: int, window: str):
    def run(batches):
        for t in whole_groups(batches, n_keys):
            g = Groups(t, n_keys, "sec", window)
            fires, ends = g.walk(g.start), g.ends()
            # a fire before the span silences less than a window of it: the rows that may then come first
            low = np.asarray(t.column("_span_from")).astype(np.int64)
            head = np.ones(len(low), bool)
            head[1:] = g.sec[:-1] < (low + g.width)[1:]
            head[g.start] = True
            ahead = np.zeros(len(head), bool)
            ahead[:-1] = head[1:] & (g.of[1:] == g.of[:-1])
            same = np.zeros(len(head), bool)
            same[:-1] = ends[1:] == ends[:-1]
            steps = head & ~(ahead & same)  # of equal steps the last
            count = np.zeros(len(head), np.int64)
            count[g.start] = np.add.reduceat(steps.astype(np.int64), g.start)
            offsets = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            first = np.zeros(len(head), bool)
            first[g.start] = True
            yield from (t.append_column("_fires", pa.array(fires)).append_column("_first", pa.array(first))
                        .append_column("_final", pa.array(g.sec[g.end - 1][g.of])).append_column("_leave", pa.array(g.sec[ends]))
                        .append_column("_bounds", pa.ListArray.from_arrays(offsets, pa.array(g.sec[steps])))
                        .append_column("_exits", pa.ListArray.from_arrays(offsets, pa.array(g.sec[ends[steps]])))).to_batches()
    return run


def _chain(key_cols: list[str], window: str):
    n = len(key_cols)

    def run(batches):
        for t in whole_groups(batches, n):
            new = np.zeros(t.num_rows, bool)
            new[np.concatenate([[0], _changes(t, n)])] = True
            sec, final, leave, width = (np.asarray(t.column(c)).astype(np.int64) for c in ("sec", "_final", "_leave", window))
            reached = np.flatnonzero(~new[1:] & (final[:-1] + width[1:] >= sec[1:])) + 1
            bounds, exits = (t.column(c).combine_chunks() for c in ("_bounds", "_exits"))
            bounds, exits = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (bounds, exits))
            offsets, above, out = np.asarray(bounds.offsets), np.asarray(bounds.values), np.asarray(exits.values)
            rows, entered, before, last = [], [], -1, 0
            for i in reached.tolist():
                if before != i - 1:
                    last = int(leave[i - 1])
                before = i
                if last + width[i] < sec[i]:
                    last = int(leave[i])  # it silences nothing here
                    continue
                rows.append(i)
                entered.append(last)
                a, b = offsets[i], offsets[i + 1]
                k = a + int(np.searchsorted(above[a:b], last + width[i], side="right"))
                if k < b:
                    last = int(out[k])
            if rows:
                yield from t.select([*key_cols, "_span"]).take(pa.array(rows)).append_column("_last", pa.array(entered, pa.int64())).to_batches()
    return run


def _second_pass(columns: list[str], n_keys: int, window: str):
    def run(batches):
        for t in whole_groups(batches, n_keys):
            g = Groups(t, n_keys, "sec", window)
            fires = g.walk(g.after(np.asarray(t.column("_last")).astype(np.int64)[g.start]))
            yield from t.select(columns).filter(pa.array(fires)).to_batches()
    return run


def suppress_refires(cands: DataFrame, key_cols: list[str], window_col: str = "window_secs") -> DataFrame:
    """The rows of ``cands`` (column ``sec``) that fire, per key; see the module's text."""
    columns, schema = cands.columns, cands.schema
    width = F.greatest(F.col(window_col).cast("long"), F.lit(1))
    length = width * F.greatest(F.least(F.floor(F.lit(SPAN_SECONDS) / width), F.lit(FOLD_BUCKETS)), F.lit(1))
    keys = [*key_cols, "_span"]
    spanned = cands.withColumn("_span", F.floor(F.col("sec") / length).cast("long")).withColumn("_span_from", F.col("_span") * length)
    rest = [c for c in columns if c not in key_cols]
    spanned = spanned.select(*keys, "_span_from", *rest).repartition(*keys).sortWithinPartitions(*keys, "sec")
    told_schema = T.StructType([*spanned.schema.fields, T.StructField("_fires", T.BooleanType()), T.StructField("_first", T.BooleanType()),
                                T.StructField("_final", T.LongType()), T.StructField("_leave", T.LongType()),
                                T.StructField("_bounds", T.ArrayType(T.LongType())), T.StructField("_exits", T.ArrayType(T.LongType()))])
    told = materialize(spanned.mapInArrow(_first_pass(len(keys), window_col), told_schema))
    spans = told.filter("_first").select(*keys, "sec", window_col, "_final", "_leave", "_bounds", "_exits")
    chain_schema = T.StructType([*[spans.schema[c] for c in keys], T.StructField("_last", T.LongType())])
    entered = materialize(spans.repartition(*key_cols).sortWithinPartitions(*keys).mapInArrow(_chain(key_cols, window_col), chain_schema))
    if entered.isEmpty():
        return told.filter("_fires").select(*columns)
    entered = entered.select(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(keys)], "_last")
    met = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_e{i}")) for i, k in enumerate(keys)])
    plain = told.filter("_fires").join(entered, met, "left_anti").select(*columns)
    again = told.select(*keys, *rest).join(entered, met).select(*keys, *rest, "_last")
    again = again.repartition(*keys).sortWithinPartitions(*keys, "sec")
    return plain.unionByName(again.mapInArrow(_second_pass(columns, len(keys), window_col), schema))
