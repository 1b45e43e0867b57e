"""Tables kept as runs that are merged by size: what the log-structured sinks share.

A table's rows are split into units (a bucket of addresses, a day).  Each batch writes its rows as
one run per unit it touches.  Before that, each unit's newest runs are merged as long as the run
before the merged ones is at most as large as they are: a row is rewritten about once for each
doubling of what came after it, so what a batch writes follows its own rows, not the table, and a
unit has a number of runs that grows with the logarithm of its size.

Layout: ``<root>/d=<batch>/<unit>=<u>`` and ``<root>/m=<batch>/<unit>=<u>/span=<first>-<last>``.  A folder
counts once its write job has committed (``_SUCCESS``); a batch that is run again replaces its own
two folders.  Merges take runs before the batch only, so they do not change by that; runs that a
merge replaced stay for ``KEEP`` batches, for readers that have begun.  Batches of a table are
written one after the other (one stream, or one scheduled job).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATIO = 1  # a run is merged with newer ones that together have at least 1/RATIO of its bytes
KEEP = 2
ALL = 1 << 62


class Run(NamedTuple):
    first: int
    last: int
    made: int  # the batch whose job wrote it
    size: int
    path: str


def fs_of(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _children(fs, path) -> dict:
    return {s.getPath().getName(): s for s in fs.listStatus(path) if s.isDirectory()} if fs.exists(path) else {}


def runs_of(spark: SparkSession, root: str, unit: str, wanted: Callable[[str], bool] = lambda u: True) -> dict[str, list[Run]]:
    """{unit: its committed runs} for the wanted units.  One listing per folder of a batch that still has
    runs, and one per run of a wanted unit."""
    fs, top = fs_of(spark, root)
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    out: dict[str, list] = {}
    for name, made in _children(fs, top).items():
        kind, _, batch = name.partition("=")
        if kind not in ("d", "m") or not fs.exists(new_path(made.getPath(), "_SUCCESS")):
            continue
        for u, folder in _children(fs, made.getPath()).items():
            u = u.removeprefix(f"{unit}=")
            if not wanted(u):
                continue
            of = {f"span={batch}-{batch}": folder} if kind == "d" else _children(fs, folder.getPath())
            for span, at in of.items():
                first, last = map(int, span.removeprefix("span=").split("-"))
                size = sum(s.getLen() for s in fs.listStatus(at.getPath()))
                out.setdefault(u, []).append(Run(first, last, int(batch), size, at.getPath().toString()))
    return out


def current(runs: list, before: int = ALL) -> list:
    """The runs that readers take, in order: those made before batch ``before`` that no other one contains."""
    mine = sorted(r for r in runs if r[1] < before and r[2] < before)
    return [r for r in mine if not any(o[0] <= r[0] and r[1] <= o[1] and (o[1] - o[0], o[2]) > (r[1] - r[0], r[2]) for o in mine)]


def to_merge(runs: list) -> list:
    """The newest runs of a unit that are due."""
    n, size = 1, runs[-1][3] if runs else 0
    while n < len(runs) and runs[-n - 1][3] <= RATIO * size:
        size += runs[-n - 1][3]
        n += 1
    return runs[-n:] if n > 1 else []


def read_runs(spark: SparkSession, schema: T.StructType, runs: list) -> DataFrame:
    """The rows of some runs; no run: no rows."""
    return spark.read.schema(schema).parquet(*[r[4] for r in runs]) if runs else spark.createDataFrame([], schema)


def add_batch(spark: SparkSession, root: str, rows: DataFrame, batch: int, unit: str, unit_of: Column, schema: T.StructType,
              merge: Callable[[DataFrame], DataFrame] = lambda rows: rows, order: tuple = ()) -> None:
    """Add a batch's rows, after merging what is due of the batches before.

    ``unit_of``: the unit of a row.  ``merge``: rows of several runs (with the columns ``unit`` and ``span`` to
    group by) to the merged rows; as they are by default.  Files hold a unit's rows in the order ``order``;
    a unit that is large is split into several files by its measured size."""
    found = runs_of(spark, root, unit)
    due = {u: some for u, runs in found.items() if (some := to_merge(current(runs, batch)))}
    if due:
        spans = spark.createDataFrame([(u, f"{some[0][0]}-{some[-1][1]}") for u, some in due.items()], "_unit string, span string")
        old = read_runs(spark, schema, [r for some in due.values() for r in some]).withColumn(unit, unit_of)
        old = old.join(F.broadcast(spans), F.col(unit).cast("string") == F.col("_unit")).drop("_unit")
        _write(merge(old), f"{root}/m={batch}", [unit, "span"], order)
    _write(rows.select(*schema.names, unit_of.alias(unit)), f"{root}/d={batch}", [unit], order)
    _drop_replaced(spark, found, batch)


def _write(rows: DataFrame, path: str, by: list[str], order: tuple) -> None:
    rows.hint("rebalance", *by).sortWithinPartitions(*by, *order).write.mode("overwrite").partitionBy(*by).parquet(path)


def _drop_replaced(spark: SparkSession, found: dict, batch: int) -> None:
    """Remove runs that a merge of ``KEEP`` batches ago or more contains, and a batch's folder when its last run goes."""
    gone = [r for runs in found.values() for r in runs
            if any(o[0] <= r[0] and r[1] <= o[1] and o[1] - o[0] > r[1] - r[0] and o[2] <= batch - KEEP for o in runs)]
    for r in gone:
        fs, path = fs_of(spark, r[4])
        fs.delete(path, True)
        while not path.getName()[:2] in ("d=", "m="):
            path = path.getParent()
            if _children(fs, path):
                break
            fs.delete(path, True)
