"""Centroid clustering, with nearest centroids found by the threshold algorithm.

Vectors become integer vectors, so distances, sums and means are exact and runs agree
whatever the order of rows.  Centroids start as the vectors whose ids have the smallest
hashes; each round assigns every vector to the nearest centroid (ties: the smaller
number) and moves each centroid that has vectors to the floor of their mean.

Search.  Every dimension has the list of its centroid values in order.  From a vector's
own value the lists are walked outward, all dimensions by one centroid a step, the nearer
side first; a centroid met for the first time is measured exactly.  A centroid not met
yet lies, in each dimension, at least as far as that list's frontier: when the squared
frontier distances sum to strictly more than the best exact distance, no other centroid
can win or tie, and the walk stops.

Scale.  A round is one pass over the vectors and a sum per cluster and dimension,
combined in each task: a task ships one row per cluster, never a vector.  Centroids
(``k`` rows) go through the driver; nothing that grows with the table does.  The integer
vectors are checkpointed once, and each round reads them from there.

Defined cases: vectors that are null, of another length, or hold null or non-finite
entries have no row; repeated rows each have one; null ids come last in the hash order,
equal hashes in the order of their vectors; with fewer than ``k`` vectors each is a
centroid; an empty table gives an empty result; other columns do not matter.  Entries
beyond +-2^27 after scaling are an error, as exact distances might not fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglynx.llm import vectors
from loglynx.llm.common import cut

BLOCK = 1024  # vectors that walk together
FAR = np.iinfo(np.int64).max
LIMIT = 1 << 27


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each vector's nearest centroid, by the threshold algorithm."""
    k, dim = centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable").T  # dimension -> centroids by value
    lists = np.take_along_axis(centroids.T, order, 1)
    dims = np.arange(dim)
    best, at = np.full(len(x), FAR), np.full(len(x), k)
    alive = np.arange(len(x))
    high = np.stack([np.searchsorted(lists[j], x[:, j]) for j in range(dim)], 1)
    low = high - 1
    met = np.zeros((len(x), k), bool)

    def frontier(v, low, high):
        below = np.where(low >= 0, v - lists[dims, np.maximum(low, 0)], FAR)
        above = np.where(high < k, lists[dims, np.minimum(high, k - 1)] - v, FAR)
        return below, above

    below, above = frontier(x, low, high)
    while len(alive):
        v = x[alive]
        down = below <= above
        who = order[dims, np.where(down, low, high)]
        low, high = low - down, high + ~down
        fresh = np.zeros((len(alive), k), bool)
        fresh[np.arange(len(alive))[:, None], who] = True
        fresh &= ~met[alive]
        r, c = np.nonzero(fresh)
        met[alive] |= fresh
        exact = np.full((len(alive), k), FAR)
        exact[r, c] = ((v[r] - centroids[c]) ** 2).sum(1)
        number = exact.argmin(1)
        found = exact[np.arange(len(alive)), number]
        won = (found < best[alive]) | ((found == best[alive]) & (number < at[alive]))
        best[alive[won]], at[alive[won]] = found[won], number[won]
        below, above = frontier(v, low, high)
        step = np.minimum(below, above)
        ended = (step == FAR).any(1)  # a list that is walked to both ends has met every centroid
        bound = (np.where(ended[:, None], 0, step) ** 2).sum(1)
        on = ~ended & (bound <= best[alive])
        alive, low, high, below, above = alive[on], low[on], high[on], below[on], above[on]
    return at, best


def integer_vectors(rows: DataFrame, dim: int, scale: int, key: str, vector: str) -> DataFrame:
    """(key, x array<long>) of the usable vectors."""
    def run(batches):
        for batch in batches:
            for n, (at, m) in vectors.matrices(batch.column(1)).items():
                if n == dim:
                    x = vectors.scaled(m, scale, LIMIT)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * dim), pa.array(x.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), lists], names=["key", "x"])

    inner = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("x"))
    return inner.mapInArrow(run, f"key {inner.schema['key'].dataType.simpleString()}, x array<long>")


def _blocks(batches, centroids: np.ndarray):
    """(batch slice, its vectors, numbers, distances)"""
    dim = centroids.shape[1]
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            yield part, x, *nearest(x, centroids)


def moved(ints: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: the floor of the mean of each centroid's vectors; centroids without vectors stay."""
    k, dim = centroids.shape

    def sums(batches):
        total, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, x, number, _ in _blocks(batches, centroids):
            np.add.at(total, number, x)
            n += np.bincount(number, minlength=k)
        at = np.flatnonzero(n)
        if len(at):
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * dim), pa.array(total[at].reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), lists], names=["number", "n", "total"])

    parts = ints.mapInArrow(sums, "number long, n long, total array<long>")
    found = parts.groupBy("number").agg(F.sum("n").alias("n"), F.array(
        *[F.sum(F.col("total")[j].cast("decimal(38,0)")) for j in range(dim)]).alias("total"))
    out = centroids.copy()
    for row in found.collect():  # k rows at most
        out[row["number"]] = [int(t) // row["n"] for t in row["total"]]
    return out


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2,
            key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector: key, cluster, distance, cluster_inertia, inertia, centroid (array<long>)."""
    ints = cut(integer_vectors(rows, dim, scale, key, vector))
    spark = rows.sparkSession
    first = ints.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256).alias("h"), "x")
    first = first.orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()
    key_type = ints.schema["key"].dataType.simpleString()
    if not first:
        return spark.createDataFrame([], f"`{key}` {key_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    centroids = np.array([r["x"] for r in first], np.int64)
    for _ in range(rounds):
        centroids = moved(ints, centroids)

    def assign(batches):
        for part, _, number, distance in _blocks(batches, centroids):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(number.astype(np.int32)), pa.array(distance)],
                                             names=["key", "cluster", "distance"])

    told = cut(ints.mapInArrow(assign, f"key {key_type}, cluster int, distance long"))
    spread = {r["cluster"]: int(r["s"]) for r in told.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(spread.values())
    ends = spark.createDataFrame([(i, spread[i], total, centroids[i].tolist()) for i in sorted(spread)],
                                 "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return told.join(F.broadcast(ends), "cluster").select(  # k rows
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid")

