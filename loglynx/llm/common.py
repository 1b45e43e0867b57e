"""Helpers shared by the operators: tables, shared folders, hot keys, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglynx.session import checkpoint_root, work_dir

ASCII_WORD = r"[^\x20\x09-\x0D]+"
HOT_SHARE = 512  # a key with more than 1/HOT_SHARE of all rows is hot: at most HOT_SHARE such keys exist


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage: a reliable checkpoint in the shared folder
    named by ``spark.checkpoint.dir`` (its files go when no plan refers to them)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like ``cut``, as a Parquet table in a fresh folder of the shared folder.  For loops: a checkpoint
    hands on the plan's estimated size, which joins of every round would multiply."""
    path = f"{work_dir(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have (extra columns may clash)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def join_hot(left: DataFrame, right: DataFrame, key: str, rows: str, total: int) -> DataFrame:
    """``left`` left-joined with ``right`` (one row per ``key``; ``rows`` counts the
    left rows of the key).  Keys with over 1/HOT_SHARE of the ``total`` rows, of
    which at most HOT_SHARE can exist, are joined by broadcast, so their rows stay
    where they are; all others are dealt by key.  Keys are not null."""
    limit = max(total // HOT_SHARE, 1000)
    hot = right.where(F.col(rows) > limit)
    cold = right.where(F.col(rows) <= limit)
    flag = free_name(left, "is_hot")
    marked = left.join(F.broadcast(hot.select(key, F.lit(True).alias(flag))), key, "left")
    a = marked.where(F.col(flag)).drop(flag).join(F.broadcast(hot), key)
    b = marked.where(F.col(flag).isNull()).drop(flag).join(cold, key, "left")
    return a.unionByName(b)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b): rows (node, root),
    root being the smallest node reachable; nodes without an edge have no row.

    Alternating large-star and small-star rounds: each round links every node to
    the smallest member of its neighbourhood, so the diameter shrinks by a factor;
    a neighbourhood is never collected, only its minimum (map-side combined), and
    each round ends in a reliable checkpoint.  Empty edges give no rows.
    """
    e = cut(edges.where("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        if e.isEmpty():
            break
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        j = large.join(low2, "a")
        small = j.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            low2.select("a", F.col("m").alias("b")))
        nxt = cut(small.distinct())
        changed = nxt.exceptAll(e).limit(1).count() or e.exceptAll(nxt).limit(1).count()
        e = nxt
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
