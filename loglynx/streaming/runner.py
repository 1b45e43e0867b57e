"""Drive a file-source stream over data that arrives in time-ordered chunks.

Each chunk of rendered lines is written as new files under
``<work>/input/cNNN`` and the query is started with ``availableNow`` on the
same checkpoint, as a scheduler would do when new files land.  All folders
live under the session's shared checkpoint root (never a machine-local
temp folder on a cluster).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from .rules import stream_lines


def write_chunk(lines: DataFrame, directory: str) -> None:
    lines.select("value").write.mode("overwrite").text(directory)


def run_chunks(spark: SparkSession, lines: DataFrame, chunk: Column, n_chunks: int,
               build: Callable[[DataFrame], DataFrame], sink: Callable, name: str) -> str:
    """Write ``lines`` chunk by chunk (``chunk`` in 0..n-1) and after each one run
    ``build(stream of lines)`` to completion with ``sink(df, writer)``.

    ``sink`` receives the streaming DataFrame and returns a started query.
    Returns the work folder (input, checkpoint, output)."""
    work = work_dir(spark, name)
    keyed = lines.withColumn("_chunk", chunk)
    for i in range(n_chunks):
        write_chunk(keyed.filter(F.col("_chunk") == i), f"{work}/input/c{i:03d}")
        stream = stream_lines(spark, f"{work}/input/*")
        q = sink(build(stream), work)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return work


def parquet_sink(df: DataFrame, work: str):
    return (df.writeStream.format("parquet").option("path", f"{work}/out")
            .option("checkpointLocation", f"{work}/ckpt").outputMode("append")
            .trigger(availableNow=True).start())


def batch_sink(fn: Callable, mode: str = "update"):
    """foreachBatch sink builder: ``fn(batch_df, batch_id, work)``."""
    def start(df: DataFrame, work: str):
        return (df.writeStream.foreachBatch(lambda b, i: fn(b, i, work))
                .option("checkpointLocation", f"{work}/ckpt").outputMode(mode)
                .trigger(availableNow=True).start())
    return start


def run_chunks_multi(spark: SparkSession, sources: dict, chunk: Callable[[DataFrame], Column], n_chunks: int,
                     build: Callable[[dict], DataFrame], sink: Callable, name: str) -> str:
    """Like ``run_chunks`` for several source kinds, each with its own input folder
    (``<work>/input/<kind>/cNNN``); ``build`` gets ``{kind: folder glob}``."""
    work = work_dir(spark, name)
    keyed = {k: df.withColumn("_chunk", chunk(df)) for k, df in sources.items()}
    for i in range(n_chunks):
        for k, df in keyed.items():
            write_chunk(df.filter(F.col("_chunk") == i), f"{work}/input/{k}/c{i:03d}")
        q = sink(build({k: f"{work}/input/{k}/*" for k in sources}), work)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return work


def run_table(spark: SparkSession, table: DataFrame, build: Callable[[DataFrame], DataFrame], name: str) -> str:
    """Stream a table's rows (written as files first, as another query's sink leaves them) through ``build``."""
    work = work_dir(spark, name)
    table.write.parquet(f"{work}/input")
    q = parquet_sink(build(spark.readStream.schema(table.schema).parquet(f"{work}/input")), work)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return work
