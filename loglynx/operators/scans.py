"""Running sums / maxima per key, split by time so a hot key is not one task.

A running aggregate over a key's rows in time order is decomposed into
(a) the running aggregate inside each (key, time bucket) — a window whose
partition is one bucket of one key — and (b) the aggregate of all earlier
buckets of the key, taken from per-bucket totals (one row per bucket, so
that window is small whatever the key's volume).  Both sum and max
decompose this way; the result is exact.

Buckets are hours, or (``dealt``) ranges of the rows in order that hold about
the same number of rows each, however many a key has in an hour or a second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BUCKET = "_bucket"
BUCKET_ROWS = 1_000_000


def dealt(df: DataFrame, keys: list[str], order_cols: list, rows: int | None = None) -> DataFrame:
    """``df`` with a column ``_bucket``: the rows in order of key and ``order_cols``, cut into ranges of about
    ``rows`` rows (bounds from a sample of the rows).  The buckets are kept with the rows in the shared
    checkpoint folder, as both sides of a scan must see the same ones."""
    n = max(1, -(-df.count() // (rows or BUCKET_ROWS)))
    return materialize(df.repartitionByRange(n, *keys, *order_cols).withColumn(BUCKET, F.spark_partition_id()))


def running(df: DataFrame, keys: list[str], ts_col: str, order_cols: list, value: Column, out: str,
            how: str = "sum", inclusive: bool = True, bucket_secs: int = 3600, empty=0) -> DataFrame:
    """``out`` = sum/max of ``value`` over the key's rows ordered by ``order_cols``
    up to this row (``inclusive``) or strictly before it; ``empty`` when none.
    Buckets are those of ``dealt`` if the rows have them."""
    agg = F.sum if how == "sum" else F.max
    b = F.col(BUCKET) if BUCKET in df.columns else F.floor(F.unix_seconds(F.col(ts_col)) / bucket_secs)
    d = df.withColumn("_v", value).withColumn("_b", b)
    w_in = Window.partitionBy(*keys, "_b").orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    d = d.withColumn("_in", agg("_v").over(w_in))
    tot = d.groupBy(*keys, "_b").agg(agg("_v").alias("_t"))
    w_b = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*keys, "_b", agg("_t").over(w_b).alias("_before"))
    d = d.join(tot, [*keys, "_b"], "left")
    if how == "sum":
        val = F.coalesce(F.col("_before"), F.lit(0)) + F.coalesce(F.col("_in"), F.lit(0))
        val = F.when(F.col("_before").isNull() & F.col("_in").isNull(), F.lit(empty)).otherwise(val)
    else:
        val = F.coalesce(F.greatest(F.col("_before"), F.col("_in")), F.lit(empty))
    return d.withColumn(out, val).drop("_v", "_b", "_in", "_before")
