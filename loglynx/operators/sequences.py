"""Per-key event sequences (W4): run length of failures since the last success.

Running scans over buckets of measured size (see ``scans.dealt``): no window
holds more than one bucket of one key, whatever its rows an hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import auth_severity
from .scans import BUCKET, dealt, running


def consecutive_failures(events: DataFrame, key: str = "src_ip", failure: str = "auth_failure",
                         success: str = "auth_success", bucket_rows: int | None = None) -> DataFrame:
    """Failure rows with ``consecutive`` (failures since the key's last success,
    this one included) and the auth severity that count implies.

    consecutive(t) = F(t) - F(last success before t), where F is the running
    failure count; F is a running sum and F(last success) a running max of F
    over success rows — both bucketed scans (``scans.running``), so a
    hot key is split over many tasks."""
    ev = events.filter(F.col("event_type").isin(failure, success) & F.col(key).isNotNull())
    fail = (F.col("event_type") == failure).cast("bigint")
    order = ["ts", "event_id"]
    ev = dealt(ev, [key], order, bucket_rows)
    ev = running(ev, [key], "ts", order, fail, "_f", "sum", True)
    ev = running(ev, [key], "ts", order, F.when(F.col("event_type") == success, F.col("_f")), "_m", "max", False, empty=0)
    ev = ev.withColumn("consecutive", (F.col("_f") - F.col("_m")).cast("bigint")).drop("_f", "_m", BUCKET)
    return ev.filter(F.col("event_type") == failure).withColumn(
        "severity", auth_severity(F.lit(failure), F.col("consecutive")))
