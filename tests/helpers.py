"""Small builders for hand-made fixtures."""

from datetime import datetime

from pyspark.sql import functions as F

from loglynx.schema import EVENT_SCHEMA


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


def events_df(spark, rows):
    """rows: dicts with ts (iso text), source, event_type and optional src_ip/user/severity."""
    out = []
    for i, r in enumerate(rows):
        out.append((r.get("event_id", i + 1), ts(r["ts"]), r["source"], r["event_type"],
                    r.get("severity", "LOW"), r.get("message", ""), r.get("src_ip"), None, r.get("user"),
                    None, "{}"))
    return spark.createDataFrame(out, EVENT_SCHEMA)


def lines_df(spark, lines, file_path="test.log"):
    return spark.createDataFrame([(file_path, x) for x in lines], "file_path string, value string")


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def lit_ts(s):
    return F.lit(s).cast("timestamp")
