"""Table schemas and closed enumerations of the event model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The closed sets of the normalised event model. They must stay
# exactly as written for results to agree with the system being replaced.
# ---------------------------------------------------------------------------
SOURCES = (
    "auth_log", "syslog", "apache", "nginx",
    "netwatch", "homeguard", "suricata", "manual",
)
EVENT_TYPES = (
    "auth_failure", "auth_success", "sudo_command", "user_created", "user_deleted",
    "port_scan", "dns_anomaly", "unknown_device", "bandwidth_spike",
    "web_scan", "web_error", "web_access",
    "service_start", "service_stop", "system_error",
    "unknown",
)
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")  # ordinals 0..3
# ---------------------------------------------------------------------------

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("source", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("message", T.StringType(), True),
    T.StructField("src_ip", T.StringType(), True),
    T.StructField("dst_ip", T.StringType(), True),
    T.StructField("user", T.StringType(), True),
    T.StructField("raw", T.StringType(), True),
    T.StructField("extra", T.StringType(), True),
])

EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

ALERT_SCHEMA = T.StructType([
    T.StructField("alert_id", T.LongType(), False),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("rule_name", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("description", T.StringType(), False),
    T.StructField("event_ids", T.ArrayType(T.LongType()), False),
    T.StructField("src_ip", T.StringType(), True),
    T.StructField("user", T.StringType(), True),
    T.StructField("group_by", T.StringType(), True),
    T.StructField("group_value", T.StringType(), True),
    T.StructField("event_count", T.LongType(), True),
    T.StructField("kind", T.StringType(), False),  # single | cross_source | chain
    T.StructField("rule_idx", T.IntegerType(), True),
])

ALERT_COLUMNS = [f.name for f in ALERT_SCHEMA.fields]

REPUTATION_SCHEMA = T.StructType([
    T.StructField("ip", T.StringType(), False),
    T.StructField("score", T.IntegerType(), False),
    T.StructField("alert_count", T.LongType(), False),
    T.StructField("first_seen", T.TimestampType(), True),
    T.StructField("last_seen", T.TimestampType(), True),
    T.StructField("tags", T.ArrayType(T.StringType()), False),
])

GEO_SCHEMA = T.StructType([
    T.StructField("ip", T.StringType(), False),
    T.StructField("country", T.StringType(), True),
    T.StructField("country_code", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("org", T.StringType(), True),
    T.StructField("is_private", T.BooleanType(), True),
    T.StructField("cached_at", T.TimestampType(), True),
])

ACK_SCHEMA = T.StructType([
    T.StructField("alert_id", T.LongType(), False),
    T.StructField("acked_at", T.TimestampType(), True),
])


def severity_level(sev: Column | str) -> Column:
    """Severity ordinal LOW 0 .. CRITICAL 3; anything else 0."""
    c = F.col(sev) if isinstance(sev, str) else sev
    return (
        F.when(c == "CRITICAL", 3)
        .when(c == "HIGH", 2)
        .when(c == "MEDIUM", 1)
        .otherwise(0)
    )


def iso_text(ts: Column | str) -> Column:
    """Render a timestamp the way the alert/event API shows it."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
