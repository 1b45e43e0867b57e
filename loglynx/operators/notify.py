"""Notification outbox (F5, V9, A16): which alerts notify, and with what text.

Delivery (desktop / mail) is outside Spark; the outbox table is what a
delivery worker reads.  In streaming it is appended per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import severity_level

# ---------------------------------------------------------------------------
# Urgency per severity and the icon names.
# ---------------------------------------------------------------------------
URGENCY = {"LOW": "low", "MEDIUM": "normal", "HIGH": "normal", "CRITICAL": "critical"}
ICON_WARNING = "dialog-warning"
ICON_INFO = "dialog-information"
DEFAULT_MIN_SEVERITY = "HIGH"
TITLE_TEXT = "[%s] %s — %s"
BODY_RULE, BODY_IP, BODY_DETAIL, BODY_NO_IP = "Rule   : ", "\nIP     : ", "\nDetail : ", "None"
# ---------------------------------------------------------------------------


def min_level(min_severity: str) -> int:
    """Ordinal of the minimum; an unknown minimum means HIGH."""
    return {"LOW": 0, "MEDIUM": 1, "HIGH": 2, "CRITICAL": 3}.get(min_severity, 2)


def title_case(x: Column) -> Column:
    """'ssh_brute_force' -> 'Ssh Brute Force'."""
    return F.initcap(F.regexp_replace(x, "_", " "))


def outbox(alerts: DataFrame, min_severity: str = DEFAULT_MIN_SEVERITY, app_name: str = "loglynx",
           keep_skipped: bool = False) -> DataFrame:
    """Alerts at or above the minimum severity with title, body, urgency and icon.

    ``keep_skipped`` keeps the others too, flagged ``skipped``."""
    sev = F.col("severity")
    passes = severity_level(sev) >= F.lit(min_level(min_severity))
    urg = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in URGENCY.items() for x in kv]), sev),
                     F.lit("normal"))
    out = alerts.select(
        "alert_id", "created_at", "rule_name", "severity",
        F.format_string(TITLE_TEXT, sev, F.lit(app_name), title_case(F.col("rule_name"))).alias("title"),
        F.concat(F.lit(BODY_RULE), F.col("rule_name"), F.lit(BODY_IP),
                 F.coalesce(F.col("src_ip"), F.lit(BODY_NO_IP)), F.lit(BODY_DETAIL),
                 F.col("description")).alias("body"),
        urg.alias("urgency"),
        F.when(sev.isin("HIGH", "CRITICAL"), ICON_WARNING).otherwise(ICON_INFO).alias("icon"),
        (~passes).alias("skipped"),
    )
    return out if keep_skipped else out.filter(~F.col("skipped"))


def sent_count(box: DataFrame) -> DataFrame:
    """Notifications to send (not skipped)."""
    return box.agg(F.count_if(~F.col("skipped")).alias("n_sent"))
