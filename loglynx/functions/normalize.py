"""Column expressions for coercion, timestamps and classification.

Everything here is a pure ``Column -> Column`` function: it runs inside
whole-stage codegen, no Python on the row path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import EVENT_TYPES, SEVERITIES, SOURCES

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being matched)
# ---------------------------------------------------------------------------
# IDS numeric severity -> label; anything else MEDIUM
IDS_SEVERITY = {1: "HIGH", 2: "MEDIUM", 3: "LOW"}
# IDS signature category -> event type (after the signature keyword checks)
IDS_CATEGORY_TYPES = {
    "Attempted Information Leak": "port_scan",
    "Information Leak": "port_scan",
    "Network Scan": "port_scan",
    "Attempted Denial of Service": "system_error",
    "Denial of Service Attack": "system_error",
    "Web Application Attack": "web_scan",
    "Potentially Bad Traffic": "unknown",
    "Misc Attack": "unknown",
    "DNS": "dns_anomaly",
}
# network-monitor alert type -> event type; anything else unknown
NETWATCH_TYPES = {"PORT_SCAN": "port_scan", "DNS_ANOMALY": "dns_anomaly"}
# private address prefixes: 10/8, 172.16/12, 192.168/16, loopback, ::1
PRIVATE_PREFIXES = (
    "10.", "172.16.", "172.17.", "172.18.", "172.19.",
    "172.20.", "172.21.", "172.22.", "172.23.", "172.24.",
    "172.25.", "172.26.", "172.27.", "172.28.", "172.29.",
    "172.30.", "172.31.", "192.168.", "127.", "::1",
)
# ---------------------------------------------------------------------------


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Remove leading/trailing whitespace of any kind (Spark ``trim`` only strips spaces)."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def coerce_source(x: Column | str) -> Column:
    c = _c(x)
    return F.when(c.isin(*SOURCES), c).otherwise(F.lit("manual"))


def coerce_event_type(x: Column | str) -> Column:
    c = _c(x)
    return F.when(c.isin(*EVENT_TYPES), c).otherwise(F.lit("unknown"))


def coerce_severity(x: Column | str) -> Column:
    u = F.upper(_c(x))
    return F.when(u.isin(*SEVERITIES), u).otherwise(F.lit("LOW"))


def map_lookup(key: Column, mapping: dict, default: str | None) -> Column:
    """``mapping.get(key, default)`` as a map literal lookup."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    got = F.try_element_at(m, key)
    return got if default is None else F.coalesce(got, F.lit(default))


def parse_timestamp(
    raw: Column | str,
    default_year: int | Column | None = None,
    source_tz: str | None = None,
    ingest_ts: Column | None = None,
    fmt: str | None = None,
) -> Column:
    """Normalise the log timestamp shapes to a whole-second UTC timestamp.

    Tried in order (first success wins):
      syslog ``Mon d HH:MM:SS`` (no year: ``default_year`` is prepended,
      and if an ``ingest_ts`` is given a result more than a day after it is
      moved back one year), web ``dd/Mon/yyyy:HH:MM:SS +zzzz``,
      ``yyyy-MM-ddTHH:MM:SS``, ``yyyy-MM-dd HH:MM:SS``, ISO with fraction,
      ISO with fraction and offset, and finally Spark's own ISO reader.
    Unparseable text gives null; callers decide on a fallback column
    (never the wall clock).  Naive times are read in ``source_tz`` (UTC by
    default); times with an offset are converted to UTC.
    """
    s = strip(raw)
    collapsed = F.regexp_replace(s, r"\s+", " ")
    naive_fmts = [
        "yyyy-MM-dd'T'HH:mm:ss",
        "yyyy-MM-dd HH:mm:ss",
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "yyyy-MM-dd'T'HH:mm:ss.SSS",
    ]
    parts = []
    if fmt:  # an explicit format is tried first
        parts.append(("naive", F.try_to_timestamp(s, F.lit(fmt))))
    if default_year is not None:
        year = default_year if isinstance(default_year, Column) else F.lit(str(default_year))
        sys_ts = F.try_to_timestamp(
            F.concat(year.cast("string"), F.lit(" "), collapsed), F.lit("yyyy MMM d HH:mm:ss")
        )
        sys_ts = F.when(s.rlike(r"^[A-Za-z]{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}$"), sys_ts)
        if ingest_ts is not None:
            sys_ts = F.when(
                sys_ts > ingest_ts + F.expr("INTERVAL 1 DAY"), sys_ts - F.expr("INTERVAL 1 YEAR")
            ).otherwise(sys_ts)
        parts.append(("naive", sys_ts))
    parts.append(("aware", F.try_to_timestamp(s, F.lit("dd/MMM/yyyy:HH:mm:ss Z"))))
    for f in naive_fmts:
        parts.append(("naive", F.try_to_timestamp(s, F.lit(f))))
    parts.append(("aware", F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSZ"))))
    parts.append(("aware", F.try_to_timestamp(s)))
    cols = []
    for kind, c in parts:
        if kind == "naive" and source_tz and source_tz != "UTC":
            c = F.to_utc_timestamp(c, source_tz)
        cols.append(c)
    return F.date_trunc("second", F.coalesce(*cols))


def auth_severity(event_type: Column | str, consecutive_failures: Column | int = 1) -> Column:
    """Auth severity: success LOW, sudo MEDIUM, failures by run length (>=10 HIGH, >=3 MEDIUM)."""
    et = _c(event_type)
    n = consecutive_failures if isinstance(consecutive_failures, Column) else F.lit(consecutive_failures)
    return (
        F.when(et == "auth_success", "LOW")
        .when(et == "sudo_command", "MEDIUM")
        .when(n >= 10, "HIGH")
        .when(n >= 3, "MEDIUM")
        .otherwise("LOW")
    )


def web_severity(status: Column | str, count: Column | int = 1) -> Column:
    """Web severity by status code and repeat count."""
    st = _c(status)
    n = count if isinstance(count, Column) else F.lit(count)
    return (
        F.when(st == 200, "LOW")
        .when(st.isin(401, 403), F.when(n < 5, "MEDIUM").otherwise("HIGH"))
        .when((st == 404) & (n >= 20), "MEDIUM")
        .when(st >= 500, "MEDIUM")
        .otherwise("LOW")
    )


def ids_severity(sev: Column | str) -> Column:
    s = _c(sev)
    label = F.lit("MEDIUM")
    for number, name in IDS_SEVERITY.items():
        label = F.when(s == number, name).otherwise(label)
    return label


def ids_event_type(signature: Column | str, category: Column | str) -> Column:
    """Signature keywords first (SCAN > DNS > WEB/HTTP), then the category table."""
    sig = F.upper(_c(signature))
    return (
        F.when(sig.contains("SCAN"), "port_scan")
        .when(sig.contains("DNS"), "dns_anomaly")
        .when(sig.contains("WEB") | sig.contains("HTTP"), "web_scan")
        .otherwise(map_lookup(_c(category), IDS_CATEGORY_TYPES, "unknown"))
    )


def netwatch_event_type(raw_type: Column | str) -> Column:
    return map_lookup(F.upper(_c(raw_type)), NETWATCH_TYPES, "unknown")


_PRIVATE_RE = "^(" + "|".join(p.replace(".", r"\.") for p in PRIVATE_PREFIXES) + ")"


def is_private(ip: Column | str) -> Column:
    """Private / loopback address test by prefix; null or empty -> false."""
    c = _c(ip)
    return F.coalesce(c.rlike(_PRIVATE_RE), F.lit(False))


def score_label(score: Column | str, cuts: tuple[int, int, int] = (30, 60, 85)) -> Column:
    s = _c(score)
    return (
        F.when(s >= cuts[2], "KNOWN_BAD")
        .when(s >= cuts[1], "MALICIOUS")
        .when(s >= cuts[0], "SUSPICIOUS")
        .otherwise("CLEAN")
    )
