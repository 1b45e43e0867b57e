"""Log sources: line tables in, normalised event tables out.

Every parser takes a DataFrame with ``file_path`` and ``value`` (one row per
line, as ``spark.read.text`` gives it, or as a stream gives it) and returns
the normalised event table.  Parsing is regex / JSON column expressions, so
it runs in the scan stage with no shuffle; only the web-scan relabel needs
one aggregation per (file, ip).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalize import (
    auth_severity,
    coerce_event_type,
    coerce_severity,
    coerce_source,
    ids_event_type,
    ids_severity,
    netwatch_event_type,
    parse_timestamp,
    strip,
    web_severity,
)
from .jsonfiles import SPLIT, json_records
from .tail import placed_lines

# ---------------------------------------------------------------------------
# Line patterns and message texts.  These must stay as
# written for parsed rows to equal the system being replaced.  The first
# group of every syslog-style pattern is the timestamp.
# ---------------------------------------------------------------------------
TS = r"(\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})"
HOST = r"\S+"
AUTH_PATTERNS = {
    "auth_failure": rf"^{TS}\s+{HOST}\s+\S+:\s+Failed\s+\w+\s+for\s+(?:invalid user\s+)?(\S+)\s+from\s+(\S+)",
    "auth_success": rf"^{TS}\s+{HOST}\s+\S+:\s+Accepted\s+\w+\s+for\s+(\S+)\s+from\s+(\S+)",
    "sudo_command": rf"^{TS}\s+{HOST}\s+sudo:\s+(\S+)\s+:.*?COMMAND=(.*?)$",
    "user_created": rf"^{TS}\s+{HOST}\s+\S+:\s+new user:\s+name=(\S+)",
    "user_deleted": rf"^{TS}\s+{HOST}\s+\S+:\s+delete user\s+'(\S+)'",
}
SYSLOG_PATTERNS = {
    "service_start": rf"^{TS}\s+{HOST}\s+systemd\[.*?\]:\s+Started (.+?)\.",
    "service_stop": rf"^{TS}\s+{HOST}\s+systemd\[.*?\]:\s+(Stopped|Failed to start|Stopping) (.+?)\.",
    "oom": rf"^{TS}\s+{HOST}\s+kernel:.*Out of memory.*process\s+\d+\s+\((.+?)\)",
    "segfault": rf"^{TS}\s+{HOST}\s+kernel:.*segfault at",
    "disk_error": rf"^{TS}\s+{HOST}\s+kernel:.*(?:I/O error|Buffer I/O error|disk error)",
    "pam_failure": rf"^{TS}\s+{HOST}\s+\S*pam\S*\[.*?\]:\s+.*(?:authentication failure|AUTH_ERR).*(?:user=(\S+))?",
}
PAM_USER = r"user=(\S+)"
# combined access log: ip ident user [ts] "method path proto" status size
WEB_PATTERN = (
    r'^(\S+)\s+\S+\s+(\S+)\s+\[([^\]]+)\]\s+"(\S+)\s+(\S+)\s+\S+"\s+(\d{3})\s+(\S+)'
)
WEB_SCAN_THRESHOLD = 20
IDS_DEFAULT_SIGNATURE = "Unknown Suricata alert"
IDS_MESSAGE_PREFIX = "[Suricata] "
WEB_SCAN_PREFIX = "[WEB SCAN] "
NETWATCH_DEFAULT_DETAILS = "NetWatch alert: "
AUTH_FAILURE_TEXT = "Failed login for user '%s' from %s"
AUTH_SUCCESS_TEXT = "Successful login for user '%s' from %s"
SUDO_TEXT = "User '%s' ran sudo command: %s"
USER_CREATED_TEXT = "New user created: '%s'"
USER_DELETED_TEXT = "User deleted: '%s'"
SERVICE_STARTED_TEXT = "Service started: "
OOM_TEXT = "OOM killer invoked — killed process: "
SEGFAULT_TEXT = "Kernel segfault detected"
DISK_TEXT = "Disk I/O error detected"
PAM_TEXT = "PAM authentication failure"
PAM_USER_TEXT = " for user "
WEB_TEXT = "%s %s → %d from %s"
UNKNOWN_DEVICE_TEXT = "Unknown device detected — MAC: %s | Vendor: %s | IP: %s"
# ---------------------------------------------------------------------------

IDS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("src_port", T.LongType()),
    T.StructField("dest_ip", T.StringType()),
    T.StructField("dest_port", T.LongType()),
    T.StructField("proto", T.StringType()),
    T.StructField("alert", T.StructType([
        T.StructField("action", T.StringType()),
        T.StructField("gid", T.LongType()),
        T.StructField("signature_id", T.LongType()),
        T.StructField("rev", T.LongType()),
        T.StructField("signature", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("severity", T.LongType()),
    ])),
])

NETWATCH_RECORD = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("details", T.StringType()),
])

HOMEGUARD_RECORD = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("mac", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("vendor", T.StringType()),
    T.StructField("alert", T.StringType()),
])

_JSON_OPTS = {"ignoreNullFields": "false"}


class ParseOptions:
    """Per-ingest settings (all optional).

    default_year: year for syslog-style stamps without one.
    ingest_ts:    column/literal used when a stamp cannot be parsed, and to
                  roll year-less stamps that land in the future back a year.
    source_tz:    zone of naive stamps (default UTC).
    extract_pam_user: capture ``user=`` of PAM failures (off = parity).
    web_scan_threshold: 404s per (file, ip) that turn web_error into web_scan.
    """

    def __init__(self, default_year=None, ingest_ts=None, source_tz=None,
                 extract_pam_user=False, web_scan_threshold=WEB_SCAN_THRESHOLD):
        self.default_year = default_year
        self.ingest_ts = ingest_ts
        self.source_tz = source_tz
        self.extract_pam_user = extract_pam_user
        self.web_scan_threshold = web_scan_threshold

    def need_year(self, source: str) -> None:
        """Stamps of syslog-style lines have no year."""
        if self.default_year is None and self.ingest_ts is None:
            raise ValueError(f"{source} stamps have no year: give default_year or ingest_ts")

    def ts(self, raw: Column) -> Column:
        ingest = self.ingest_ts
        if ingest is not None and not isinstance(ingest, Column):
            ingest = F.lit(ingest).cast("timestamp")
        return parse_timestamp(raw, self.default_year, self.source_tz, ingest)


def read_lines(spark: SparkSession, paths, stream: bool = False, **opts) -> DataFrame:
    """Text scan: one row per line with the file it came from."""
    reader = spark.readStream if stream else spark.read
    for k, v in opts.items():
        reader = reader.option(k, v)
    if isinstance(paths, str):
        paths = [paths]
    if stream:  # a streaming reader takes one path: one stream each, unioned
        df = reduce(lambda a, b: a.unionByName(b), [_lines_of(reader.text(p)) for p in paths])
    else:
        df = _lines_of(reader.text(list(paths)))
    return df


def _place(df: DataFrame) -> list[str]:
    """Where a row comes from: its file, and where lines were read with their places (``tail.placed_lines``) the byte."""
    return ["file_path", *(["line_at"] if "line_at" in df.columns else [])]


def _lines_of(df: DataFrame) -> DataFrame:
    return df.select(F.col("_metadata.file_path").alias("file_path"), F.col("value"))


def finish_events(df: DataFrame, opts: ParseOptions | None = None) -> DataFrame:
    """Validated factory (coercion of source / type / severity, id, fallback time).

    Expects columns ts, source, event_type, severity, message, src_ip, dst_ip,
    user, raw, extra, file_path.  ``event_id`` is a deterministic hash of
    file, line and, if there is a column ``line_at``, the line's place in the file:
    re-reading a file gives the same ids, and equal lines have ids of their own.
    """
    opts = opts or ParseOptions()
    fallback = opts.ingest_ts
    if fallback is not None and not isinstance(fallback, Column):
        fallback = F.lit(fallback).cast("timestamp")
    ts = F.col("ts")
    status = F.when(ts.isNotNull(), "parsed").otherwise("fallback" if fallback is not None else "unparsed")
    if fallback is not None:
        ts = F.coalesce(ts, F.date_trunc("second", fallback))
    return df.select(
        F.xxhash64(*_place(df), F.col("raw")).alias("event_id"),
        ts.alias("ts"),
        coerce_source(F.col("source")).alias("source"),
        coerce_event_type(F.col("event_type")).alias("event_type"),
        coerce_severity(F.col("severity")).alias("severity"),
        F.col("message"),
        F.col("src_ip"),
        F.col("dst_ip"),
        F.col("user"),
        F.col("raw"),
        F.coalesce(F.col("extra"), F.lit("{}")).alias("extra"),
        F.col("file_path"),
        status.alias("ts_status"),
    )


def _x(line: Column, pattern: str, idx: int) -> Column:
    return F.regexp_extract(line, pattern, idx)


# Java's ``.`` and ``$`` also stop at U+0085, U+2028 and U+2029; with UNIX_LINES only \n
# ends a line, so such characters are ordinary ones, for detection and extraction alike
_UNIX_LINES = "(?d)"
_SEP, _ESC = "\u0001", "\u0002"


def _matches(line: Column, pattern: str) -> Column:
    return line.rlike(_UNIX_LINES + pattern)


def _groups(line: Column, pattern: str, n: int) -> Column:
    """Groups 1..n of an anchored pattern in ONE regex pass: the matched line is
    rewritten to the groups joined by a control character, then split.  A line
    that holds that character itself has it escaped first and restored in each
    field.  Only for lines known to match ``pattern``; fields are taken with
    ``_field``."""
    repl = _SEP.join(f"${i}" for i in range(1, n + 1))

    def cut(x: Column) -> Column:
        return F.split(F.regexp_replace(x, _UNIX_LINES + pattern + "(?s:.*)$", repl), _SEP)

    def restore(x: Column) -> Column:
        return F.replace(F.replace(x, F.lit(_ESC + "a"), F.lit(_SEP)), F.lit(_ESC + "b"), F.lit(_ESC))

    escaped = F.replace(F.replace(line, F.lit(_ESC), F.lit(_ESC + "b")), F.lit(_SEP), F.lit(_ESC + "a"))
    odd = line.contains(_SEP) | line.contains(_ESC)
    return F.when(odd, F.transform(cut(escaped), restore)).otherwise(cut(line))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` plus columns that are computed once per row.  Later filters on what is made of them
    (a rule's type or key, say) would otherwise be pushed below and repeat the whole extraction in
    every predicate; a generator of one row keeps them above."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _field(g: Column, i: int) -> Column:
    """Group i + 1 of ``_groups``; null if there is none."""
    return F.try_element_at(g, F.lit(i + 1))


def _kind(line: Column, patterns: dict) -> Column:
    expr = None
    for name, pat in patterns.items():
        hit = _matches(line, pat)
        expr = F.when(hit, name) if expr is None else expr.when(hit, name)
    return expr


def parse_auth(lines: DataFrame, opts: ParseOptions | None = None) -> DataFrame:
    """Auth log lines -> auth_failure / auth_success / sudo_command / user_created / user_deleted."""
    opts = opts or ParseOptions()
    opts.need_year("auth")
    P = AUTH_PATTERNS
    df = lines.select(*_place(lines), strip(F.col("value")).alias("line"))
    df = _once(df, kind=_kind(F.col("line"), P)).filter(F.col("kind").isNotNull())
    line, kind = F.col("line"), F.col("kind")
    # one regex pass per line: the detected kind's pattern rewrites the line to
    # its groups (ts, user[, ip | command])
    groups = None
    for name, pat in P.items():
        n = 3 if name in ("auth_failure", "auth_success", "sudo_command") else 2
        g = _groups(line, pat, n)
        groups = F.when(kind == name, g) if groups is None else groups.when(kind == name, g)
    df = _once(df, g=groups)
    g = F.col("g")
    user = F.when(kind == "user_created", F.regexp_replace(_field(g, 1), ",$", "")).otherwise(_field(g, 1))  # "name=x," -> x
    ip = F.when(kind.isin("auth_failure", "auth_success"), _field(g, 2))
    command = F.when(kind == "sudo_command", strip(_field(g, 2)))
    df = df.select(*_place(df), "line", "kind", user.alias("user"), ip.alias("src_ip"),
                   command.alias("command"), _field(g, 0).alias("ts_raw"))
    u, ipc, cmd = F.col("user"), F.col("src_ip"), F.col("command")
    message = (
        F.when(kind == "auth_failure", F.format_string(AUTH_FAILURE_TEXT, u, ipc))
        .when(kind == "auth_success", F.format_string(AUTH_SUCCESS_TEXT, u, ipc))
        .when(kind == "sudo_command", F.format_string(SUDO_TEXT, u, cmd))
        .when(kind == "user_created", F.format_string(USER_CREATED_TEXT, u))
        .otherwise(F.format_string(USER_DELETED_TEXT, u))
    )
    severity = (
        F.when(kind == "user_created", "MEDIUM")
        .when(kind == "user_deleted", "HIGH")
        .otherwise(auth_severity(kind))
    )
    out = df.select(
        opts.ts(F.col("ts_raw")).alias("ts"),
        F.lit("auth_log").alias("source"),
        kind.alias("event_type"),
        severity.alias("severity"),
        message.alias("message"),
        ipc.alias("src_ip"),
        F.lit(None).cast("string").alias("dst_ip"),
        u.alias("user"),
        line.alias("raw"),
        F.when(kind == "sudo_command", F.to_json(F.struct(cmd.alias("command")), _JSON_OPTS)).alias("extra"),
        *_place(df),
    )
    return finish_events(out, opts)


def parse_syslog(lines: DataFrame, opts: ParseOptions | None = None) -> DataFrame:
    """System log lines -> service_start / service_stop / system_error / auth_failure (PAM)."""
    opts = opts or ParseOptions()
    opts.need_year("syslog")
    P = SYSLOG_PATTERNS
    df = lines.select(*_place(lines), strip(F.col("value")).alias("line"))
    df = _once(df, kind=_kind(F.col("line"), P)).filter(F.col("kind").isNotNull())
    line, kind = F.col("line"), F.col("kind")
    # one regex pass per line for the kind's groups (ts first)
    n_groups = {"service_start": 2, "service_stop": 3, "oom": 2, "segfault": 1, "disk_error": 1, "pam_failure": 2}
    groups = None
    for name, pat in P.items():
        g = _groups(line, pat, n_groups[name])
        groups = F.when(kind == name, g) if groups is None else groups.when(kind == name, g)
    df = _once(df, g=groups)
    g = F.col("g")
    service = F.when(kind == "service_start", _field(g, 1)).when(kind == "service_stop", _field(g, 2))
    action = F.when(kind == "service_stop", _field(g, 1))
    process = F.when(kind == "oom", _field(g, 1))
    pam_user = F.lit(None).cast("string")
    if opts.extract_pam_user:
        pam_user = F.nullif(_x(line, PAM_USER, 1), F.lit(""))
    user = F.when(kind == "pam_failure", pam_user)
    df = df.select(*_place(df), "line", "kind", service.alias("service"), action.alias("action"),
                   process.alias("process"), user.alias("user"), _field(g, 0).alias("ts_raw"),
                   _x(line, "^" + TS + r"\s+(\S+)", 2).alias("host"))
    svc, act, proc, u, host = F.col("service"), F.col("action"), F.col("process"), F.col("user"), F.col("host")
    event_type = (
        F.when(kind == "service_start", "service_start")
        .when(kind == "service_stop", "service_stop")
        .when(kind == "pam_failure", "auth_failure")
        .otherwise("system_error")
    )
    severity = (
        F.when(kind == "service_start", "LOW")
        .when(kind == "service_stop", F.when(act.contains("Failed"), "HIGH").otherwise("LOW"))
        .when(kind.isin("oom", "disk_error"), "HIGH")
        .otherwise("MEDIUM")
    )
    message = (
        F.when(kind == "service_start", F.concat(F.lit(SERVICE_STARTED_TEXT), svc))
        .when(kind == "service_stop", F.concat(F.lit("Service "), F.lower(act), F.lit(": "), svc))
        .when(kind == "oom", F.concat(F.lit(OOM_TEXT), proc))
        .when(kind == "segfault", F.lit(SEGFAULT_TEXT))
        .when(kind == "disk_error", F.lit(DISK_TEXT))
        .otherwise(F.concat(F.lit(PAM_TEXT),
                            F.coalesce(F.concat(F.lit(PAM_USER_TEXT), u), F.lit(""))))
    )
    # the host goes into extra so rules can key system events by host (syslog
    # lines carry no address)
    extra = (
        F.when(kind == "service_start", F.to_json(F.struct(host.alias("host"), svc.alias("service")), _JSON_OPTS))
        .when(kind == "service_stop", F.to_json(F.struct(host.alias("host"), svc.alias("service"),
                                                         act.alias("action")), _JSON_OPTS))
        .when(kind == "oom", F.to_json(F.struct(host.alias("host"), proc.alias("process")), _JSON_OPTS))
        .otherwise(F.to_json(F.struct(host.alias("host")), _JSON_OPTS))
    )
    out = df.select(
        opts.ts(F.col("ts_raw")).alias("ts"),
        F.lit("syslog").alias("source"),
        event_type.alias("event_type"),
        severity.alias("severity"),
        message.alias("message"),
        F.lit(None).cast("string").alias("src_ip"),
        F.lit(None).cast("string").alias("dst_ip"),
        u.alias("user"),
        line.alias("raw"),
        extra.alias("extra"),
        *_place(df),
    )
    return finish_events(out, opts)


def parse_web_lines(lines: DataFrame, source: str = "nginx", opts: ParseOptions | None = None) -> DataFrame:
    """Combined access log lines -> web_access / web_error rows plus ``status`` (no relabel)."""
    opts = opts or ParseOptions()
    line = F.col("line")
    df = lines.select(*_place(lines), strip(F.col("value")).alias("line")).filter(_matches(line, WEB_PATTERN))
    # one regex pass for all six fields (instead of one regexp_extract per field)
    g = _groups(line, WEB_PATTERN, 6)
    df = _once(df, g=g).select(
        *_place(df), "line",
        _field(F.col("g"), 0).alias("src_ip"),
        F.when(_field(F.col("g"), 1) != "-", _field(F.col("g"), 1)).alias("user"),
        _field(F.col("g"), 2).alias("ts_raw"),
        _field(F.col("g"), 3).alias("method"),
        _field(F.col("g"), 4).alias("path"),
        _field(F.col("g"), 5).try_cast("int").alias("status"),
    )
    st = F.col("status")
    return df.select(
        opts.ts(F.col("ts_raw")).alias("ts"),
        F.lit(source).alias("source"),
        F.when(st < 400, "web_access").otherwise("web_error").alias("event_type"),
        web_severity(st).alias("severity"),
        F.format_string(WEB_TEXT, F.col("method"), F.col("path"), st, F.col("src_ip")).alias("message"),
        F.col("src_ip"),
        F.lit(None).cast("string").alias("dst_ip"),
        F.col("user"),
        line.alias("raw"),
        F.to_json(F.struct("method", "path", "status"), _JSON_OPTS).alias("extra"),
        *_place(df),
        st,
    )


def web_scan_relabel(web: DataFrame, threshold: int = WEB_SCAN_THRESHOLD,
                     scope: tuple[str, ...] = ("file_path", "src_ip")) -> DataFrame:
    """IPs with >= threshold 404s in one file: their web_error rows become web_scan / HIGH.

    The 404 count is a partial aggregation per (file, ip) (map-side combine,
    so a hot IP costs one row per map task); the scanner set is joined back
    on the same keys.  AQE turns that join into a broadcast when the
    scanner set is small at run time and splits skewed partitions when not.
    """
    scanners = (
        web.filter(F.col("status") == 404)
        .groupBy(*scope).agg(F.count(F.lit(1)).alias("n404"))
        .filter(F.col("n404") >= threshold)
        .select(*scope, F.lit(True).alias("is_scanner"))
    )
    j = web.join(scanners, list(scope), "left")
    hit = F.coalesce(F.col("is_scanner"), F.lit(False)) & (F.col("event_type") == "web_error")
    cols = []
    for c in web.columns:
        if c == "event_type":
            cols.append(F.when(hit, "web_scan").otherwise(F.col(c)).alias(c))
        elif c == "severity":
            cols.append(F.when(hit, "HIGH").otherwise(F.col(c)).alias(c))
        elif c == "message":
            cols.append(F.when(hit, F.concat(F.lit(WEB_SCAN_PREFIX), F.col(c))).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def parse_web(lines: DataFrame, source: str = "nginx", opts: ParseOptions | None = None,
              relabel: bool = True) -> DataFrame:
    """Access-log scan for the apache and nginx sources (same format)."""
    opts = opts or ParseOptions()
    web = parse_web_lines(lines, source, opts)
    if relabel:
        web = web_scan_relabel(web, opts.web_scan_threshold)
    return finish_events(web.drop("status"), opts)


def parse_ids(lines: DataFrame, opts: ParseOptions | None = None) -> DataFrame:
    """IDS EVE NDJSON lines -> events; only ``event_type == 'alert'`` records."""
    opts = opts or ParseOptions()
    df = lines.select(*_place(lines), strip(F.col("value")).alias("line"))
    df = _once(df, o=F.from_json(F.col("line"), IDS_SCHEMA))
    df = df.filter(F.col("o.event_type") == "alert")
    o = F.col("o")
    sig = F.coalesce(o["alert"]["signature"], F.lit(IDS_DEFAULT_SIGNATURE))
    cat = F.coalesce(o["alert"]["category"], F.lit(""))
    sev = F.coalesce(o["alert"]["severity"], F.lit(2))
    out = df.select(
        opts.ts(F.coalesce(o["timestamp"], F.lit(""))).alias("ts"),
        F.lit("suricata").alias("source"),
        ids_event_type(sig, cat).alias("event_type"),
        ids_severity(sev).alias("severity"),
        F.concat(F.lit(IDS_MESSAGE_PREFIX), sig).alias("message"),
        o["src_ip"].alias("src_ip"),
        o["dest_ip"].alias("dst_ip"),
        F.lit(None).cast("string").alias("user"),
        F.col("line").alias("raw"),
        F.to_json(F.struct(
            sig.alias("signature"), cat.alias("category"),
            o["alert"]["signature_id"].alias("sid"), o["proto"].alias("proto"),
            o["src_port"].alias("src_port"), o["dest_port"].alias("dest_port"),
        ), _JSON_OPTS).alias("extra"),
        *_place(df),
    )
    return finish_events(out, opts)


def netwatch_records(recs: DataFrame, opts: ParseOptions | None = None) -> DataFrame:
    """Network-monitor records (column ``r`` of NETWATCH_RECORD, the whole record's text ``rec``, file_path)
    -> events; raw and extra keep the whole record."""
    opts = opts or ParseOptions()
    r = F.col("r")
    raw_type = F.upper(F.coalesce(r["type"], F.lit("UNKNOWN")))
    out = recs.select(
        opts.ts(F.coalesce(r["timestamp"], F.lit(""))).alias("ts"),
        F.lit("netwatch").alias("source"),
        netwatch_event_type(raw_type).alias("event_type"),
        F.coalesce(r["severity"], F.lit("MEDIUM")).alias("severity"),
        F.coalesce(r["details"], F.concat(F.lit(NETWATCH_DEFAULT_DETAILS), raw_type)).alias("message"),
        r["src_ip"].alias("src_ip"),
        F.lit(None).cast("string").alias("dst_ip"),
        F.lit(None).cast("string").alias("user"),
        F.col("rec").alias("raw"),
        F.col("rec").alias("extra"),
        *_place(recs),
    )
    return finish_events(out, opts)


def homeguard_records(recs: DataFrame, opts: ParseOptions | None = None) -> DataFrame:
    """Device-monitor records (column ``r`` of HOMEGUARD_RECORD, the record's text ``rec``) -> unknown_device / HIGH events."""
    opts = opts or ParseOptions()
    r = F.col("r")
    mac = F.coalesce(r["mac"], F.lit("unknown"))
    vendor = F.coalesce(r["vendor"], F.lit("Unknown"))
    out = recs.select(
        opts.ts(F.coalesce(r["timestamp"], F.lit(""))).alias("ts"),
        F.lit("homeguard").alias("source"),
        F.lit("unknown_device").alias("event_type"),
        F.lit("HIGH").alias("severity"),
        F.format_string(UNKNOWN_DEVICE_TEXT, mac, vendor, F.coalesce(r["ip"], F.lit("None"))).alias("message"),
        r["ip"].alias("src_ip"),
        F.lit(None).cast("string").alias("dst_ip"),
        F.lit(None).cast("string").alias("user"),
        F.col("rec").alias("raw"),
        F.to_json(F.struct(mac.alias("mac"), vendor.alias("vendor")), _JSON_OPTS).alias("extra"),
        *_place(recs),
    )
    return finish_events(out, opts)


JSON_RECORD_SCHEMAS = {"netwatch": NETWATCH_RECORD, "homeguard": HOMEGUARD_RECORD}
JSON_RECORD_MAPPERS = {"netwatch": netwatch_records, "homeguard": homeguard_records}


def _is_record(text: Column) -> Column:
    """Is the text a JSON object?"""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))


def _typed_records(recs: DataFrame, source: str, opts: ParseOptions | None) -> DataFrame:
    """``recs`` (file_path, rec: a record's text) -> events of the records that are JSON objects."""
    good = recs.filter(_is_record(F.col("rec")))
    return JSON_RECORD_MAPPERS[source](_once(good, r=F.from_json("rec", JSON_RECORD_SCHEMAS[source])), opts)


def read_json_alerts(spark: SparkSession, paths, source: str, opts: ParseOptions | None = None, split_bytes: int = SPLIT) -> DataFrame:
    """JSON alert files: a top-level array of records or ``{"alerts": [...]}``.

    Unknown ``source`` raises ValueError; an object without ``alerts`` yields no
    rows, and records that are not objects yield no event (see ``rejects``).
    Files larger than ``split_bytes`` are read by several tasks (``jsonfiles``).
    """
    if source not in JSON_RECORD_SCHEMAS:
        raise ValueError(f"Unknown JSON source: {source}")
    return _typed_records(json_records(spark, paths, split_bytes), source, opts)


def json_lines_records(lines: DataFrame, source: str, opts: ParseOptions | None = None) -> DataFrame:
    """Same mappers over NDJSON lines (one record per line), for streams and bulk data."""
    if source not in JSON_RECORD_SCHEMAS:
        raise ValueError(f"Unknown JSON source: {source}")
    return _typed_records(lines.select(*_place(lines), strip(F.col("value")).alias("rec")), source, opts)


# Line-parser registry: source kind -> (lines DataFrame, options) -> events.
LINE_PARSERS = {
    "auth": parse_auth,
    "syslog": parse_syslog,
    "apache": lambda df, o=None: parse_web(df, "apache", o),
    "nginx": lambda df, o=None: parse_web(df, "nginx", o),
    "suricata": parse_ids,
    "netwatch": lambda df, o=None: json_lines_records(df, "netwatch", o),
    "homeguard": lambda df, o=None: json_lines_records(df, "homeguard", o),
}


def rejects(kind: str, lines: DataFrame) -> DataFrame:
    """the lines (of any source kind) that give no event: kind, file_path, value, reason.

    ``no_pattern``: a text line that no pattern of its source matches; ``not_json``: a line
    of a JSON source that is no JSON object; ``not_an_alert``: a record of the intrusion
    detector of another type.  Blank lines are no records and are left out.
    """
    line = strip(F.col("value"))
    if kind in ("auth", "syslog"):
        reason = F.when(_kind(line, AUTH_PATTERNS if kind == "auth" else SYSLOG_PATTERNS).isNull(), "no_pattern")
    elif kind in ("apache", "nginx"):
        reason = F.when(~_matches(line, WEB_PATTERN), "no_pattern")
    elif kind == "suricata":
        of = F.get_json_object(line, "$.event_type")
        reason = F.when(~_is_record(line), "not_json").when(of.isNull() | (of != "alert"), "not_an_alert")
    elif kind in JSON_RECORD_SCHEMAS:
        reason = F.when(~_is_record(line), "not_json")
    else:
        raise ValueError(f"Unknown source kind: {kind}")
    return lines.filter(line != "").select(F.lit(kind).alias("kind"), "file_path", "value", reason.alias("reason")).filter(F.col("reason").isNotNull())


def parse_kind(kind: str, lines: DataFrame, opts: ParseOptions | None = None) -> DataFrame:
    if kind not in LINE_PARSERS:
        raise ValueError(f"Unknown source kind: {kind}")
    return LINE_PARSERS[kind](lines, opts)


def ingest(spark: SparkSession, sources: dict, opts: ParseOptions | None = None, places: bool = True) -> DataFrame:
    """Multi-source batch ingest: ``{kind: paths}`` -> one normalised event table.

    ``places``: lines are read with their places, so equal lines of a file are events of
    their own; without, Spark's text reader is used and they share an id.
    Text kinds are read line by line; ``netwatch`` / ``homeguard`` paths are
    whole JSON files (array or ``{"alerts": [...]}``).
    """
    parts = []
    for kind, paths in sources.items():
        if not paths:
            continue
        if kind in JSON_RECORD_SCHEMAS:
            parts.append(read_json_alerts(spark, paths, kind, opts))
        else:
            parts.append(parse_kind(kind, placed_lines(spark, paths) if places else read_lines(spark, paths), opts))
    if not parts:
        raise ValueError("no sources given")
    return reduce(lambda a, b: a.unionByName(b), parts)


def ingest_counts(events: DataFrame) -> DataFrame:
    """Rows per (source, file) plus a total row (source/file null), in one pass over the events.
    A source or file that is null counts as such, and is not mistaken for the total."""
    per_file = events.groupBy("source", "file_path").agg(F.count(F.lit(1)).alias("n_events"))
    # per_file has a row per file: each gives itself and its share of the total
    both = per_file.select(F.explode(F.array(
        F.struct(F.lit(0).alias("total"), "source", "file_path", "n_events"),
        F.struct(F.lit(1).alias("total"), F.lit(None).cast("string").alias("source"),
                 F.lit(None).cast("string").alias("file_path"), F.col("n_events")))).alias("x")).select("x.*")
    none = events.sparkSession.range(1).select(  # no events: a total of 0
        F.lit(1).alias("total"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("file_path"),
        F.lit(0).cast("long").alias("n_events"))
    out = both.unionByName(none).groupBy("total", "source", "file_path").agg(F.sum("n_events").alias("n_events"))
    return out.select("source", "file_path", "n_events")


def number_occurrences(events: DataFrame) -> DataFrame:
    """``event_id`` made unique for equal lines of one file: the second and later occurrences get an id of
    their own (file, line, number).  Only lines that do repeat are numbered, so the table itself is not dealt
    anew unless the repeated ids are too many to broadcast by their measured size."""
    again = events.groupBy("event_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("event_id", F.lit(True).alias("_again"))
    j = events.join(again, "event_id", "left")
    single = j.filter(F.col("_again").isNull()).select(*events.columns)
    w = Window.partitionBy("event_id", "file_path", "raw").orderBy("ts")
    rest = j.filter(F.col("_again")).withColumn("_nth", F.row_number().over(w))
    own = F.when(F.col("_nth") == 1, F.col("event_id")).otherwise(F.xxhash64("file_path", "raw", "_nth"))
    return single.unionByName(rest.withColumn("event_id", own).select(*events.columns))
