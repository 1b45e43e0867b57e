"""Extractors and normalisation: line -> expected row (our own fixture lines)."""

import json

from pyspark.sql import functions as F

from loglynx.functions import normalize as N
from loglynx.sources import logs as L

from .helpers import lines_df

OPTS = L.ParseOptions(default_year=2026)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_auth_failure_invalid_user(spark):
    line = "Mar  4 09:10:11 node1 sshd[77]: Failed password for invalid user guest from 198.51.100.7 port 40022 ssh2"
    r = one(L.parse_auth(lines_df(spark, [line]), OPTS))
    assert (r.source, r.event_type, r.severity) == ("auth_log", "auth_failure", "LOW")
    assert (r.user, r.src_ip) == ("guest", "198.51.100.7")
    assert r.message == "Failed login for user 'guest' from 198.51.100.7"
    assert r.ts.isoformat() == "2026-03-04T09:10:11"


def test_auth_success_and_sudo(spark):
    lines = ["Mar  4 09:10:15 node1 sshd[78]: Accepted publickey for ana from 10.1.0.8 port 40100 ssh2",
             "Mar 14 09:11:00 node1 sudo: ana : TTY=pts/1 ; PWD=/srv ; USER=root ; COMMAND=/usr/bin/id -u"]
    got = {r.event_type: r for r in L.parse_auth(lines_df(spark, lines), OPTS).collect()}
    assert got["auth_success"].severity == "LOW" and got["auth_success"].user == "ana"
    s = got["sudo_command"]
    assert s.severity == "MEDIUM" and s.src_ip is None and s.user == "ana"
    assert json.loads(s.extra) == {"command": "/usr/bin/id -u"}
    assert s.message == "User 'ana' ran sudo command: /usr/bin/id -u"


def test_user_admin_trailing_comma(spark):
    lines = ["Mar 14 09:12:00 node1 useradd[90]: new user: name=temp1, UID=1200, GID=1200",
             "Mar 14 09:13:00 node1 userdel[91]: delete user 'temp1'"]
    got = {r.event_type: r for r in L.parse_auth(lines_df(spark, lines), OPTS).collect()}
    assert got["user_created"].user == "temp1" and got["user_created"].severity == "MEDIUM"
    assert got["user_deleted"].user == "temp1" and got["user_deleted"].severity == "HIGH"


def test_rejects(spark):
    assert L.parse_auth(lines_df(spark, ["", "   ", "hello", "Mar 14 09:13:00 node1 cron[1]: ok"]), OPTS).count() == 0
    assert L.parse_syslog(lines_df(spark, ["hello"]), OPTS).count() == 0
    assert L.parse_web(lines_df(spark, ["hello"]), "nginx", OPTS).count() == 0


def test_syslog_kinds(spark):
    lines = [
        "Mar 14 09:14:00 node1 systemd[1]: Started Cron Daemon.",
        "Mar 14 09:15:00 node1 systemd[1]: Failed to start Cache Server.",
        "Mar 14 09:15:30 node1 systemd[1]: Stopped Cache Server.",
        "Mar 14 09:16:00 node1 kernel: [9.1] Out of memory: Kill process 321 (java) score 900",
        "Mar 14 09:17:00 node1 kernel: [9.2] segfault at 10 ip 00 sp 00 error 6",
        "Mar 14 09:18:00 node1 kernel: [9.3] Buffer I/O error on device sdb2, logical block 7",
        "Mar 14 09:19:00 node1 pam_unix(sshd:auth)[12]: authentication failure; rhost=10.1.0.9 user=ana",
    ]
    got = sorted((r.event_type, r.severity, r.message, r.user)
                 for r in L.parse_syslog(lines_df(spark, lines), OPTS).collect())
    assert got == sorted([
        ("service_start", "LOW", "Service started: Cron Daemon", None),
        ("service_stop", "HIGH", "Service failed to start: Cache Server", None),
        ("service_stop", "LOW", "Service stopped: Cache Server", None),
        ("system_error", "HIGH", "OOM killer invoked — killed process: java", None),
        ("system_error", "MEDIUM", "Kernel segfault detected", None),
        ("system_error", "HIGH", "Disk I/O error detected", None),
        ("auth_failure", "MEDIUM", "PAM authentication failure", None),
    ])
    fixed = L.parse_syslog(lines_df(spark, lines[-1:]), L.ParseOptions(default_year=2026, extract_pam_user=True))
    assert one(fixed).user == "ana"


def _web(ip, status, i):
    return f'{ip} - - [14/Mar/2026:09:20:{i % 60:02d} +0000] "GET /a{i} HTTP/1.1" {status} 0 "-" "probe/2"'


def test_web_scan_relabel_per_file(spark):
    scan = [_web("198.51.100.7", 404, i) for i in range(22)] + [_web("198.51.100.7", 401, 99),
                                                                  _web("198.51.100.7", 500, 98)]
    calm = [_web("10.1.0.8", 200, 1), _web("10.1.0.8", 404, 2)]
    df = L.parse_web(lines_df(spark, scan + calm, "nginx.log"), "nginx")
    got = {(r.src_ip, r.event_type) for r in df.collect()}
    assert ("198.51.100.7", "web_scan") in got and ("198.51.100.7", "web_error") not in got
    assert ("10.1.0.8", "web_access") in got and ("10.1.0.8", "web_error") in got
    s = df.filter(F.col("event_type") == "web_scan")
    assert s.count() == 24  # the 401 and 500 rows of the scanner are relabelled too
    assert all(r.severity == "HIGH" and r.message.startswith("[WEB SCAN] ") for r in s.collect())
    # the count is per file: split the same lines over two files -> below threshold
    two = lines_df(spark, scan[:11], "a.log").unionByName(lines_df(spark, scan[11:22], "b.log"))
    assert L.parse_web(two, "apache").filter(F.col("event_type") == "web_scan").count() == 0


def test_web_fields(spark):
    line = '198.51.100.7 - bob [14/Mar/2026:10:20:00 +0100] "POST /login HTTP/1.1" 401 12 "-" "x"'
    r = one(L.parse_web(lines_df(spark, [line]), "apache"))
    assert (r.source, r.event_type, r.severity, r.user) == ("apache", "web_error", "MEDIUM", "bob")
    assert r.ts.isoformat() == "2026-03-14T09:20:00"  # offset converted to UTC
    assert r.message == "POST /login → 401 from 198.51.100.7"
    assert json.loads(r.extra) == {"method": "POST", "path": "/login", "status": 401}


def test_ids_lines(spark):
    alert = {"timestamp": "2026-06-30T20:43:00.000000+0000", "event_type": "alert", "src_ip": "203.0.113.5",
             "src_port": 5555, "dest_ip": "10.0.0.1", "dest_port": 22, "proto": "TCP",
             "alert": {"signature": "ET SCAN Potential SSH Scan", "category": "Attempted Information Leak",
                       "severity": 1, "signature_id": 2001219}}
    flow = {"event_type": "flow", "src_ip": "1.2.3.4"}
    no_alert = {"timestamp": "2026-06-30T20:44:00", "event_type": "alert", "src_ip": "203.0.113.6"}
    lines = [json.dumps(alert), json.dumps(flow), "{bad json", "", json.dumps(no_alert)]
    got = {r.src_ip: r for r in L.parse_ids(lines_df(spark, lines), OPTS).collect()}
    assert set(got) == {"203.0.113.5", "203.0.113.6"}
    a = got["203.0.113.5"]
    assert (a.event_type, a.severity, a.dst_ip) == ("port_scan", "HIGH", "10.0.0.1")
    assert a.ts.isoformat() == "2026-06-30T20:43:00"
    assert json.loads(a.extra)["sid"] == 2001219
    d = got["203.0.113.6"]  # null alert object: defaults, no abort
    assert (d.event_type, d.severity, d.message) == ("unknown", "MEDIUM", "[Suricata] Unknown Suricata alert")


def test_ids_type_mapping(spark):
    df = spark.createDataFrame([("ET DNS x", ""), ("ET WEB_SERVER y", ""), ("foo", "Network Scan"),
                                ("foo", "Denial of Service Attack"), ("foo", "nope"), ("http thing", "")],
                               "sig string, cat string")
    got = [r[0] for r in df.select(N.ids_event_type(F.col("sig"), F.col("cat"))).collect()]
    assert got == ["dns_anomaly", "web_scan", "port_scan", "system_error", "unknown", "web_scan"]


def test_json_files_both_shapes(spark, tmpdir_path):
    recs = [{"timestamp": "2026-06-30T14:23:01", "type": "PORT_SCAN", "severity": "HIGH", "src_ip": "192.168.1.50",
             "details": "scan"},
            {"timestamp": "2026-06-30 14:24:01", "type": "weird", "src_ip": "192.168.1.51"}]
    p1, p2, p3 = (f"{tmpdir_path}/{n}.json" for n in ("list", "obj", "empty"))
    open(p1, "w").write(json.dumps(recs))
    open(p2, "w").write(json.dumps({"alerts": recs}))
    open(p3, "w").write(json.dumps({"alerts": []}))
    for p in (p1, p2):
        got = sorted((r.event_type, r.severity, r.message) for r in L.read_json_alerts(spark, p, "netwatch").collect())
        assert got == [("port_scan", "HIGH", "scan"), ("unknown", "MEDIUM", L.NETWATCH_DEFAULT_DETAILS + "WEIRD")]
    assert L.read_json_alerts(spark, p3, "netwatch").count() == 0
    hg = f"{tmpdir_path}/hg.json"
    open(hg, "w").write(json.dumps([{"timestamp": "2026-06-30T14:23:01", "mac": "aa:bb", "ip": "192.168.1.9",
                                     "alert": "UNKNOWN_DEVICE"}]))
    r = one(L.read_json_alerts(spark, hg, "homeguard"))
    assert (r.event_type, r.severity) == ("unknown_device", "HIGH")
    assert r.message == "Unknown device detected — MAC: aa:bb | Vendor: Unknown | IP: 192.168.1.9"
    try:
        L.read_json_alerts(spark, hg, "other")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_coercion(spark):
    df = spark.createDataFrame([("bad_source", "bogus", "EXTREME"), ("nginx", "web_scan", "high")], "s string, t string, v string")
    got = df.select(N.coerce_source("s"), N.coerce_event_type("t"), N.coerce_severity("v")).collect()
    assert [tuple(r) for r in got] == [("manual", "unknown", "LOW"), ("nginx", "web_scan", "HIGH")]


def test_timestamps(spark):
    raw = ["Jun 30 14:23:01", "30/Jun/2026:14:23:01 +0000", "2026-06-30T14:23:01", "2026-06-30 14:23:01",
           "2026-06-30T14:23:01.123456", "2026-06-30T16:23:01.5+0200", "Feb 29 10:00:00", "garbage"]
    df = spark.createDataFrame([(x,) for x in raw], "r string")
    got = [r[0] for r in df.select(N.parse_timestamp(F.col("r"), 2024)).collect()]
    exp = ["2024-06-30T14:23:01", "2026-06-30T14:23:01", "2026-06-30T14:23:01", "2026-06-30T14:23:01",
           "2026-06-30T14:23:01", None, "2024-02-29T10:00:00", None]
    assert [g.isoformat() if g else None for g in got][:5] == exp[:5]
    assert got[6].isoformat() == exp[6] and got[7] is None
    # December stamp read in January rolls back a year when the ingest time is given
    df2 = spark.createDataFrame([("Dec 31 23:59:59",)], "r string")
    r = df2.select(N.parse_timestamp(F.col("r"), 2027, ingest_ts=F.lit("2027-01-02 00:00:00").cast("timestamp"))).first()[0]
    assert r.isoformat() == "2026-12-31T23:59:59"


def test_fallback_timestamp(spark):
    line = "Xyz 99 99:99:99 node1 sshd[77]: Failed password for bob from 1.2.3.4 port 1 ssh2"
    r = one(L.parse_auth(lines_df(spark, [line]), L.ParseOptions(default_year=2026, ingest_ts="2026-01-01 00:00:00")))
    assert r.ts_status == "fallback" and r.ts.isoformat() == "2026-01-01T00:00:00"  # explicit column, no clock
    r = one(L.parse_auth(lines_df(spark, [line]), OPTS))
    assert r.ts_status == "unparsed" and r.ts is None
    ids = json.dumps({"timestamp": "nonsense", "event_type": "alert", "src_ip": "1.2.3.4"})
    r = one(L.parse_ids(lines_df(spark, [ids]), L.ParseOptions(ingest_ts="2026-01-01 00:00:00")))
    assert r.ts_status == "fallback" and r.ts.isoformat() == "2026-01-01T00:00:00"


def test_private_and_labels(spark):
    ips = ["192.168.1.1", "10.0.0.1", "172.16.0.1", "127.0.0.1", "8.8.8.8", "1.1.1.1", "172.32.0.1", None]
    df = spark.createDataFrame([(x,) for x in ips], "ip string")
    assert [r[0] for r in df.select(N.is_private("ip")).collect()] == [True, True, True, True, False, False, False, False]
    sc = spark.createDataFrame([(x,) for x in (0, 29, 30, 60, 85, 100)], "s int")
    assert [r[0] for r in sc.select(N.score_label("s")).collect()] == [
        "CLEAN", "CLEAN", "SUSPICIOUS", "MALICIOUS", "KNOWN_BAD", "KNOWN_BAD"]


def test_severity_inference(spark):
    df = spark.createDataFrame([(200, 1), (401, 1), (403, 5), (404, 1), (404, 20), (503, 1), (302, 1)], "s int, n int")
    got = [r[0] for r in df.select(N.web_severity(F.col("s"), F.col("n"))).collect()]
    assert got == ["LOW", "MEDIUM", "HIGH", "LOW", "MEDIUM", "MEDIUM", "LOW"]
    a = spark.createDataFrame([("auth_failure", 1), ("auth_failure", 3), ("auth_failure", 10), ("auth_success", 50),
                               ("sudo_command", 1)], "t string, n int")
    assert [r[0] for r in a.select(N.auth_severity(F.col("t"), F.col("n"))).collect()] == [
        "LOW", "MEDIUM", "HIGH", "LOW", "MEDIUM"]


def test_explicit_format_first(spark):
    df = spark.createDataFrame([("30.06.2026 14:23:01",)], "r string")
    r = df.select(N.parse_timestamp(F.col("r"), fmt="dd.MM.yyyy HH:mm:ss")).first()[0]
    assert r.isoformat() == "2026-06-30T14:23:01"


def test_single_pass_groups_keep_special_characters(spark):
    line = '203.0.113.9 - - [14/Mar/2026:09:20:00 +0000] "GET /a$1\\b?x=$2 HTTP/1.1" 404 0 "-" "x"'
    r = one(L.parse_web(lines_df(spark, [line]), "nginx"))
    assert json.loads(r.extra)["path"] == "/a$1\\b?x=$2" and r.user is None
    sudo = "Mar 14 09:11:00 node1 sudo: ana : TTY=pts/1 ; USER=root ; COMMAND=/bin/echo $HOME \\n"
    s = one(L.parse_auth(lines_df(spark, [sudo]), OPTS))
    assert json.loads(s.extra) == {"command": "/bin/echo $HOME \\n"}
