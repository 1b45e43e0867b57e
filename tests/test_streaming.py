"""Structured Streaming: batch = stream, watermark drops (ST1-ST8)."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from loglynx.operators import correlate as C
from loglynx.session import work_dir
from loglynx.sources import logs as L
from loglynx.sources.catalogue import Catalogue
from loglynx.streaming import rules as SR
from loglynx.streaming import runner as RN


CAT = Catalogue.from_dict({"rules": [{"name": "bf", "description": "d", "severity": "HIGH", "window_secs": 60,
                                      "threshold": 3, "conditions": [{"event_type": "auth_failure",
                                                                      "source": "auth_log"}]}]})
OPTS = L.ParseOptions(default_year=2026)


def _line(t, ip):
    return (f"{t.strftime('%b')} {t.day:2d} {t.strftime('%H:%M:%S')} node1 sshd[1]: "
            f"Failed password for root from {ip} port 22 ssh2")


def _lines(spark):
    t0 = datetime(2026, 3, 4, 9, 0, 0)
    out = []
    for i in range(240):
        t = t0 + timedelta(seconds=7 * i)
        out.append((_line(t, "198.51.100.1" if i % 3 else "198.51.100.2"), t))
    return spark.createDataFrame([("auth.log", v, t) for v, t in out], "file_path string, value string, ts timestamp")


def test_stream_equals_batch(spark):
    lines = _lines(spark)
    batch = C.replay_fired(L.parse_auth(lines.select("file_path", "value"), OPTS), CAT)
    exp = sorted((r.key, r.sec, r.window_count) for r in batch.collect())
    chunk = F.floor((F.unix_seconds("ts") - F.lit(int(datetime(2026, 3, 4, 9).timestamp()))) / 600)

    def build(stream):
        return SR.exact_rule_alerts(L.parse_auth(stream, OPTS), CAT, watermark="10 minutes")
    work = RN.run_chunks(spark, lines, chunk.cast("int"), 3, build, RN.parquet_sink, "t-stream")
    got = sorted((r.key, r.sec, r.window_count) for r in spark.read.parquet(f"{work}/out").collect())
    assert got == exp and len(exp) > 5


def test_late_rows_dropped_and_counted(spark):
    work = work_dir(spark, "t-late")
    t0 = datetime(2026, 3, 4, 9, 0, 0)
    inp = f"{work}/in"
    os.makedirs(inp)
    with open(f"{inp}/a.log", "w") as f:
        f.write("\n".join(_line(t0 + timedelta(minutes=30, seconds=i), "1.2.3.4") for i in range(3)) + "\n")
    ev = L.parse_auth(SR.stream_lines(spark, inp), OPTS)
    q = (SR.exact_rule_alerts(ev, CAT, watermark="1 minute").writeStream.format("memory").queryName("late_t")
         .outputMode("append").option("checkpointLocation", f"{work}/ckpt").start())
    q.processAllAvailable()
    with open(f"{inp}/b.log", "w") as f:  # far behind the watermark
        f.write("\n".join(_line(t0 + timedelta(seconds=i), "1.2.3.4") for i in range(5)) + "\n")
    q.processAllAvailable()
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  if p.get("stateOperators"))
    q.stop()
    assert dropped == 5
    assert spark.sql("select * from late_t").count() == 1  # only the on-time burst fired


def test_sliding_counts_and_web_windows(spark):
    lines = _lines(spark)
    work = work_dir(spark, "t-slide")
    inp = f"{work}/in"
    lines.select("value").write.text(inp)

    def sink(b, i):
        b.write.mode("append").parquet(f"{work}/out")
    ev = L.parse_auth(SR.stream_lines(spark, inp), OPTS)
    q = (SR.sliding_counts(ev, CAT, 60, 30, watermark="1 minute").writeStream.foreachBatch(sink)
         .outputMode("update").option("checkpointLocation", f"{work}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(f"{work}/out").groupBy("key", "window_start").agg(F.max("n").alias("n"))
    assert out.count() > 0 and out.agg(F.min("n")).first()[0] >= 3


def test_multi_source_stream(spark):
    work = work_dir(spark, "t-multi")
    os.makedirs(f"{work}/auth")
    os.makedirs(f"{work}/nginx")
    with open(f"{work}/auth/a.log", "w") as f:
        f.write(_line(datetime(2026, 3, 4, 9), "1.2.3.4") + "\n")
    with open(f"{work}/nginx/n.log", "w") as f:
        f.write('5.6.7.8 - - [04/Mar/2026:09:00:00 +0000] "GET / HTTP/1.1" 404 1 "-" "x"\n')
    ev = SR.stream_events(spark, {"auth": f"{work}/auth", "nginx": f"{work}/nginx"}, OPTS)
    q = (ev.writeStream.format("memory").queryName("multi_t").option("checkpointLocation", f"{work}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.source, r.event_type) for r in spark.sql("select * from multi_t").collect())
    assert got == [("auth_log", "auth_failure"), ("nginx", "web_error")]


def test_event_time_order_equals_batch_out_of_order(spark):
    """Chunks arrive newest-first within the watermark delay: event-time order still
    gives the batch result; a final far-future row advances the watermark."""
    lines = _lines(spark)
    batch = C.replay_fired(L.parse_auth(lines.select("file_path", "value"), OPTS), CAT)
    exp = sorted((r.key, r.sec, r.window_count) for r in batch.collect())
    flush = spark.createDataFrame([("auth.log", _line(datetime(2026, 3, 5, 9), "9.9.9.9"), datetime(2026, 3, 5, 9))],
                                  "file_path string, value string, ts timestamp")
    base = int(datetime(2026, 3, 4, 9).timestamp())
    chunk = (F.lit(2) - F.floor((F.unix_seconds("ts") - F.lit(base)) / 600)).cast("int")  # reversed order
    data = lines.unionByName(flush)
    chunk = F.when(F.col("ts") >= F.lit("2026-03-05").cast("timestamp"), F.lit(3)).otherwise(chunk)

    def build(stream):
        return SR.exact_rule_alerts(L.parse_auth(stream, OPTS), CAT, watermark="2 hours", order="event_time")
    work = RN.run_chunks(spark, data, chunk, 4, build, RN.parquet_sink, "t-evt")
    got = sorted((r.key, r.sec, r.window_count) for r in spark.read.parquet(f"{work}/out").collect()
                 if r.key != "9.9.9.9")
    assert got == exp
