"""Following growing files: offsets, half lines, rotation, restarts, ranges."""

import os

import pytest
from pyspark.sql import functions as F

from loglynx.session import work_dir
from loglynx.sources import tail as TL
from loglynx.streaming import rules as SR


def put(path, text, mode="ab"):
    with open(path, mode) as f:
        f.write(text if isinstance(text, bytes) else text.encode())


class Follow:
    """A followed folder; each ``step`` is one availableNow run on the same checkpoint."""

    def __init__(self, spark, start="start", split=1 << 20):
        self.spark, self.start, self.split = spark, start, split
        self.work = work_dir(spark, "tail-test")
        self.logs = f"{self.work}/logs"
        os.makedirs(self.logs)
        self.seen = 0

    def step(self):
        lines = TL.tail_lines(self.spark, f"{self.logs}/app.log*", self.start, self.split)
        q = (lines.writeStream.format("parquet").option("path", f"{self.work}/out").option("checkpointLocation", f"{self.work}/ckpt")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        rows = [r.value for r in self.spark.read.schema(TL.SCHEMA).parquet(f"{self.work}/out").collect()] if os.path.exists(f"{self.work}/out") else []
        new, self.seen = len(rows) - self.seen, len(rows)
        return new, sorted(rows)


def test_appends_half_lines_and_rotation(spark):
    t = Follow(spark)
    log = f"{t.logs}/app.log"
    put(log, "a1\na2\nhal")
    assert t.step() == (2, ["a1", "a2"])
    put(log, "f\r\na4\n")
    assert t.step() == (2, ["a1", "a2", "a4", "half"])
    put(log, "before\nlast without end")
    os.rename(log, f"{t.logs}/app.log.1")  # rotated with unread lines
    put(log, "b1\n")
    assert t.step() == (3, ["a1", "a2", "a4", "b1", "before", "half", "last without end"])
    put(log, "b2\n")
    assert t.step()[0] == 1
    put(log, "c1\n", "wb")  # emptied and written anew
    assert t.step()[0] == 1 and t.step()[0] == 0
    put(log, b"\xff\xfe\n\n")
    assert t.step() == (2, sorted(["", "��", "a1", "a2", "a4", "b1", "b2", "before", "c1", "half", "last without end"]))


def test_start_at_the_end(spark):
    t = Follow(spark, "end")
    log = f"{t.logs}/app.log"
    put(log, "old\nhal")
    assert t.step()[0] == 0
    put(log, "f\nnew\n")
    assert t.step() == (2, ["half", "new"])
    put(f"{t.logs}/app.log.other", "x\n")  # a file that appears later is read whole
    assert t.step()[0] == 1


@pytest.mark.parametrize("split", [13, 64, 1 << 20])
def test_ranges_and_places(spark, split):
    work = work_dir(spark, "tail-ranges")
    text = "".join(f"line {i} " + "x" * (i % 23) + "\n" for i in range(16)) + "\n\nü" + "y" * 90 + "\nend"
    put(f"{work}/a.log", text)
    put(f"{work}/empty.log", "")
    put(f"{work}/.hidden", "no\n")
    rows = TL.placed_lines(spark, f"{work}/*", split).orderBy("line_at").collect()
    raw = text.encode()
    want, at = [], 0
    for line in raw.split(b"\n"):
        want.append((at, line.decode()))
        at += len(line) + 1
    assert [(r.line_at, r.value) for r in rows] == want
    assert TL.placed_lines(spark, f"{work}/none/*").count() == 0


def test_one_running_query(spark):
    """The periodic loop: a query that runs on while its file grows."""
    t = Follow(spark)
    got = []
    put(f"{t.logs}/app.log", "0\n")
    q = SR.run_continuous(TL.tail_lines(spark, f"{t.logs}/*", "start").select(F.col("value").cast("int").alias("n")),
                          lambda b, i: got.append(sorted(r.n for r in b.collect())), f"{t.work}/ckpt", trigger_secs=0)
    try:
        for i in range(1, 4):
            q.processAllAvailable()
            put(f"{t.logs}/app.log", f"{i}\n")
        q.processAllAvailable()
    finally:
        q.stop()
    assert [n for b in got for n in b] == [0, 1, 2, 3] and len([b for b in got if b]) >= 2


def test_equal_lines_are_events_of_their_own(spark):
    import gzip

    from loglynx.sources import logs as L

    work = work_dir(spark, "tail-ids")
    line = "Mar  4 09:00:00 host sshd[1]: Failed password for root from 1.2.3.4 port 22 ssh2\n"
    put(f"{work}/auth.log", line * 3)
    with gzip.open(f"{work}/auth.log.2.gz", "wt") as f:
        f.write(line * 2)
    opts = L.ParseOptions(default_year=2026)
    read = lambda **kw: L.ingest(spark, {"auth": f"{work}/*"}, opts, **kw).select("event_id").collect()
    first, again = read(), read()
    assert sorted(first) == sorted(again) and len(first) == 5 and len(set(first)) == 5
    assert len(set(read(places=False))) == 2


def test_growing_log_files(spark):
    """The query's files: lines without an address are spread, an address stays in one file, files only grow."""
    from loglynx.plans import stream_queries as Q

    at = lambda day, i: f"2024-01-{day:02d} 00:{i // 60 % 60:02d}:{i % 60:02d}"
    made = [(at(2 + 8 * (i % 2), i), f"{i:04d} sudo: u : COMMAND=/usr/bin/id" if i % 3 else f"{i:04d} Failed password for u from 10.0.0.{i % 5} port 1") for i in range(1200)]
    made.append((None, "0000 no time"))
    lines = spark.createDataFrame(made, "ts string, value string").withColumn("ts", F.col("ts").cast("timestamp"))
    lines = lines.withColumn("chunk", Q.chunk_of(F.col("ts"))).withColumn("log", Q._log_of(F.col("value"), 6))
    assert Q._measured(lines) == (1201, "86400 seconds")
    folder = f"{work_dir(spark, 'grow-test')}/logs"
    read = lambda: {f: open(f"{folder}/{f}").read() for f in os.listdir(folder)}
    Q._grow_logs(lines, folder, 0)
    first = read()
    Q._grow_logs(lines, folder, 3)
    last = read()
    assert len(last) == 6 and all(last[f].startswith(text) for f, text in first.items())
    assert sum(t.count("\n") for t in first.values()) == 600
    assert sorted(line for t in last.values() for line in t.splitlines()) == sorted(v for _, v in made)
    when = {v: t or "9" for t, v in made}
    for t in last.values():
        assert t.count("sudo") < 400  # of 800: not all in one file
        assert t.splitlines() == sorted(t.splitlines(), key=lambda v: (when[v], v))
    for i in range(5):
        assert sum(f"from 10.0.0.{i} " in t for t in last.values()) == 1


def test_watermark_covers_a_chunk(spark):
    """A file that shows up after another with the same week loses no line to the watermark."""
    from loglynx.plans import stream_queries as Q
    from loglynx.sources import logs as L

    work = work_dir(spark, "late-test")
    os.makedirs(f"{work}/logs")
    line = lambda day, i, ip: f"Jan {day:2d} 00:00:{i:02d} node1 sshd[{i}]: Failed password for u from {ip} port 40000 ssh2\n"
    rows = spark.createDataFrame([("2024-01-01 00:00:00", 0), ("2024-01-07 00:00:02", 0)], "ts string, chunk int").withColumn("ts", F.col("ts").cast("timestamp"))
    n, delay = Q._measured(rows)
    assert (n, delay) == (2, f"{6 * 86400 + 3} seconds")
    events = L.parse_auth(TL.tail_lines(spark, f"{work}/logs/*.log", start="start"), Q.OPTS)
    q = SR.run_continuous(SR.exact_rule_alerts(events, Q.BRUTE_ONLY, watermark=delay),
                          lambda b, i: b.write.mode("overwrite").parquet(f"{work}/out/batch={i}"), f"{work}/ckpt", trigger_secs=0)
    try:
        for name, text in (("a", "".join(line(d, i, "10.0.0.1") for d in (1, 7) for i in range(3))), ("b", "".join(line(1, i, "10.0.0.2") for i in range(3)))):
            put(f"{work}/logs/{name}.log", text)
            q.processAllAvailable()
    finally:
        q.stop()
    assert sorted((r.key, r.window_count) for r in spark.read.parquet(f"{work}/out").collect()) == [("10.0.0.1", 3), ("10.0.0.1", 3), ("10.0.0.2", 3)]
