"""JSON files in ranges: every cut gives what a parse of the whole file gives."""

import bz2
import json
import random

import pyarrow as pa
import pytest

from loglynx.session import work_dir
from loglynx.sources import jsonfiles as J
from loglynx.sources import logs as L


def in_ranges(data: bytes, split: int):
    f, size = pa.BufferReader(data), len(data)
    cuts = [(J._edge(f, at, size), J._edge(f, min(at + split, size), size)) for at in range(0, size, split)]
    how = J.entries([J.summarise(f, a, b) for a, b in cuts])
    if how is None:
        return []
    found = [x for (a, b), h in zip(cuts, how) if a < b for some in J.elements(f, a, b, size, **h) for x in some]
    assert all(data[at:at + len(rec)] == rec for at, rec in found)
    return [json.loads(rec) for _, rec in sorted(found)]


def whole(data: bytes):
    try:
        v = json.loads(data.decode("utf-8-sig"))
    except ValueError:
        return []
    v = v.get("alerts") if isinstance(v, dict) else v
    return [x for x in v if isinstance(x, dict)] if isinstance(v, list) else []


def value(rnd, deep=0):
    kind = rnd.randrange(9 if deep < 3 else 6)
    if kind < 4:
        return "".join(rnd.choice(['{', '}', '[', ']', '"', "\\", "\\\\", "a", "é", ",", ":", '"alerts": [', " "]) for _ in range(rnd.randrange(8)))
    if kind < 6:
        return rnd.choice([None, True, 3, -1.5])
    if kind < 8:
        return {rnd.choice(["a", "alerts", "x\\", 'q"', "}"]): value(rnd, deep + 1) for _ in range(rnd.randrange(4))}
    return [value(rnd, deep + 1) for _ in range(rnd.randrange(4))]


FIXED = [b"", b" ", b"{}", b"[]", b"not json", b"[{}", b"[{}]]", b'[{"a": "}]', b' \n[{"a":1}, 2, [{"b":2}], {}]\n', b'{"alerts": 3}', b'"[{}]"',
         b'\xef\xbb\xbf[{"a": 1}]', b'{"alerts" \n :\t' + b" " * 9000 + b'[{"a": 1}], "other": [{"b": 1}]}', b'{"alerts": [{"a": 1}], "alerts": [{"b": 1}]}',
         b'{"x": {"alerts": [{"a": 1}]}, "alerts": []}', b'{"x\\"alerts": [{"a": 1}]}', b'{"x": "\\"alerts\\": [{}]"}', b'[{"a": "' + b"\\\\" * 40 + b'"}, {"b": "\\""}]']


@pytest.mark.parametrize("block", [5, 64, 1 << 20])
def test_any_cut_of_any_file(monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rnd = random.Random(block)
    files = list(FIXED)
    for _ in range(60):
        recs = [value(rnd) for _ in range(rnd.randrange(6))]
        other = {rnd.choice(["a", "b", "alerts2"]): value(rnd) for _ in range(2)}
        for v in (recs, {**other, "alerts": recs, "z": value(rnd)}):
            files.append(json.dumps(v, ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, 1])).encode())
    for data in files:
        for split in (1, 2, 3, 7, 50, 10_000):
            if block < split or len(data) < 2000 or split > 10:
                assert in_ranges(data, split) == whole(data), (data, split)


def test_files_in_spark(spark):
    root = work_dir(spark, "t-json-ranges")
    rnd = random.Random(3)
    recs = [{"type": "PORT_SCAN", "src_ip": f"1.1.{i}.1", "details": value(rnd), "n": 5} for i in range(200)] * 2
    for name, v in (("a", recs), ("b b", {"n": [{}], "alerts": recs}), ("c", recs[:3])):
        with open(f"{root}/{name}.json", "w") as f:
            json.dump(v, f)
    with open(f"{root}/d.json.bz2", "wb") as f:
        f.write(bz2.compress(json.dumps(recs).encode()))
    open(f"{root}/e.json", "w").close()
    want = sorted(json.dumps(r, sort_keys=True) for r in recs)
    for split in (1000, 1 << 20):
        df = J.json_records(spark, f"{root}/*", split)
        rows = df.collect()
        for name, n in (("/a.json", 400), ("/b%20b.json", 400), ("/c.json", 3), ("/d.json.bz2", 400)):
            mine = [r for r in rows if r.file_path.endswith(name)]
            assert len({r.line_at for r in mine}) == n
            assert n == 3 or sorted(json.dumps(json.loads(r.rec), sort_keys=True) for r in mine) == want
        assert len(rows) == 1203
    ev = L.read_json_alerts(spark, f"{root}/a.json", "netwatch", split_bytes=1000)
    assert ev.select("event_id").distinct().count() == 400  # equal records have ids of their own
