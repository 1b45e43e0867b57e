"""JSON files of records, read in byte ranges.

A file is a list of records, or an object whose member ``alerts`` is one.  It is one JSON value,
but it need not be one task: files are cut into ranges, and a record is read by the task in whose
range it begins.

1. Every range of a file that has several is scanned twice at once, as if it began outside a
   string and as if it began inside one: what it does to the quotes and to the nesting, and
   where ``"alerts": [`` stands in it.  A range gives one small row.
2. The rows of a file, in order, tell how each of its ranges really begins.
3. Every range is read from there: elements of the list that are objects, to their last brace.

Files of one range are read in one pass, many to a task.  The ranges are dealt by a listing
(names and sizes), so nothing of a file goes through the driver.

Defined cases: elements that are no objects, and objects that are no JSON, are skipped by
whoever parses the texts; a file whose quotes or brackets do not close, or that is neither
shape, has no rows; of two members ``alerts`` the last counts; bytes that are not UTF-8 become
U+FFFD; a byte order mark is ignored; compressed files are unpacked by one task each.
"""

from __future__ import annotations

import json
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tail import PACKED, _store

SPLIT = 32 << 20
BLOCK = 4 << 20
MAX_TASKS = 100_000
BLANK = b" \t\r\n\xef\xbb\xbf"  # white space and the byte order mark
RECORDS = "file_path string, line_at long, rec string"
KEY = re.compile(rb'(?<!\\)"alerts"[ \t\r\n]*:[ \t\r\n]*\[')
KEY_BEGUN = re.compile(rb'.?(?:"alerts"[ \t\r\n]*:?[ \t\r\n]*|"a?l?e?r?t?s?)\Z', re.S)

QUOTE, OPEN, CLOSE, BACKSLASH = 1, 2, 3, 4
KIND = np.zeros(256, np.uint8)
KIND[list(b'"')], KIND[list(b"{[")], KIND[list(b"}]")], KIND[list(b"\\")] = QUOTE, OPEN, CLOSE, BACKSLASH


def _open(uri: str):
    """A file with ``size()`` and ``read_at(n, at)``."""
    fs, path = _store(uri)
    if uri.endswith(PACKED):
        with fs.open_input_stream(path, compression="detect") as f:
            return pa.BufferReader(f.read())
    return fs.open_input_file(path)


def _marks(block: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """(places, kinds) of a block's brackets and of its quotes that no backslash escapes, and whether the next byte is escaped."""
    raw = np.frombuffer(block, np.uint8)
    kind = KIND[raw]
    at = np.flatnonzero(kind)
    kind = kind[at]
    slash = at[kind == BACKSLASH]
    at, kind = at[kind != BACKSLASH], kind[kind != BACKSLASH]
    if not len(slash):
        if escaped and len(at) and at[0] == 0 and kind[0] == QUOTE:
            at, kind = at[1:], kind[1:]
        return at, kind, escaped and not block
    first = np.concatenate([[True], np.diff(slash) != 1])
    begin = slash[np.maximum.accumulate(np.where(first, np.arange(len(slash)), 0))]  # of the run that a backslash is in
    length = slash - begin + 1 + (escaped & (begin == 0))
    i = np.searchsorted(slash, at) - 1
    odd = (i >= 0) & (slash[i] == at - 1) & (length[i] % 2 == 1)
    if escaped and slash[0] != 0:
        odd |= at == 0
    keep = ~(odd & (kind == QUOTE))
    return at[keep], kind[keep], bool(slash[-1] == len(raw) - 1 and length[-1] % 2 == 1)


def _depths(kind: np.ndarray, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(depth behind each mark, whether it is a bracket outside strings, state and depth behind all)."""
    string = (np.cumsum(kind == QUOTE) + inside) & 1
    real = (kind != QUOTE) & (string == 0)
    after = depth + np.cumsum(np.where(real, np.where(kind == OPEN, 1, -1), 0))
    return after, real, int(string[-1]) if len(kind) else inside, int(after[-1]) if len(kind) else depth


def _edge(f, at: int, size: int) -> int:
    """``at``, or the next place that no backslash precedes: a range never begins with an escaped byte."""
    while 0 < at < size:
        near = f.read_at(min(4096, size - at + 1), at - 1)
        rest = near.lstrip(b"\\")
        if rest:
            return min(size, at + len(near) - len(rest))
        at += len(near)
    return min(at, size)


def _before(f, at: int) -> bytes:
    """What stands before ``at``, back to the beginning of a member's name that may end there."""
    n = 64
    while True:
        got = f.read_at(min(n, at), at - min(n, at))
        if n >= at or len(got.rstrip(b" \t\r\n:")) >= 16:
            return got
        n *= 4


def summarise(f, begin: int, end: int) -> dict:
    """What a range does to a scan that is outside (0) or inside (1) a string where it begins: the state behind it, the change
    of depth, the lowest depth, and the last ``"alerts": [`` for each depth (its place, the lowest depth behind it)."""
    state, depth, low = [0, 1], [0, 0], [0, 0]
    lists: list[dict[int, list]] = [{}, {}]
    first, first_at, escaped, at = None, 0, False, begin
    kept = _before(f, begin)
    while at < end:
        block = f.read_at(min(BLOCK, end - at), at)
        if not block:
            break
        if first is None and (said := block.lstrip(BLANK)):
            first_at = at + len(block) - len(said)
            first = said[:1].decode("latin-1")
        places, kind, escaped = _marks(block, escaped)
        text = kept + block
        names = [m.end() - 1 - len(kept) for m in KEY.finditer(text) if m.end() > len(kept)]
        for s in (0, 1):
            after, real, inside, deep = _depths(kind, state[s], depth[s])
            lowest = int(after.min()) if len(after) else depth[s]
            for known in lists[s].values():
                known[1] = min(known[1], lowest)
            for place in names:
                i = int(np.searchsorted(places, place))
                if real[i]:
                    lists[s][int(after[i]) - 1] = [at + place, int(after[i:].min())]
            state[s], depth[s], low[s] = inside, deep, min(low[s], lowest)
        near = 4096
        while near < len(text) and not text[-near:].strip(b" \t\r\n:"):
            near *= 4
        tail = KEY_BEGUN.search(text[-near - 16:])
        kept = tail.group() if tail else text[-1:]
        at += len(block)
    return {"first": first, "first_at": first_at,
            "if": [{"state": state[s], "depth": depth[s], "low": low[s], "lists": [[d, *x] for d, x in lists[s].items()]} for s in (0, 1)]}


def entries(ranges: list[dict]) -> list[dict] | None:
    """How each range of a file begins, from the ranges' summaries in order: inside a string or not, depth, the depth of
    the list's elements, whether the list is open there, and where it begins.  None for a file that has no list."""
    head = next((r for r in ranges if r["first"]), None)  # the first range that is not blank
    if head is None or head["first"] not in ("[", "{"):
        return None
    level = 1 if head["first"] == "[" else 2
    start = head["first_at"] if level == 1 else -1
    inside = depth = 0
    opened = False
    out = []
    for r in ranges:
        got = r["if"][inside]
        out.append({"inside": inside, "depth": depth, "opened": opened, "level": level})
        opened = opened and depth + got["low"] >= level
        if level == 1 and r is head:
            opened = got["depth"] >= 1
        for before, place, lowest in got["lists"]:
            if level == 2 and depth + before == 1:
                start, opened = place, depth + lowest >= 2
                for x in out:
                    x["opened"] = False
        inside, depth = got["state"], depth + got["depth"]
    if inside or depth or start < 0:
        return None
    return [x | {"start": start} for x in out]


def elements(f, begin: int, end: int, size: int, inside: int, depth: int, opened: bool, level: int, start: int):
    """Batches of (place, bytes) of the list's objects that begin in the range, which is read as far as the last of them goes."""
    at, escaped = begin, False
    held, held_at = None, 0  # an object whose end was not yet seen
    while at < size and (held is not None or at < end and (opened or begin <= start < end)):
        block = f.read_at(min(BLOCK, size - at), at)
        if not block:
            return
        places, kind, escaped = _marks(block, escaped)
        after, real, inside, depth = _depths(kind, inside, depth)
        raw = np.frombuffer(block, np.uint8)[places]
        mine = real & ((places + at > start) if not opened else True)
        if not opened and start >= at + len(block):
            mine &= False
        over = np.flatnonzero(mine & (kind == CLOSE) & (after < level))
        stop = over[0] if len(over) else len(places)
        opened = opened or at <= start < at + len(block)
        mine[stop:] = False
        opens = places[mine & (raw == ord("{")) & (after == level + 1) & (places + at < end)]
        ends = places[mine & (raw == ord("}")) & (after == level)]
        out = []
        if held is not None:
            if not len(ends):
                held.append(block)
                at += len(block)
                continue
            out.append((held_at, b"".join([*held, block[: ends[0] + 1]])))
            held, ends = None, ends[1:]
        else:  # the end of an object that began in the range before
            ends = ends[np.searchsorted(ends, opens[0]):] if len(opens) else ends[:0]
        n = min(len(opens), len(ends))
        out += [(at + a, block[a:b + 1]) for a, b in zip(opens[:n].tolist(), ends[:n].tolist())]
        if len(opens) > n:
            held, held_at = [block[opens[n]:]], at + int(opens[n])
        if out:
            yield out
        at += len(block)
        if len(over):
            return


def _batch(uri: str, found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([uri] * len(found), pa.string()), pa.array([a for a, _ in found], pa.int64()),
                                       pa.array([b.decode("utf-8", "replace") for _, b in found], pa.string())], names=["file_path", "line_at", "rec"])


def _whole(batches):
    """Files of one range."""
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            with _open(uri) as f:
                size = f.size()
                how = entries([summarise(f, 0, size)])
                if how:
                    for found in elements(f, 0, size, size, **how[0]):
                        yield _batch(uri, found)


def _summaries(batches):
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            with _open(r["file"]) as f:
                begin, end = _edge(f, r["at"], r["size"]), _edge(f, r["until"], r["size"])
                rows.append(r | {"at": begin, "until": end, "summary": json.dumps(summarise(f, begin, end))})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("file", pa.string()), ("size", pa.int64()), ("at", pa.int64()), ("until", pa.int64()), ("summary", pa.string())]))


BEGUN = "file string, size long, at long, until long, inside int, depth long, opened boolean, level int, start long"


def _begun(table: pd.DataFrame) -> pd.DataFrame:
    """One file's ranges with how they begin; a range has a row of some hundred bytes here."""
    table = table.sort_values(["at", "until"])
    how = entries([json.loads(s) for s in table["summary"]])
    names = [x.split()[0] for x in BEGUN.split(", ")]
    if how is None:
        return pd.DataFrame(columns=names)
    return pd.concat([table.drop(columns="summary").reset_index(drop=True), pd.DataFrame(how)], axis=1)[names]


def _read(batches):
    for batch in batches:
        for r in batch.to_pylist():
            if r["at"] < r["until"]:
                uri = r.pop("file")
                with _open(uri) as f:
                    for found in elements(f, r.pop("at"), r.pop("until"), **r):
                        yield _batch(uri, found)


def json_records(spark: SparkSession, paths, split_bytes: int = SPLIT) -> DataFrame:
    """(file_path, line_at, rec): the text and the place of every object in the lists of JSON files."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    listed = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"))
    packed = F.lower("file").rlike("(" + "|".join(re.escape(x) for x in PACKED) + ")$")
    one = packed | (F.col("size") <= split_bytes)
    total = listed.agg(F.sum(F.when(one, F.greatest("size", F.lit(1 << 16)))).alias("small"), F.sum(F.when(~one, F.col("size"))).alias("large")).first()

    def tasks(size) -> int:
        return max(1, min(MAX_TASKS, math.ceil((size or 0) / split_bytes)))
    out = listed.where(one).select("file").repartition(tasks(total["small"])).mapInArrow(_whole, RECORDS)
    if total["large"]:
        n = tasks(total["large"])
        at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long")))
        cut = listed.where(~one).select("file", "size", at.alias("at")).withColumn("until", F.least(F.col("at") + split_bytes, "size"))
        seen = cut.repartition(n).mapInArrow(_summaries, "file string, size long, at long, until long, summary string")
        begun = seen.groupBy("file").applyInPandas(_begun, BEGUN)
        out = out.unionByName(begun.repartition(n).mapInArrow(_read, RECORDS))
    return out
