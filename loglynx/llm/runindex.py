"""Exact removal of long repeats with a run-length suffix index.

A byte goes if it lies in a ``length``-byte string that also starts anywhere else in the
corpus, in the same document or another.

Finding where to look.  Of every ``length``-byte string the smallest hash among its
``anchor``-byte substrings is an anchor; it depends on the string alone, so equal strings
share one at the same place.  An anchor seen at one place only proves that no string
around it repeats.  The others are taken with their context (all strings that may hold
them).  Equal contexts of an anchor form one class: a class with two members repeats
throughout, and only one member of a class is ever read again.

Run-length index.  The contexts of the anchors with several classes are dealt by anchor
and put together, whole anchors at a time, to texts of about ``INDEX_BYTES`` (each byte of
a document once).  Of each such text the run-compressed Burrows-Wheeler transform is
built, with the text positions sampled at both ends of every run.  Matching statistics
are streamed from the samples: the longest match of a position with its neighbour in
suffix order is measured by comparison at run ends only, and is one less than its
predecessor's elsewhere.  Positions whose statistic reaches ``length`` repeat.

Scale.  The tables that are dealt hold anchors (one in about seventy bytes), not texts;
counting them needs a row for each and task.  Lists of repeated anchors, class members
and spans meet the texts by broadcast up to a measured number of rows and by shuffle
beyond.  An anchor with more than ``max_classes`` classes (a passage in very many
documents) has no index of bytes: its contexts are aligned at the anchor, so for each
offset the strings are told apart by the ranks of their left and right parts in sorted
order.  Beyond ``max_aligned`` classes nothing is gathered: the strings are hashed one
by one and counted.  All three ways give the same result.

Defined cases: null texts are empty; texts under ``length`` bytes keep everything; rows
with equal texts (of ``length`` bytes or more) lose all of it, whether their ids differ
or not; runs of one byte are strings like others; texts are read whole; an empty table
gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglynx.llm import text as T
from loglynx.llm.common import cut, join_hot

LENGTH, ANCHOR = 400, 256
INDEX_BYTES = 3 << 19  # text of one index
MAX_CLASSES = 4096
MAX_ALIGNED = 200_000
MAX_BROADCAST_ROWS = 1_000_000  # of anchors or spans
MAX_BROADCAST_MEMBERS = 100_000
SEPARATOR = 255  # in no UTF-8 text


# ---- anchors ----

def _slide(h: np.ndarray, width: int, f) -> np.ndarray:
    """f over every ``width`` consecutive values, by doubling."""
    out, have = h, 1
    while have < width:
        step = min(have, width - have)
        out = f(out[:len(out) - step], out[step:])
        have += step
    return out


def substring_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k``-byte substring (k >= 8), by doubling."""
    n = len(raw) - 7
    h = T.mix(np.ndarray((n,), "<u8", np.ascontiguousarray(raw), strides=(1,)) * T._P1)
    have = 8
    while have < k:
        step = min(have, k - have)
        h = T.mix(h[:len(h) - step] * T._P2 + (h[step:] ^ T._P3))
        have += step
    return h


def anchors(raw: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the substrings that are the smallest of some ``length``-byte string."""
    if len(raw) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = substring_hashes(raw, k)
    width = length - k + 1
    low = _slide(h, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    at = np.flatnonzero(_slide(np.concatenate([edge, low, edge]), width, np.maximum) == h)
    return at, h[at]


def anchor_rows(texts: DataFrame, length: int, k: int) -> DataFrame:
    """``texts`` (key, text) -> h, cid (hash of the context and its extent), key, pos, lo, hi:
    strings that hold the anchor start at pos + lo ... pos + hi."""

    def run(batches):
        for batch in batches:
            for part in T.chunks(batch, "text"):
                raw, offs = T.flat(part.column(1))
                buf, cols, of = memoryview(raw.tobytes()), [], []
                for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
                    at, h = anchors(raw[a:b], length, k)
                    if not len(at):
                        continue
                    lo = np.maximum(at - (length - k), 0)
                    hi = np.minimum(at, b - a - length)
                    cid = np.fromiter((xxhash.xxh3_64_intdigest(buf[a + x:a + y + length], seed=(p - x)) for x, y, p in
                                       zip(lo.tolist(), hi.tolist(), at.tolist())), np.uint64, len(at))
                    cols.append((h, cid, at, lo - at, hi - at))
                    of.append(np.full(len(at), i))
                if cols:
                    h, cid, at, lo, hi = (np.concatenate(x) for x in zip(*cols))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(cid.view(np.int64)), part.column(0).take(pa.array(np.concatenate(of))),
                         pa.array(at), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                        names=["h", "cid", "key", "pos", "lo", "hi"])

    return texts.select("key", "text").mapInArrow(run, "h long, cid long, key binary, pos long, lo int, hi int")


# ---- the run-length index ----

def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling over the groups that are not yet apart."""
    n = len(t)
    if n == 0:
        return np.zeros(0, np.int64)
    first8 = np.ndarray((n,), ">u8", np.concatenate([t, np.zeros(8, np.uint8)]), strides=(1,)).astype(np.uint64)
    # the end of the text sorts before a zero byte: of equal words, the seven last suffixes go by their length
    sa = np.concatenate([np.arange(max(0, n - 7), n)[::-1], np.arange(max(0, n - 7))])
    sa = sa[np.argsort(first8[sa], kind="stable")]
    key, tail = first8[sa], np.minimum(n - sa, 8)
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (tail[1:] != tail[:-1])])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    k = 8
    alone = new & np.concatenate([new[1:], [True]])
    slots = np.flatnonzero(~alone)  # places in sa still tied
    while len(slots):
        s = sa[slots]
        after = s + k
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        group = rank[s]
        order = np.argsort(group * (n + 1) + second, kind="stable")
        s, group, second = s[order], group[order], second[order]
        sa[slots] = s
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        rank[s] = np.maximum.accumulate(np.where(new, slots, 0))
        slots = slots[~(new & np.concatenate([new[1:], [True]]))]
        k *= 2
    return sa


def common_prefixes(t8: np.ndarray, n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes i and j (t8: eight bytes from each place)."""
    out = np.zeros(len(i), np.int64)
    todo = np.arange(len(i))
    while len(todo):
        a, b = i[todo] + out[todo], j[todo] + out[todo]
        inside = (a < n) & (b < n)
        todo, a, b = todo[inside], a[inside], b[inside]
        diff = t8[a] ^ t8[b]
        same = diff == 0
        out[todo[~same]] += np.bitwise_count((diff[~same] & (~diff[~same] + np.uint64(1))) - np.uint64(1)) // 8
        out[todo[same]] += 8
        todo = todo[same]
    return np.minimum(out, np.minimum(n - i, n - j))


@dataclass
class RunIndex:
    """A run-compressed Burrows-Wheeler transform with the positions at run ends."""

    text: np.ndarray
    heads: np.ndarray    # the runs' bytes (256: the text's start)
    lengths: np.ndarray
    first: np.ndarray    # text position of each run's first suffix
    last: np.ndarray     # and of its last

    @classmethod
    def build(cls, t: np.ndarray) -> RunIndex:
        sa = suffix_array(t)
        bwt = np.where(sa > 0, t[sa - 1].astype(np.int16), 256)
        start = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]])) if len(bwt) else np.zeros(0, np.int64)
        end = np.concatenate([start[1:], [len(bwt)]]) - 1 if len(start) else start
        return cls(t, bwt[start], end - start + 1, sa[start], sa[end])

    def statistics(self) -> np.ndarray:
        """For every position the longest match that starts there and anywhere else."""
        n = len(self.text)
        if n == 0:
            return np.zeros(0, np.int64)
        t8 = np.ndarray((n,), "<u8", np.concatenate([self.text, np.zeros(8, np.uint8)]), strides=(1,))
        seam = common_prefixes(t8, n, self.first[1:], self.last[:-1])  # neighbours across each run border
        out = np.zeros(n, np.int64)
        for sampled, value in ((self.first, np.concatenate([[0], seam])), (self.last, np.concatenate([seam, [0]]))):
            known = np.full(n, -1, np.int64)
            known[sampled] = value
            source = np.maximum.accumulate(np.where(known >= 0, np.arange(n), 0))  # position 0 is always sampled
            out = np.maximum(out, known[source] - (np.arange(n) - source))
        return out


def marked(segments: list[np.ndarray], length: int) -> list[np.ndarray]:
    """For each segment, which positions start a ``length``-byte string that occurs twice or more in all."""
    sep = np.array([SEPARATOR], np.uint8)
    t = np.concatenate([x for s in segments for x in (s, sep)])
    long = RunIndex.build(t).statistics() >= length
    out, at = [], 0
    for s in segments:
        here = long[at:at + len(s)].copy()
        here[max(0, len(s) - length + 1):] = False
        out.append(here)
        at += len(s) + 1
    return out


def index_groups(rows: list[tuple], length: int) -> list[tuple]:
    """``rows`` (h, cid, key, pos, lo, hi, ctx) of whole anchors -> (h, cid, from, to) runs of starts, relative to the anchor."""
    by_key: dict[bytes, list] = {}
    for r in rows:
        by_key.setdefault(r[2], []).append(r)
    segments, where = [], []
    for own in by_key.values():  # each byte of a document once: overlapping contexts are merged
        own.sort(key=lambda r: r[3] + r[4])
        base, data, members = None, b"", []
        for r in own:
            start = r[3] + r[4]
            if base is not None and start <= base + len(data):
                data += r[6][max(0, base + len(data) - start):]
            else:
                if base is not None:
                    segments.append(np.frombuffer(data, np.uint8))
                    where.append((base, members))
                base, data, members = start, r[6], []
            members.append(r)
        segments.append(np.frombuffer(data, np.uint8))
        where.append((base, members))
    out = []
    for (base, members), hit in zip(where, marked(segments, length)):
        for h, cid, _, pos, lo, hi, _ in members:
            mine = hit[pos + lo - base:pos + hi - base + 1]
            edge = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
            out += [(h, cid, lo + int(a), lo + int(b) - 1) for a, b in zip(edge[::2], edge[1::2])]
    return out


MARKS = "h long, cid long, a int, b int"


def _mark_batch(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                       pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32())], names=["h", "cid", "a", "b"])


def _ranks(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, lengths, common prefix of each string with the one before it in order)."""
    order = np.array(sorted(range(len(parts)), key=parts.__getitem__), np.int64)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    wide = max(1, int(size.max()))
    grid = np.frombuffer(b"".join(p.ljust(wide, b"\0") for p in (parts[i] for i in order.tolist())), np.uint8).reshape(len(parts), wide)
    lcp = np.zeros(len(parts), np.int64)
    for at in range(1, len(parts), 8192):  # bounded memory
        a, b = grid[at - 1:at + 8191][: len(grid[at:at + 8192])], grid[at:at + 8192]
        diff = a != b
        lcp[at:at + len(b)] = np.where(diff.any(1), diff.argmax(1), wide)
    lcp[1:] = np.minimum(lcp[1:], np.minimum(size[order][1:], size[order][:-1]))
    return order, size, lcp


def aligned_group(rows: list[tuple], length: int) -> list[tuple]:
    """The marks of one anchor's classes, ``rows`` as in ``index_groups``.

    A string that starts j bytes before the anchor is its left part of j bytes and its right part of
    length - j bytes.  Parts of equal bytes are runs of the sorted parts with common prefixes that long."""
    n = len(rows)
    left = [r[6][:-r[4]][::-1] for r in rows]
    right = [r[6][-r[4]:] for r in rows]
    (lo_order, lo_size, lo_lcp), (ro, r_size, r_lcp) = _ranks(left), _ranks(right)
    reach = max(-r[4] for r in rows)
    hit = np.zeros((n, reach + 1), bool)
    lid, rid = np.empty(n, np.int64), np.empty(n, np.int64)
    for j in range(reach + 1):
        lid[lo_order] = np.cumsum(lo_lcp < j)
        rid[ro] = np.cumsum(r_lcp < length - j)
        here = np.flatnonzero((lo_size >= j) & (r_size >= length - j))
        key = lid[here] * (n + 1) + rid[here]
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(here) else same
        hit[here[order[twice]], reach - j] = True  # columns by start, ascending
    out = []
    for r, mine in zip(rows, hit):
        if mine.any():
            edge = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
            out += [(r[0], r[1], int(a) - reach, int(b) - 1 - reach) for a, b in zip(edge[::2], edge[1::2])]
    return out


def group_marks(contexts: DataFrame, length: int, max_classes: int) -> DataFrame:
    """Runs of repeated starts of each class, from indexes of whole anchors; anchors with more classes by alignment."""

    def work(held: list[list[tuple]]):
        small = [r for g in held if len(g) <= max_classes for r in g]
        out = index_groups(small, length) if small else []
        for g in held:
            if len(g) > max_classes:
                out += aligned_group(g, length)
        if out:
            yield _mark_batch(out)

    def run(batches):
        held, size = [], 0  # whole anchors, the last still growing
        for batch in batches:
            cols = [batch.column(i) for i in range(7)]
            for r in zip(*(c.to_pylist() for c in cols)):
                if not held or r[0] != held[-1][0][0]:
                    if size >= INDEX_BYTES:
                        yield from work(held)
                        held, size = [], 0
                    held.append([])
                held[-1].append(r)
                size += len(r[6])
        if held:
            yield from work(held)

    return contexts.repartition("h").sortWithinPartitions("h").mapInArrow(run, MARKS)


def string_marks(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many classes: each string is hashed and counted, nothing is gathered."""

    def run(batches):
        for batch in batches:
            h, cid, rel, w = [], [], [], []
            for a, c, lo, hi, ctx in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("h", "cid", "lo", "hi", "ctx"))):
                view = memoryview(ctx)
                for i in range(hi - lo + 1):
                    h.append(a)
                    cid.append(c)
                    rel.append(lo + i)
                    # with the anchor and the place in it: a string of one place lies in the contexts of several anchors
                    w.append(xxhash.xxh3_128_digest(view[i:i + length]) + a.to_bytes(8, "little", signed=True) + (lo + i).to_bytes(4, "little", signed=True))
            if h:
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(cid, pa.int64()), pa.array(rel, pa.int32()),
                                                  pa.array(w, pa.binary())], names=["h", "cid", "rel", "w"])

    strings = contexts.mapInArrow(run, "h long, cid long, rel int, w binary")
    seen = cut(strings.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))  # a class has a string once
    total = seen.agg(F.sum("n")).first()[0] or 0
    hit = join_hot(strings, seen, "w", "n", total).where("n is not null")
    return hit.select("h", "cid", F.col("rel").alias("a"), F.col("rel").alias("b"))


# ---- the whole ----

def _small(df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= limit else df


def _merged(runs):
    """An array of (a, b), b exclusive, as its maximal runs, in order."""
    return F.aggregate(
        F.array_sort(runs), F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["b"] >= x["a"]),
                              F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
                                  F.try_element_at(acc, F.lit(-1))["a"].alias("a"),
                                  F.greatest(F.try_element_at(acc, F.lit(-1))["b"], x["b"]).alias("b")))))
        .otherwise(F.concat(acc, F.array(F.struct(x["a"].cast("long").alias("a"), x["b"].cast("long").alias("b"))))))


def _spans(starts: DataFrame, length: int) -> DataFrame:
    """``starts`` (key, a, b: runs of repeated starts) -> key, spans: the maximal runs of covered bytes, in order."""
    merged = _merged(F.collect_set(F.struct("a", (F.col("b") + length).alias("b"))))
    return starts.groupBy("key").agg(merged.alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, max_classes: int = MAX_CLASSES, max_aligned: int = MAX_ALIGNED,
                   max_broadcast: int = MAX_BROADCAST_ROWS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans, kept_sha256, spans (byte ranges removed)."""
    if not 8 <= anchor <= length:
        raise ValueError("8 <= anchor <= length")
    base = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("key", F.unhex(F.md5("text")))
    long = base.where(F.octet_length("text") >= length)
    rows = anchor_rows(long, length, anchor)

    # an anchor with one place or one class needs no index; places and classes are told apart by extremes, map-side
    place = F.xxhash64("key", "pos")
    seen = rows.groupBy("h").agg(F.min(place).alias("p0"), F.max(place).alias("p1"), F.min("cid").alias("c0"), F.max("cid").alias("c1"))
    repeated = cut(seen.where("p0 <> p1").select("h", (F.col("c0") != F.col("c1")).alias("several")))
    places = cut(rows.join(_small(repeated, max_broadcast), "h").distinct())

    classes = cut(places.groupBy("h", "cid", "lo", "hi", "several").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "pos")).alias("m")))
    whole = classes.where("n > 1").select("h", "cid", F.col("lo").alias("a"), F.col("hi").alias("b"))
    crowd = classes.where("several").groupBy("h").count().where(F.col("count") > max_aligned).select("h", F.lit(True).alias("crowded"))
    members = cut(classes.where("several").join(_small(cut(crowd), max_broadcast), "h", "left").select(
        "h", "cid", "lo", "hi", "crowded", F.col("m.key").alias("key"), F.col("m.pos").alias("pos")))
    wanted = members.groupBy("key").agg(F.collect_list(F.struct("h", "cid", "lo", "hi", "crowded", "pos")).alias("w"))
    if members.count() <= min(max_broadcast, MAX_BROADCAST_MEMBERS):
        wanted = F.broadcast(wanted)
    texts = long.select("key", "text").join(wanted, "key")
    contexts = texts.select("key", F.encode("text", "utf-8").alias("bytes"), F.explode("w").alias("w")).select(
        "w.h", "w.cid", "key", "w.pos", "w.lo", "w.hi", F.substring("bytes", (F.col("w.pos") + F.col("w.lo") + 1).cast("int"),
                                                             (F.col("w.hi") - F.col("w.lo") + length).cast("int")).alias("ctx"), "w.crowded")
    contexts = contexts.dropDuplicates(["h", "cid"])  # equal texts give their member's context more than once
    marks = group_marks(contexts.where("crowded is null").drop("crowded"), length, max_classes)
    if not crowd.isEmpty():
        marks = marks.unionByName(string_marks(contexts.where("crowded").drop("crowded"), length))
    # a class has few maximal runs of starts, and at most one for each start
    marks = cut(marks.unionByName(whole).groupBy("h", "cid").agg(_merged(F.collect_set(F.struct("a", (F.col("b") + 1).alias("b")))).alias("runs")))

    hit = join_hot(places.withColumn("class", F.struct("h", "cid")), marks.join(classes.select("h", "cid", "n"), ["h", "cid"]).select(
        F.struct("h", "cid").alias("class"), "runs", "n"), "class", "n", places.count())
    starts = hit.where("runs is not null").select("key", "pos", F.explode("runs").alias("r")).select(
        "key", (F.col("pos") + F.col("r.a")).alias("a"), (F.col("pos") + F.col("r.b") - 1).alias("b"))
    copies = long.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("size")).where("n > 1")
    starts = starts.unionByName(copies.select("key", F.lit(0).cast("long").alias("a"), (F.col("size") - length).cast("long").alias("b")))
    spans = cut(_spans(starts, length))

    out = base.join(_small(spans, max_broadcast), "key", "left")
    sizes = out.withColumn("n_bytes", F.octet_length("text").cast("long"))
    clean = sizes.where("spans is null").select("doc", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
                                                F.sha2("text", 256).alias("kept_sha256"), F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)").alias("spans"))

    def kept(batches):
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            digests = []
            for t, own in zip(get("text"), get("spans")):
                data, at, d = t.as_py().encode(), 0, hashlib.sha256()
                for s in own.as_py():
                    d.update(data[at:s["a"]])
                    at = s["b"]
                d.update(data[at:])
                digests.append(d.hexdigest())
            yield pa.RecordBatch.from_arrays([get("doc"), get("n_bytes"), pa.array(digests, pa.string()), get("spans")],
                                             names=["doc", "n_bytes", "kept_sha256", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    some = sizes.where("spans is not null").select("doc", "n_bytes", "text", "spans").mapInArrow(
        kept, f"doc {kind}, n_bytes long, kept_sha256 string, spans array<struct<a:bigint,b:bigint>>")
    some = some.select("doc", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"]).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "spans")
    return clean.unionByName(some).withColumnRenamed("doc", key)
