"""SimHash near-duplicates with pigeonring filtering.

A document's fingerprint has a bit for each of the 64 bits of its shingles' hashes: set
if set in over half of them.  Fingerprints that differ in at most ``max_bits`` bits are
linked; documents that links connect form a group.

Search.  The 64 bits are cut into ``segments`` consecutive segments on a ring.  If two
fingerprints differ in at most t bits, some start segment exists from which every chain
of l consecutive segments differs in at most l * t / segments bits (the pigeonring
principle).  With segments > t the first segment of that chain is equal and the first
two differ in one bit at most, so one half of the second is equal too: the pair meets
under one of 2 * segments keys (start, first segment, equal half of the second).  Pairs
that meet are pruned by the budgets of the longer chains before the full Hamming check.

Scale.  Equal fingerprints are collapsed first (map-side combined), so copies cost
nothing.  A key's fingerprints are read as a sorted stream; large keys are searched
breadth-first (every fingerprint is compared only with those not yet reached), which
yields a spanning forest of the key's links, at most one link per fingerprint: pairs
within a group are never emitted, and no link between components is lost.  Components
are found by distributed rounds; nothing is collected.

Defined cases: null texts and texts without a word have fingerprint zero and are linked
like others; a group with only null doc_ids has a null component_id; repeated rows share
a fingerprint and ``keep_one`` keeps one of them; an empty table gives an empty result;
texts of any length are read whole; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglynx.llm import text as T
from loglynx.llm.common import components, cut, free_name, join_hot

BITS = 64
SEED = 42  # of the shingle hash
SMALL_KEY = 8  # keys with more fingerprints are searched breadth-first


def fingerprint(text: bytes, shingle: int) -> int:
    """Lower-cased words, shingles of ``shingle`` words, majority of each hash bit."""
    words = text.translate(T.LOWER_BYTES).split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())), np.uint64, n)
    count = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = h[at:at + (1 << 16)]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(count * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` without ``text`` plus the fingerprint as a signed long."""
    inner = docs.withColumn(text, F.col(text).cast("string"))
    rest = [c for c in docs.columns if c != text]
    fields = [f for f in inner.schema.fields if f.name != text]

    def run(batches):
        for batch in batches:
            for part in T.chunks(batch, text):
                raw, offs = T.flat(part.column(part.schema.get_field_index(text)))
                buf = raw.tobytes()
                fp = np.fromiter((fingerprint(buf[a:b], shingle) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())),
                                 np.uint64, part.num_rows)
                yield T.replace_columns(part, rest, **{name: pa.array(fp.view(np.int64))})

    schema = type(inner.schema)(fields).add(name, "long", False)
    return inner.mapInArrow(run, schema)


def layout(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def ring_keys(fp: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, key) arrays, each 2 * segments rows for each fingerprint, in blocks of len(fp)."""
    cuts = layout(segments)
    seg = [(fp >> np.uint64(a)) & np.uint64((1 << w) - 1) for a, w in cuts]
    keys = []
    for i in range(segments):
        j = (i + 1) % segments
        half = cuts[j][1] // 2
        low, high = seg[j] & np.uint64((1 << half) - 1), seg[j] >> np.uint64(half)
        for part, value in ((0, low), (1, high)):
            keys.append((np.uint64(2 * i + part) << np.uint64(56)) | (seg[i] << np.uint64(24)) | value)
    return np.concatenate(keys)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def chain_ok(diff: np.ndarray, start: np.ndarray | int, segments: int, max_bits: int) -> np.ndarray:
    """Do the chains of 1, 2, ... segments from ``start`` stay within l * max_bits / segments?"""
    cuts = layout(segments)
    table = np.stack([popcount((diff >> np.uint64(a)) & np.uint64((1 << w) - 1)) for a, w in cuts], -1).astype(np.int64)
    total = np.zeros(diff.shape, np.int64)
    good = np.ones(diff.shape, bool)
    for step in range(segments):
        at = (np.asarray(start) + step) % segments
        total += np.take_along_axis(table, np.broadcast_to(at, diff.shape)[..., None], -1)[..., 0]
        good &= total * segments <= (step + 1) * max_bits
    return good


def forest(fp: np.ndarray, start: int, segments: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of one key's links: breadth-first, each fingerprint against those not yet reached."""
    cuts = layout(segments)
    pair = np.uint64(sum(((1 << w) - 1) << a for a, w in (cuts[start], cuts[(start + 1) % segments])))
    left = fp.copy()
    a, b = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            diff = left ^ x
            near = popcount(diff & pair) * segments <= 2 * max_bits  # the chain of two
            near[near] = chain_ok(diff[near], start, segments, max_bits)
            near[near] = popcount(diff[near]) <= max_bits
            if near.any():
                found = left[near]
                a.append(np.full(len(found), x))
                b.append(found)
                queue.extend(found)
                left = left[~near]
    z = np.zeros(0, np.uint64)
    return (np.concatenate(a) if a else z), (np.concatenate(b) if b else z)


def links(fps: DataFrame, max_bits: int = 4, segments: int | None = None) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints of ``fps`` (column fp) as all links would."""
    m = segments or max_bits + 1
    if m <= max_bits:
        raise ValueError("more segments than max_bits are needed")

    def keyed(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), 1 << 17):
                part = fp[at:at + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array(ring_keys(part, m).view(np.int64)),
                                                  pa.array(np.tile(part, 2 * m).view(np.int64))], names=["key", "fp"])

    def search(batches):
        for key, fp in runs(batches):
            yield from _emit(*pairs(key, fp, m, max_bits))

    keys = fps.select("fp").mapInArrow(keyed, "key long, fp long")
    dealt = keys.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(search, "a long, b long")


def _emit(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def runs(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole keys of a stream sorted by key: (keys, fingerprints), the last key of a batch held back."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        k = batch.column(0).to_numpy(zero_copy_only=False)
        f = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(k):
            continue
        if held and k[0] == k[-1] == held[-1][0][-1]:
            held.append((k, f))
            continue
        last = int(np.searchsorted(k, k[-1]))
        held.append((k[:last], f[:last]))
        hk, hf = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
        held = [(k[last:], f[last:])]
        if len(hk):
            yield hk, hf
    if held:
        yield np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])


def pairs(key: np.ndarray, fp: np.ndarray, m: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([first, [len(key)]]))
    a, b = [], []
    for n in range(2, SMALL_KEY + 1):  # all keys of one size at once
        at = first[size == n]
        if not len(at):
            continue
        block = fp[at[:, None] + np.arange(n)]
        start = (key[at].view(np.uint64) >> np.uint64(57)).astype(np.int64)
        for i in range(n):
            for j in range(i + 1, n):
                diff = block[:, i] ^ block[:, j]
                near = chain_ok(diff, start, m, max_bits)
                near[near] = popcount(diff[near]) <= max_bits
                a.append(block[near, i])
                b.append(block[near, j])
    for at, n in zip(first[size > SMALL_KEY].tolist(), size[size > SMALL_KEY].tolist()):
        x, y = forest(fp[at:at + n], int(key[at].view(np.uint64) >> np.uint64(57)), m, max_bits)
        a.append(x)
        b.append(y)
    z = np.zeros(0, np.uint64)
    return (np.concatenate(a) if a else z), (np.concatenate(b) if b else z)


def classes(rows: DataFrame, max_bits: int = 4, segments: int | None = None, key: str = "doc_id") -> DataFrame:
    """``rows`` (key, fp) -> one row per fingerprint: fp, root (of its group), first_id, n_rows, component_id."""
    distinct = cut(rows.groupBy("fp").agg(F.min(key).alias("first_id"), F.count(F.lit(1)).alias("n_rows")))
    roots = components(links(distinct, max_bits, segments)).select(F.col("node").alias("fp"), "root")
    linked = cut(distinct.join(roots, "fp", "left"))
    groups = linked.where("root is not null").groupBy("root").agg(F.min("first_id").alias("component_id"))
    many = linked.where("root is not null").join(groups, "root").select("fp", "root", "first_id", "n_rows", "component_id")
    alone = linked.where("root is null").select(
        "fp", F.col("fp").alias("root"), "first_id", "n_rows", F.col("first_id").alias("component_id"))
    return many.unionByName(alone)


def _labelled(docs: DataFrame, shingle: int, max_bits: int, segments: int | None, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """((key, fp, n_rows, root, component_id) of every row, classes), both cut."""
    rows = cut(fingerprints(docs.select(key, text), shingle, text))
    found = cut(classes(rows, max_bits, segments, key))
    return join_hot(rows, found.drop("first_id"), "fp", "n_rows", rows.count()), found


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, segments: int | None = None,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, fingerprint (16 hex digits), component_id."""
    rows, _ = _labelled(docs, shingle, max_bits, segments, key, text)
    return rows.select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, segments: int | None = None,
             key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, that with the smallest key, columns unchanged.

    The decision is made on (key, fingerprint) alone; texts meet the list of dropped keys
    in one join.  Where keys repeat or are null (``again``), rows are told apart by their
    fingerprint and numbered, and the first of the chosen fingerprint stays.
    """
    rows, found = _labelled(docs, shingle, max_bits, segments, key, text)
    rows = cut(rows)
    again = cut(rows.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()).select(key))
    gone = rows.where(~F.col(key).eqNullSafe(F.col("component_id"))).select(key).unionAll(again).where(F.col(key).isNotNull())
    out = docs.where(F.col(key).isNotNull()).join(gone.distinct(), key, "left_anti").select(*docs.columns)
    if again.isEmpty():
        return out
    c_fp, c_key, c_again = (free_name(docs, n) for n in ("simhash_of", "simhash_key", "simhash_again"))
    chosen = found.where(F.col("first_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("fp").alias(c_fp), F.min("component_id").alias(c_key)).select(c_fp, c_key)
    fp, nth = free_name(docs, "simhash_fp"), free_name(docs, "simhash_nth")
    some = again.select(F.col(key).alias(c_again))
    copies = docs.join(some, F.col(key).eqNullSafe(F.col(c_again)), "left_semi")
    held = free_name(docs, "simhash_text")
    copies = fingerprints(copies.withColumn(held, F.col(text)), shingle, held, fp)
    copies = copies.join(chosen, (F.col(fp) == F.col(c_fp)) & F.col(key).eqNullSafe(F.col(c_key)))
    copies = copies.withColumn(nth, F.row_number().over(Window.partitionBy(c_fp, c_key).orderBy(F.lit(0)))).where(F.col(nth) == 1)
    return out.unionByName(copies.select(*docs.columns))
