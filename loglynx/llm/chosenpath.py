"""MinHash near-duplicates by a chosen-path set similarity join.

A document's set are the hashes of its distinct word shingles; documents with equal sets
form a class.  Classes whose sets have at least ``percent`` of their union in common are
linked; documents that links connect form a component.

Candidates.  A class has a sketch: the minwise token of its set under each of ``SLOTS``
hash functions.  In a tree, a node's classes are branched by the tokens of one or two
slots drawn from the node's path (100 / ``percent`` on average, so a linked pair keeps one
common child on average); equal tokens go to the same child.  Nodes of one class end,
small nodes are compared exhaustively, sketch against sketch.  In a larger node all
classes are first compared with one of them: if that connects them all, the node ends, so
groups of near copies do not branch for ever.  In distributed levels that is the class nearest to
the most common tokens of some of the node's: the text that a group's copies were made from, if there is one.  ``trees`` independent trees are grown: the
first ``DEPTH`` branchings part a pair of 80 percent similarity in 0.36 of all trees, and
in all of ten with probability 0.00004; groups of thousands branch deeper, and 0.5 of
their pairs meet in a tree.  Sketches that agree in ``percent`` less four standard
deviations are candidates; the components of these are clusters.

Confirmation.  A cluster's full sets are then compared in one task: each class reached is
searched among those not yet reached through the postings of its tokens, which gives a
spanning forest of the cluster's links, all of them exact.  Clusters whose work has no
bound are grown into trees again, now with the full sets: a node ends when one of its
classes is linked with all others, or when it is small enough for the exact search.

Scale.  Copies are collapsed before anything else (map-side combined).  Nodes without a
second class are dropped while they are pairs of numbers; nodes above ``LOCAL`` classes
are branched by distributed levels, others inside a task.  Full sets are made only for the
classes of a cluster, and travel once.  All pairs of a group are never emitted: forests
are.  Components are distributed rounds; nothing is collected.

Defined cases: null texts and texts without words have an empty set and are linked with
nothing; a text of fewer words than a shingle is one token; null ids are linked like
others, and a component of null ids only has a null id; repeated rows are copies; an empty
table gives an empty result; texts of any length are read whole; other columns do not
matter.  Tokens and classes are told apart by 64-bit hashes: about 0.03 pairs of a billion
different classes would be taken for equal.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglynx.llm import text as T
from loglynx.llm.common import components, cut, join_hot, stored

SLOTS = 128  # minwise tokens of a sketch, 16 bits each
DEPTH = 3  # branchings before nodes are looked at: unrelated classes that share a token by chance rarely share three
SMALL = 384  # classes of a node that are compared exhaustively
LOCAL = 1 << 14  # classes of a node that one task branches further: 4 MB of sketches
WORK = 1 << 31  # classes times tokens of a cluster that one task searches exactly
TOKENS = 1 << 22  # tokens of such a cluster: 32 MB
BROADCAST_ROWS = 1_000_000  # ids and roots of candidates sent to all tasks: 24 bytes a row
BROADCAST_NODES = 10_000  # nodes whose compared class is sent to all tasks, if their sets have at most TOKENS tokens
MAX_LEVELS = 500
SAMPLE = 32  # classes of a node, about, whose most common tokens the compared class is chosen by
CHUNK = 1 << 20

_RNG = np.random.Generator(np.random.PCG64(13))
_ODD = _RNG.integers(0, 1 << 32, SLOTS, dtype=np.uint32) | np.uint32(1)
_XOR = _RNG.integers(0, 1 << 32, SLOTS, dtype=np.uint32)


# ---------------------------------------------------------------- sets and sketches

def shingle_sets(raw: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, bounds of each text) of lower-cased texts, sorted within a text."""
    starts, ends, first = T.words(raw, offsets)
    h = T.hashes(raw, starts, ends)
    n = np.diff(first)
    w = T.windows(h, shingle)
    out = []
    for a, k in zip(first[:-1].tolist(), n.tolist()):
        if not k:
            out.append(h[:0])
        elif k < shingle:
            out.append(T.windows(h[a:a + k], k))
        else:
            s = np.sort(w[a:a + k - shingle + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in out])]).astype(np.int64)
    return (np.concatenate(out) if out else h[:0]), bounds


def sketches(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts x SLOTS) minwise tokens; zero for empty sets."""
    out = np.zeros((len(bounds) - 1, SLOTS), np.uint16)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    step = max(1, (1 << 17) // max(1, int(np.diff(bounds).max())))
    base = (tokens >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(full), step):  # so many tokens at once that they stay in the cache
        some = full[a:a + step]
        lo, hi = bounds[some[0]], bounds[some[-1] + 1]
        part, at = base[lo:hi], bounds[some] - lo
        for i in range(SLOTS):
            out[some, i] = np.minimum.reduceat((part ^ _XOR[i]) * _ODD[i], at).astype(np.uint16)
    return out


def identities(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set."""
    mixed = T.mix(tokens * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    return T.mix((total[bounds[1:]] - total[bounds[:-1]]) ^ np.diff(bounds).astype(np.uint64))


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of equal width as binary values."""
    n, width = rows.shape[0], rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * width), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(column: pa.Array) -> np.ndarray:
    """The sketches of a batch."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(np.uint16).reshape(len(column), SLOTS)


def _measured(batches, column: str, shingle: int):
    for batch in batches:
        for part in T.chunks(batch, column, CHUNK):
            tokens, bounds = shingle_sets(*T.flat(part.column(part.schema.get_field_index(column)), lower=True), shingle)
            yield part, tokens, bounds


def profiles(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc, text) -> doc, n_shingles, class_id, sketch."""
    def run(batches):
        for part, tokens, bounds in _measured(batches, "text", shingle):
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(np.diff(bounds)), pa.array(identities(tokens, bounds).view(np.int64)), _binary(sketches(tokens, bounds))],
                names=["doc", "n_shingles", "class_id", "sketch"])

    return docs.mapInArrow(run, f"doc {docs.schema['doc'].dataType.simpleString()}, n_shingles long, class_id long, sketch binary")


# ---------------------------------------------------------------- trees

def slots_of(node: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first slot, second slot, is there a second one) of each node; 100 / percent slots on average."""
    h = T.mix(node * np.uint64(0xD6E8FEB86659FD93))
    second = (h >> np.uint64(40)).astype(np.float64) / (1 << 24) < 100 / percent - 1
    one = (h % np.uint64(SLOTS)).astype(np.int64)
    return one, (one + 1 + ((h >> np.uint64(16)) % np.uint64(SLOTS - 1)).astype(np.int64)) % SLOTS, second


def children(node: np.ndarray, sketch: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, child nodes): the children of each row's node that the row goes to."""
    one, two, second = slots_of(node, percent)
    rows = np.arange(len(node))
    more = np.flatnonzero(second)
    at, slot = np.concatenate([rows, more]), np.concatenate([one, two[more]])
    told = (slot.astype(np.uint64) << np.uint64(16)) | sketch[at, slot].astype(np.uint64)
    return at, T.mix(T.mix(node[at] * np.uint64(0x9E3779B185EBCA87) + told) * np.uint64(0xC2B2AE3D27D4EB4F))


def root(tree: int) -> np.uint64:
    return T.mix(np.array([tree + 1], np.uint64) * np.uint64(0xA24BAED4963EE407))[0]


def least_equal(percent: int) -> int:
    """Equal slots of a candidate: four standard deviations below the similarity asked for."""
    p = percent / 100
    return max(1, math.floor(SLOTS * p - 4 * math.sqrt(SLOTS * p * (1 - p))))


class _Sets:
    """Which rows of a node are connected so far, and the links that did it."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.label, self.links = ids, np.arange(len(ids)), []

    def star(self, center: int, others: np.ndarray) -> None:
        labels, at = np.unique(self.label[others], return_index=True)
        new = labels != self.label[center]
        for x in others[at[new]].tolist():
            self.links.append((self.ids[center], self.ids[x]))
        if new.any():
            gone = np.zeros(len(self.label), bool)
            gone[labels] = True
            self.label[gone[self.label]] = self.label[center]


def near_forest(ids: np.ndarray, sketch: np.ndarray, node: np.uint64, percent: int) -> list[tuple[int, int]]:
    """Links that connect a node's classes as all its candidate pairs would that one tree below it finds."""
    known, least = _Sets(ids), least_equal(percent)
    stack = [(np.arange(len(ids)), node)]
    while stack:
        rows, path = stack.pop()
        if (known.label[rows] == known.label[rows[0]]).all():
            continue
        for i in range(len(rows) - 1 if len(rows) <= SMALL else 1):
            rest = rows[i + 1:]
            known.star(rows[i], rest[(sketch[rest] == sketch[rows[i]]).sum(1) >= least])
        if len(rows) > SMALL and (known.label[rows] != known.label[rows[0]]).any():
            at, child = children(np.full(len(rows), path), sketch[rows], percent)
            order = np.argsort(child, kind="stable")
            at, child = at[order], child[order]
            ends = np.flatnonzero(np.concatenate([child[1:] != child[:-1], [True]])) + 1
            for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()):
                if b - a > 1:
                    stack.append((rows[at[a:b]], child[a]))
    return known.links


def exact_forest(ids: np.ndarray, tokens: np.ndarray, bounds: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between full sets: each class reached is compared, through the
    postings of its tokens, with those not yet reached."""
    n, size = len(ids), np.diff(bounds)
    _, token = np.unique(tokens, return_inverse=True)
    posting = np.repeat(np.arange(n), size)[np.argsort(token, kind="stable")]
    count = np.bincount(token)
    start = np.cumsum(count) - count
    left, links = np.ones(n, bool), []
    for s in range(n):
        queue = [s] if left[s] else []
        left[s] = False
        while queue:
            x = queue.pop()
            own = token[bounds[x]:bounds[x + 1]]
            much = count[own]
            at = np.repeat(start[own] - (np.cumsum(much) - much), much) + np.arange(much.sum())
            common = np.bincount(posting[at], minlength=n)
            found = np.flatnonzero(left & (common > 0) & (100 * common >= percent * (size[x] + size - common)))
            left[found] = False
            queue.extend(found.tolist())
            links.extend((ids[x], ids[y]) for y in found)
    return links


def _runs(batches, key: int) -> Iterator[pa.Table]:
    """Tables of whole keys of a stream sorted by key; the last key of a batch is held back."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))[-1])
        if held and held[-1].column(key)[held[-1].num_rows - 1].as_py() == k[0] and not last:
            held.append(batch)
            continue
        held.append(batch.slice(0, last))
        if sum(b.num_rows for b in held):
            yield pa.Table.from_batches([b for b in held if b.num_rows])
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def _bounds(k: np.ndarray) -> np.ndarray:
    return np.concatenate([np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])), [len(k)]])


def _links(a, b) -> Iterator[pa.RecordBatch]:
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(np.asarray(a, np.int64)), pa.array(np.asarray(b, np.int64))], names=["a", "b"])


def _near(percent: int):
    """Rows (node, class_id, sketch) sorted by node -> candidate links."""
    least = least_equal(percent)

    def run(batches):
        for t in _runs(batches, 0):
            t = t.combine_chunks()
            node = t.column(0).to_numpy().view(np.uint64)
            ids, sketch = t.column(1).to_numpy(), _matrix(t.column(2).combine_chunks() if t.column(2).num_chunks != 1 else t.column(2).chunk(0))
            at = _bounds(node)
            size = np.diff(at)
            for n in range(2, 7):  # all nodes of one small size at once
                first = at[:-1][size == n]
                for i in range(n):
                    for j in range(i + 1, n):
                        for k in range(0, len(first), 1 << 14):
                            x, y = first[k:k + (1 << 14)] + i, first[k:k + (1 << 14)] + j
                            near = (sketch[x] == sketch[y]).sum(1) >= least
                            yield from _links(ids[x[near]], ids[y[near]])
            for a, n in zip(at[:-1][size > 6].tolist(), size[size > 6].tolist()):
                found = near_forest(ids[a:a + n], sketch[a:a + n], node[a], percent)
                yield from _links([x for x, _ in found], [y for _, y in found])
    return run


def _exact(percent: int):
    """Rows (node, class_id, words) sorted by both -> links."""
    def run(batches):
        for t in _runs(batches, 0):
            at = _bounds(t.column(0).to_numpy())
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                ids = t.column(1).slice(a, b - a).to_numpy()
                once = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))  # repeated rows
                if len(once) > 1:
                    sets = [np.frombuffer(w.as_buffer(), np.uint64) for w in t.column(2).slice(a, b - a).take(pa.array(once))]
                    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                    found = exact_forest(ids[once], np.concatenate(sets), bounds, percent)
                    yield from _links([x for x, _ in found], [y for _, y in found])
    return run


def _branch(percent: int):
    """Rows (node, class_id, sketch, words) -> the same rows under their children."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                at, child = children(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), _matrix(batch.column(2)), percent)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *[c.take(pa.array(at)) for c in batch.columns[1:]]], names=batch.schema.names)
    return run


def _compared(percent: int, exact: bool):
    """Rows with the class their node is compared with -> the same rows with ``linked``."""
    least = least_equal(percent)

    def same(x: bytes, y: bytes) -> bool:
        common = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
        return 100 * common >= percent * (len(x) // 8 + len(y) // 8 - common)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                if exact:
                    linked = np.array([same(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column(3), batch.column(6))])
                else:
                    linked = (_matrix(batch.column(2)) == _matrix(batch.column(5))).sum(1) >= least
                own = batch.column(1).to_numpy(zero_copy_only=False) == batch.column(4).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(linked | own)], names=[*batch.schema.names[:5], "linked"])
    return run


def _common(table: pa.Table) -> pa.Table:
    """Some rows (node, sketch) of one node -> the sketch of the most common token of each slot."""
    found = [np.unique(slot, return_counts=True) for slot in _matrix(pa.concat_arrays(table.column("sketch").chunks)).T]
    return pa.table({"node": table.column("node").slice(0, 1), "common": _binary(np.array([[v[n.argmax()] for v, n in found]], np.uint16))})


def _scored(batches):
    """Rows with their node's common sketch -> the same rows with the number of slots equal to it."""
    for batch in batches:
        if batch.num_rows:
            score = (_matrix(batch.column(2)) == _matrix(batch.column(4))).sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(score)], names=[*batch.schema.names[:4], "score"])


ROWS = "node long, class_id long, sketch binary, words binary"


def grow(rows: DataFrame, percent: int, exact: bool, local: int = LOCAL, work: int = WORK) -> tuple[list[DataFrame], list[DataFrame]]:
    """(leaves, links) of ``rows`` (node, class_id, sketch, words): level by level, nodes that are small
    enough for one task become leaves; in others all classes are compared with one of them, and nodes
    which that does not connect are branched."""
    leaves, links = [], []
    for _ in range(MAX_LEVELS):
        rows = stored(rows, "tree-nodes")
        tokens = F.sum(F.length("words") / 8).cast("long").alias("tokens")
        sizes = cut(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), tokens).where("n > 1"))
        fits = (F.col("n") * F.col("tokens") <= work) & (F.col("tokens") <= TOKENS) if exact else F.col("n") <= local
        leaves.append(rows.join(sizes.where(fits).select("node"), "node"))
        large = sizes.where(~fits)
        count, total = large.agg(F.count(F.lit(1)), F.max("tokens")).first()
        if not count:
            return leaves, links
        held = (lambda df: F.broadcast(df)) if count <= BROADCAST_NODES and (not exact or count * total <= TOKENS) else (lambda df: df)
        rows, drawn = rows.join(held(large.select("node", "n")), "node"), F.xxhash64("class_id", "node")
        common = rows.where(F.pmod(drawn, "n") < SAMPLE).select("node", "sketch").groupBy("node").applyInArrow(_common, "node long, common binary")
        told = rows.join(held(common), "node", "left").select("node", "class_id", "sketch", "words", F.coalesce("common", "sketch").alias("common"))
        center = told.mapInArrow(_scored, ROWS + ", score long").groupBy("node").agg(
            F.min_by(F.struct("class_id", "sketch", "words"), F.struct(-F.col("score"), drawn)).alias("c"))
        center = center.select("node", F.col("c.class_id").alias("center"), F.col("c.sketch").alias("c_sketch"), F.col("c.words").alias("c_words"))
        told = rows.join(held(center), "node").select("node", "class_id", "sketch", "words", "center", "c_sketch", "c_words")
        told = stored(told.mapInArrow(_compared(percent, exact), ROWS + ", center long, linked boolean"), "tree-compared")
        links.append(told.where("linked and class_id <> center").select(F.col("center").alias("a"), F.col("class_id").alias("b")))
        still = told.where(~F.col("linked")).select("node").distinct()
        rows = told.join(held(still), "node").select("node", "class_id", "sketch", "words").mapInArrow(_branch(percent), ROWS)
    raise RuntimeError("the trees did not end")


def candidates(classes: DataFrame, percent: int, trees: int, local: int = LOCAL) -> DataFrame:
    """Links (a, b) between classes whose sketches are near, connecting them as all such pairs that ``trees`` trees find."""
    def first(batches):
        for batch in batches:
            if batch.num_rows:
                ids, sketch = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
                for tree in range(trees):
                    at, node = np.arange(len(ids)), np.full(len(ids), root(tree))
                    for _ in range(DEPTH):
                        on, node = children(node, sketch[at], percent)
                        at = at[on]
                    yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(ids[at])], names=["node", "class_id"])

    keys = classes.select("class_id", "sketch").mapInArrow(first, "node long, class_id long")
    shared = keys.groupBy("node").count().where("count > 1").select("node")
    keys = keys.join(shared, "node")  # most classes share no token with another: dropped before their sketches travel
    rows = keys.join(classes.select("class_id", "sketch"), "class_id").select("node", "class_id", "sketch", F.lit(b"").alias("words"))
    leaves, links = grow(rows, percent, False, local)
    for leaf in leaves:
        dealt = leaf.select("node", "class_id", "sketch").repartition("node").sortWithinPartitions("node", "class_id")
        links.append(dealt.mapInArrow(_near(percent), "a long, b long"))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def confirmed(docs: DataFrame, classes: DataFrame, clusters: DataFrame, shingle: int, percent: int, trees: int, work: int = WORK) -> DataFrame:
    """Exact links (a, b) that connect the classes of each cluster (node, root) as all its links would."""
    members = cut(classes.join(clusters, classes["class_id"] == clusters["node"]).select("class_id", "first_id", "n_shingles", "sketch", "root"))
    sizes = cut(members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("tokens"))
                .withColumn("fits", (F.col("n") * F.col("tokens") <= work) & (F.col("tokens") <= TOKENS)))
    wanted = members.select("first_id", F.col("class_id").alias("wanted"), "root")
    if members.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, F.col("doc").eqNullSafe(F.col("first_id"))).select("text", "wanted", "root")

    def full(batches):
        for part, tokens, bounds in _measured(batches, "text", shingle):
            ids = identities(tokens, bounds).view(np.int64)
            keep = pa.array(np.flatnonzero((ids == part.column(1).to_numpy(zero_copy_only=False)) & (np.diff(bounds) > 0)))  # ids may repeat
            offsets = pa.py_buffer((bounds * 8).astype(np.int64))
            words = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, offsets, pa.py_buffer(np.ascontiguousarray(tokens))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(2).take(keep), pa.array(ids).take(keep), words.take(keep)], names=["root", "class_id", "words"])

    sets = texts.mapInArrow(full, "root long, class_id long, words binary")
    large = sizes.where(~F.col("fits")).select("root")
    if not large.isEmpty():
        sets = cut(sets)
    dealt = sets.join(sizes.where("fits").select("root"), "root").repartition("root").sortWithinPartitions("root", "class_id")
    out = dealt.mapInArrow(_exact(percent), "a long, b long")
    if large.isEmpty():
        return out
    rows = sets.join(large, "root").dropDuplicates(["class_id"]).join(members.select("class_id", "sketch"), "class_id")
    rows = rows.withColumn("node", F.explode(F.transform(F.sequence(F.lit(1), F.lit(trees)), lambda i: F.xxhash64(F.lit("tree"), "root", i))))
    leaves, links = grow(rows.select("node", "class_id", "sketch", "words"), percent, True, work=work)
    for leaf in leaves:
        dealt = leaf.select("node", "class_id", "words").repartition("node").sortWithinPartitions("node", "class_id")
        out = out.unionByName(dealt.mapInArrow(_exact(percent), "a long, b long"))
    for more in links:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, shingle: int = 4, percent: int = 80, trees: int = 10, key: str = "doc_id", text: str = "text",
                    local: int = LOCAL, work: int = WORK) -> DataFrame:
    """One row per document: key, n_shingles, component_id (the smallest key reachable), kept (it is the document's own)."""
    docs = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    rows = cut(profiles(docs, shingle))
    classes = cut(rows.where("n_shingles > 0").groupBy("class_id").agg(
        F.min("doc").alias("first_id"), F.count(F.lit(1)).alias("n_rows"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")))
    clusters = components(candidates(classes, percent, trees, local))
    linked = components(confirmed(docs, classes, clusters, shingle, percent, trees, work)).select(F.col("node").alias("class_id"), "root")
    told = cut(classes.select("class_id", "first_id", "n_rows").join(linked, "class_id", "left"))
    group = told.where("root is not null").groupBy("root").agg(F.min("first_id").alias("component_id"))
    many = told.where("root is not null").join(group, "root").select("class_id", "n_rows", "component_id")
    found = many.unionByName(told.where("root is null").select("class_id", "n_rows", F.col("first_id").alias("component_id")))
    some = rows.where("n_shingles > 0").select("doc", "n_shingles", "class_id")
    out = join_hot(some, found, "class_id", "n_rows", rows.count()).select("doc", "n_shingles", "component_id")
    out = out.unionByName(rows.where("n_shingles = 0").select("doc", "n_shingles", F.col("doc").alias("component_id")))
    return out.select(F.col("doc").alias(key), "n_shingles", "component_id", F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"))
