"""Language-model scores from an Elias-Fano n-gram trie.

The model gives a token w after a context v (the token before it; a start mark for the
first) the probability

    p(w | v) = (1 - e) * (max(c(v, w) - D, 0) / c(v) + D * n(v) / c(v) * p1(w)) + e * p1(w)

with c counts, n(v) the different successors of v, and p1 the smoothed share of w itself,
(c(w) + 1) / (N + V + 1); after an unseen context it is p1(w).  It sums to one.

The trie.  Level one holds all words (64-bit hashes, sorted) and their counts (as prefix
sums), cut by hash into files.  Level two holds contexts, monotone pointers to their
successors, and the successors as (context, word number) values, which makes the whole
level one monotone sequence; a successor is searched within its context's pointers.
Probabilities of seen successors and weights of contexts are quantised logarithms of two
bytes.  Every level is an Elias-Fano sequence in a file of the shared folder, read by
memory map.

Scale.  Level two is never whole in one place: tokens are dealt by context to shards of
about ``tokens_per_shard``; a task builds its shard's levels from the training tokens and
scores all tokens of the shard with them, so a token travels once, packed with its
neighbours.  Words with over 1/HOT_WORDS of all tokens (at most HOT_WORDS exist) are hot:
pairs of two hot words are counted beforehand, pre-aggregated, and scored without a
shuffle, and the other successors of a hot context are dealt in buckets, each a context of
its own: its discounted weight goes to the words of the bucket by p1, so the sum stays
one.  Level one is mapped by every task; it grows with the vocabulary (a few bytes a
word), up to ``MAX_LEVEL_ONE`` words, a bound that is checked.  A start mark is a hot
word.

Defined cases: a null text is empty and has one token, the end; documents with a null id
are training text; repeated rows are scored each and counted each; texts are read whole;
without any training token all counts are zero; an empty table gives an empty result;
other columns do not matter.
"""

from __future__ import annotations

import functools
import io
import re
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglynx.llm import text as T
from loglynx.llm.common import cut
from loglynx.llm.eliasfano import Sequence, pack, unpack
from loglynx.session import work_dir

U64 = np.uint64
END, START = U64(0x454E44), U64(0x5354415254)  # marks among the word hashes
HOT_WORDS = 16384
RESIDUES = 4096
MAX_LEVEL_ONE = 2_000_000_000
WORDS_PER_FILE = 4_000_000
CHUNK_BYTES = 2 << 20   # text tokenised at once
PACK_TOKENS = 2_000_000  # tokens whose packets share their tables of words and contexts
STEP = 16.0 / 65535  # of the quantised logarithms


# ---- files of the shared folder ----

def _filesystem(path: str):
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def put(path: str, parts: dict[str, np.ndarray]) -> None:
    """Write and then name the file: a repeated task leaves the same file."""
    fs, at = _filesystem(path)
    fs.create_dir(at.rpartition("/")[0], recursive=True)
    part = f"{at}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        out.write(pack(parts))
    fs.move(part, at)


def get(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped where the folder is mounted."""
    fs, at = _filesystem(path)
    if isinstance(fs, pafs.LocalFileSystem):
        return unpack(np.memmap(at, np.uint8, "r"))
    with fs.open_input_file(at) as f:
        return unpack(f.read_buffer())


# ---- tokens ----

def held_out(ids: pa.Array, modulus: int, rest: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(str(i).encode() if i is not None else b"") % modulus == rest for i in ids.to_pylist()), bool, len(ids))


def tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, row, place of each row's first) of a chunk (id, text): each row's words and one end."""
    raw, offs = T.flat(part.column(1), lower=True)
    starts, ends, bounds = T.words(raw, offs)
    n = part.num_rows
    w = np.insert(T.hashes(raw, starts, ends), bounds[1:], END)
    return w, np.repeat(np.arange(n), np.diff(bounds) + 1), bounds[:-1] + np.arange(n)


def before(values: np.ndarray, first: np.ndarray, start) -> np.ndarray:
    """The value of the token before each; ``start`` for the first of a row."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[first] = start
    return out


# ---- level one ----

@dataclass(frozen=True)
class Level1:
    """Where the word files are, and the totals of the training text."""

    folder: str
    bits: int             # files are cut by this many high bits of the hash
    n: int                # training tokens
    v: int                # different training tokens
    starts: int           # training documents
    hot: np.ndarray       # hashes of the hot words, sorted, the start mark among them
    hot_counts: np.ndarray
    cold_mass: np.ndarray  # sums of c + 1 over words that are not hot, by hash residue

    @property
    def whole(self) -> float:
        return float(self.n + self.v + 1)

    def counts(self, words: np.ndarray) -> np.ndarray:
        """Training counts of distinct words in ascending order."""
        out = np.zeros(len(words), np.int64)
        part = (words >> U64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(words), np.int64)
        edges = np.searchsorted(part, np.arange((1 << self.bits) + 1))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            words_of, sums = _level1_file(f"{self.folder}/{k}")
            own = words[edges[k]:edges[k + 1]]
            at = words_of.find(own & U64((1 << (64 - self.bits)) - 1) if self.bits else own)
            got = np.flatnonzero(at >= 0)
            out[edges[k] + got] = (sums.get(at[got] + 1) - sums.get(at[got])).astype(np.int64)
        out[words == START] = self.starts
        return out

    def hot_places(self, words: np.ndarray) -> np.ndarray:
        """Place among the hot words, -1 for others."""
        at = np.minimum(np.searchsorted(self.hot, words), max(len(self.hot) - 1, 0))
        return np.where(self.hot[at] == words, at, -1) if len(self.hot) else np.full(len(words), -1)


@functools.lru_cache(maxsize=4096)
def _level1_file(path: str) -> tuple[Sequence, Sequence]:
    parts = get(path)
    return Sequence.of(parts, "words"), Sequence.of(parts, "sums")


def level1(rows: DataFrame, folder: str, modulus: int, rest: int, hot_words: int) -> Level1:
    """``rows`` (id, text): count the training words, pre-aggregated by chunk and task, and write their level."""
    spark = rows.sparkSession

    def count(batches):
        for batch in batches:
            for part in T.chunks(batch, "text"):
                w, row, first = tokens(part)
                train = ~held_out(part.column(0), modulus, rest)
                u, c = np.unique(np.concatenate([w[train[row]], np.full(int(train.sum()), START)]), return_counts=True)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(c)], names=["w", "c"])

    counts = cut(rows.mapInArrow(count, "w long, c long").groupBy("w").agg(F.sum("c").alias("c")))
    start = int(START.view(np.int64)) if hasattr(START, "view") else int(START)
    words = counts.where(F.col("w") != start)
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    starts = (counts.where(F.col("w") == start).select("c").first() or [0])[0]
    if v > MAX_LEVEL_ONE:
        raise ValueError(f"{v} words: level one is mapped whole by every task, up to {MAX_LEVEL_ONE} words")
    bits = max(0, (v // WORDS_PER_FILE).bit_length())
    hot = counts.where((F.col("c") > n // hot_words) | (F.col("w") == start)).collect()  # at most hot_words + 1 rows
    order = np.argsort(np.array([r.w for r in hot], np.int64).view(U64), kind="stable")
    hot_w = np.array([r.w for r in hot], np.int64).view(U64)[order]
    cold = words.where(F.col("c") <= n // hot_words).groupBy(F.col("w").bitwiseAND(F.lit(RESIDUES - 1)).alias("r")).agg(F.sum(F.col("c") + 1).alias("m")).collect()
    mass = np.zeros(RESIDUES)
    for r in cold:  # RESIDUES rows at most
        mass[r.r] = r.m

    def save(batches):
        held: dict[int, list] = {}
        for batch in batches:
            part = batch.column(0).to_numpy()
            for k in np.unique(part).tolist():
                pick = part == k
                held.setdefault(k, []).append((batch.column(1).to_numpy()[pick].view(U64), batch.column(2).to_numpy()[pick]))
        for k, own in held.items():
            w, c = (np.concatenate(x) for x in zip(*own))
            order = np.argsort(w, kind="stable")
            low = w[order] & U64((1 << (64 - bits)) - 1) if bits else w[order]
            put(f"{folder}/{k}", Sequence.build(low).parts("words") | Sequence.build(np.concatenate([[0], np.cumsum(c[order])])).parts("sums"))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32())], names=["k"])

    part = F.shiftrightunsigned("w", 64 - bits) if bits else F.lit(0)
    dealt = words.select(part.cast("int").alias("k"), "w", "c").repartition(1 << bits, "k")
    there = {r.k for r in dealt.mapInArrow(save, "k int").collect()}  # numbers of files
    for k in set(range(1 << bits)) - there:
        put(f"{folder}/{k}", Sequence.build(np.zeros(0, U64)).parts("words") | Sequence.build(np.zeros(1, U64)).parts("sums"))
    return Level1(folder, bits, int(n), int(v), int(starts), hot_w, np.array([r.c for r in hot], np.int64)[order], mass)


# ---- level two ----

def quantised(logs: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(-logs, 0, 16) / STEP).astype(np.uint16)


class Trie:
    """Contexts, their successors and the quantised probabilities of one shard."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.contexts, self.pointers = Sequence.of(parts, "contexts"), Sequence.of(parts, "pointers")
        self.words, self.successors = Sequence.of(parts, "words"), Sequence.of(parts, "successors")
        self.prob, self.weight = parts["prob"], parts["weight"]

    @staticmethod
    def build(context: np.ndarray, word: np.ndarray, count: np.ndarray, total: np.ndarray, p1: np.ndarray, mass: np.ndarray,
              discount: float, mixed: float) -> dict[str, np.ndarray]:
        """From distinct (context, word), sorted, with count, the context's total, the word's p1 and the p1 mass of the
        context's bucket."""
        starts = np.concatenate([[True], context[1:] != context[:-1]]) if len(context) else np.zeros(0, bool)
        new, of = np.flatnonzero(starts), np.cumsum(starts) - 1
        kinds = np.diff(np.concatenate([new, [len(context)]]))
        # the weight of p1: the discounted share goes to the bucket's words by p1
        weight = (1 - mixed) * discount * kinds / (total[new] * mass[new]) + mixed
        prob = (1 - mixed) * np.maximum(count - discount, 0) / total + weight[of] * p1
        vocabulary, number = np.unique(word, return_inverse=True)
        return (Sequence.build(context[new]).parts("contexts") | Sequence.build(np.concatenate([new, [len(context)]])).parts("pointers")
                | Sequence.build(vocabulary).parts("words") | Sequence.build(of.astype(U64) * U64(max(1, len(vocabulary))) + number.astype(U64)).parts("successors")
                | {"prob": quantised(np.log10(np.minimum(prob, 1.0))), "weight": quantised(np.log10(np.minimum(weight, 1.0)))})

    def logs(self, contexts: np.ndarray, words: np.ndarray, p1: np.ndarray, absent: np.ndarray, ci: np.ndarray, wi: np.ndarray) -> np.ndarray:
        """log10 p(words[wi] | contexts[ci]) of pairs of given distinct contexts and words; ``absent``: a
        context's weight (its logarithm) if it is not in the trie; ``p1`` by word."""
        c, w, base = self.contexts.find(contexts), self.words.find(words), np.log10(p1)
        there = c >= 0
        weight = absent.copy()
        weight[there] = self.weight[c[there]] * -STEP
        lo, hi = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
        lo[there], hi[there] = self.pointers.get(c[there]), self.pointers.get(c[there] + 1)
        out = base[wi] + weight[ci]
        some = np.flatnonzero(there[ci] & (w[wi] >= 0))
        cs = ci[some]
        at = self.successors.find(c[cs].astype(U64) * U64(max(1, self.words.n)) + w[wi[some]].astype(U64), lo[cs], hi[cs])
        hit = at >= 0
        out[some[hit]] = self.prob[at[hit]] * -STEP
        return out


@dataclass(frozen=True)
class Model:
    level1: Level1
    hot_folder: str
    hot_files: int
    cold_folder: str
    shards: int
    cell: int            # tokens of a context's bucket, about
    discount: float
    mixed: float

    def buckets(self, v_count: np.ndarray, v_hot: np.ndarray) -> np.ndarray:
        """Into how many buckets (a power of two) a hot context's other successors are dealt; 1 otherwise."""
        need = np.ceil(np.log2(np.maximum(v_count / self.cell, 1.0))).astype(np.int64)
        return np.where(v_hot, 1 << np.minimum(need, RESIDUES.bit_length() - 1), 1)

    def cold_mass(self, b: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """p1 mass of the words of bucket b (of ``bucket`` many) that are not hot."""
        out = np.ones(len(b))
        for n in np.unique(bucket).tolist():
            of = self.level1.cold_mass.reshape(-1, n).sum(0) / self.level1.whole
            pick = bucket == n
            out[pick] = np.maximum(of[b[pick]], 1.0 / self.level1.whole)
        return out


def cells(v: np.ndarray, bucket: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The key of a context, or of a bucket of a hot context."""
    return T.mix(v + (bucket + many * 65536).astype(U64) * U64(0x9E3779B97F4A7C15))


@functools.lru_cache(maxsize=4096)
def _hot_trie(path: str) -> Trie:
    return Trie(get(path))


def hot_level(rows: DataFrame, one: Level1, folder: str, files: int, modulus: int, rest: int, discount: float, mixed: float) -> None:
    """Count the pairs of hot words and write their part of level two, cut by context."""
    size, start = len(one.hot), int(one.hot_places(np.array([START]))[0])

    def count(batches):
        for batch in batches:
            for part in T.chunks(batch, "text"):
                w, row, first = tokens(part)
                place = one.hot_places(w)
                key = np.where(place >= 0, before(place, first, start) * size + place, -1)
                train = ~held_out(part.column(0), modulus, rest)
                u, c = np.unique(key[(key >= 0) & train[row]], return_counts=True)  # a context that is not hot: below 0
                if len(u):
                    a, b = one.hot[u // size], one.hot[u % size]
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(c)], names=["v", "w", "c"])

    def save(batches):
        held: dict[int, list] = {}
        for batch in batches:
            part = batch.column(0).to_numpy()
            for k in np.unique(part).tolist():
                pick = part == k
                held.setdefault(k, []).append([batch.column(i).to_numpy()[pick] for i in (1, 2, 3)])
        for k, own in held.items():
            v, w, c = (np.concatenate(x) for x in zip(*own))
            order = np.lexsort((w.view(U64), v.view(U64)))
            put(f"{folder}/{k}", hot_parts(one, v.view(U64)[order], w.view(U64)[order], c[order], discount, mixed))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32())], names=["k"])

    pairs = rows.mapInArrow(count, "v long, w long, c long").groupBy("v", "w").agg(F.sum("c").alias("c"))
    dealt = pairs.select(F.col("v").bitwiseAND(F.lit(files - 1)).cast("int").alias("k"), "v", "w", "c").repartition(files, "k")
    there = {r.k for r in dealt.mapInArrow(save, "k int").collect()}  # numbers of files
    z = np.zeros(0, U64)
    for k in set(range(files)) - there:
        put(f"{folder}/{k}", hot_parts(one, z, z, np.zeros(0, np.int64), discount, mixed))


def hot_parts(one: Level1, v: np.ndarray, w: np.ndarray, c: np.ndarray, discount: float, mixed: float) -> dict[str, np.ndarray]:
    count = lambda x: one.hot_counts[np.searchsorted(one.hot, x)] if len(x) else np.zeros(0, np.int64)
    mass = (one.hot_counts[one.hot != START] + 1).sum() / one.whole
    return Trie.build(v, w, c, count(v), (count(w) + 1) / one.whole, np.full(len(v), mass), discount, mixed)


def hot_logs(model: Model, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Logarithms for distinct pairs of hot words, given by their places."""
    one = model.level1
    out = np.zeros(len(v))
    part = (one.hot[v] & U64(model.hot_files - 1)).astype(np.int64)
    for k in np.unique(part).tolist():
        pick = part == k
        (uv, ci), (uw, wi) = np.unique(v[pick], return_inverse=True), np.unique(w[pick], return_inverse=True)
        p1 = (one.hot_counts[uw] + 1) / one.whole
        out[pick] = _hot_trie(f"{model.hot_folder}/{k}").logs(one.hot[uv], one.hot[uw], p1, np.full(len(uv), np.log10(model.mixed)), ci, wi)
    return out


# ---- scoring ----

PACKED = "shard int, pid int, data binary"
FINAL = "n_tokens long, n_known long, base_score double, score double"


def _save(**arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pack(arrays))


def _load(data: bytes) -> dict[str, np.ndarray]:
    return unpack(zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 32))


def _small(values: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as they need."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def packed(model: Model, train: np.ndarray, v: np.ndarray, w: np.ndarray, b: np.ndarray, many: np.ndarray, row: np.ndarray, pid: int):
    """The tokens of a chunk that need a shard, one packet for each shard: tables of contexts and words, and numbers into them."""
    cell = cells(v, b.astype(np.int64), many.astype(np.int64))
    order = np.argsort(cell, kind="stable")  # by shard, and rows ascending within a cell
    shard = (((cell >> U64(32)) * U64(model.shards)) >> U64(32)).astype(np.int64)
    edges = np.searchsorted(shard[order], np.arange(model.shards + 1))
    for k in np.flatnonzero(np.diff(edges)).tolist():
        own = order[edges[k]:edges[k + 1]]
        c = cell[own]
        new = np.concatenate([[True], c[1:] != c[:-1]])
        at = own[new]
        words, number = np.unique(w[own], return_inverse=True)
        yield k, pid, _save(v=v[at], b=_small(b[at]), many=_small(many[at]), runs=_small(np.diff(np.concatenate([np.flatnonzero(new), [len(own)]]))),
                            words=words, w=_small(number), row=_small(row[own]), train=np.packbits(train[own]))


def shard_scores(model: Model, packets: list[tuple[int, bytes]], shard: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(pid, rows, sums of logarithms) of a shard: its levels are built, written, mapped and searched."""
    one = model.level1
    loaded = [_load(data) for _, data in packets]
    sizes = [len(x["w"]) for x in loaded]
    v, b, many = (np.concatenate([np.repeat(x[c], x["runs"]) for x in loaded]) for c in ("v", "b", "many"))
    w = np.concatenate([x["words"][x["w"]] for x in loaded])
    train = np.concatenate([np.unpackbits(x["train"], count=len(x["w"])).astype(bool) for x in loaded])
    uc, at, ci = np.unique(cells(v, b.astype(np.int64), many.astype(np.int64)), return_index=True, return_inverse=True)
    v, b, many = v[at], b[at].astype(np.int64), many[at].astype(np.int64)
    uw, wi = np.unique(w, return_inverse=True)
    del w
    p1 = (one.counts(uw) + 1) / one.whole
    pair, which = np.unique(ci * len(uw) + wi, return_inverse=True)
    del ci, wi
    ci, wi = pair // max(1, len(uw)), pair % max(1, len(uw))
    count = np.bincount(which, weights=train, minlength=len(pair)).astype(np.int64)
    sv, inverse = np.unique(v, return_inverse=True)
    total = one.counts(sv)[inverse]
    mass, split = np.ones(len(uc)), np.flatnonzero(many > 0)  # many: 0 for a context that is not hot
    mass[split] = model.cold_mass(b[split], many[split])
    t = np.flatnonzero(count > 0)
    path = f"{model.cold_folder}/{shard}"
    put(path, Trie.build(uc[ci[t]], uw[wi[t]], count[t], total[ci[t]], p1[wi[t]], mass[ci[t]], model.discount, model.mixed))
    absent = np.where(many > 0, np.log10(model.mixed), 0.0)
    logs = Trie(get(path)).logs(uc, uw, p1, absent, ci, wi)[which]
    out, end = [], 0
    for (pid, _), x, n in zip(packets, loaded, sizes):
        rows, number = np.unique(x["row"], return_inverse=True)
        out.append((pid, rows, np.bincount(number, weights=logs[end:end + n], minlength=len(rows))))
        end += n
    return out


def train_and_score(docs: DataFrame, modulus: int = 7, rest: int = 2, discount: float = 0.75, mixed: float = 0.001, hot_words: int = HOT_WORDS,
                    tokens_per_shard: int = 2_000_000, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    folder = f"{work_dir(spark, 'lm')}/trie"
    one = level1(rows, f"{folder}/one", modulus, rest, hot_words)
    files = 1 << max(0, (one.n // 500_000_000).bit_length())
    hot_level(rows, one, f"{folder}/hot", files, modulus, rest, discount, mixed)
    shards = max(1, -(-(one.n * modulus) // (max(1, modulus - 1) * tokens_per_shard)))
    model = Model(one, f"{folder}/hot", files, f"{folder}/two", shards, max(1, tokens_per_shard // 4), discount, mixed)
    sent = spark.sparkContext.broadcast(model)  # HOT_WORDS and RESIDUES numbers

    def send(m, columns, pid):
        whole = [np.concatenate(x) for x in zip(*columns)]
        columns.clear()
        packets = list(packed(m, *whole, pid))
        for at in range(0, len(packets), 64):
            yield _packets(packets[at:at + 64])

    def tokenise(batches):
        m, pid, base = sent.value, TaskContext.get().partitionId(), 0
        held_back: list[tuple] = []  # columns of tokens that need a shard
        size, start = len(m.level1.hot), int(m.level1.hot_places(np.array([START]))[0])
        for batch in batches:
            for part in T.chunks(batch, "text", CHUNK_BYTES):
                w, row, first = tokens(part)
                held = held_out(part.column(0), modulus, rest)
                uw, wi = np.unique(w, return_inverse=True)
                c, place = m.level1.counts(uw)[wi], m.level1.hot_places(uw)[wi]
                del uw, wi
                n = part.num_rows
                tok = np.bincount(row, minlength=n)
                v_place = before(place, first, start)
                vh = v_place >= 0
                both = vh & (place >= 0)
                pair, which = np.unique(v_place[both] * size + place[both], return_inverse=True)
                logs = hot_logs(m, pair // size, pair % size)[which]
                partial = np.bincount(row[both], weights=logs, minlength=n).astype(np.float64)
                whole = part.column(0)
                said = pa.RecordBatch.from_arrays([
                    pa.array(np.arange(base, base + n)), whole, pa.array(held), pa.array(tok), pa.array(np.bincount(row, weights=c > 0, minlength=n).astype(np.int64)),
                    pa.array(np.bincount(row, weights=np.log10(c + 1.0), minlength=n) - tok * np.log10(m.level1.whole)), pa.array(partial)],
                    names=["row", "id", "held_out", "n_tokens", "n_known", "base_score", "score"])
                sink = io.BytesIO()
                with pa.ipc.new_stream(sink, said.schema) as out:
                    out.write_batch(said)
                cold = np.flatnonzero(~both)
                v, vc = before(w, first, START)[cold], before(c, first, m.level1.starts)[cold]
                many = m.buckets(vc, vh[cold])
                bucket = (w[cold] & (many - 1).astype(U64)).astype(np.int64)
                held_back.append((~held[row[cold]], v, w[cold], bucket.astype(np.uint16), np.where(vh[cold], many, 0).astype(np.uint16),
                                  (row[cold] + base).astype(np.uint32)))
                yield _packets([(-1 - pid, pid, sink.getvalue())])
                base += n
                if sum(len(x[0]) for x in held_back) >= PACK_TOKENS:
                    yield from send(m, held_back, pid)
                    held_back = []
        if held_back:
            yield from send(m, held_back, pid)

    def score(batches):
        """Packets by shard; those of the documents themselves (negative shards) pass."""
        m, held, current = sent.value, [], None

        def flush():
            return [(-1, pid, _save(row=r, score=s)) for pid, r, s in shard_scores(m, held, current)] if held else []

        for batch in batches:
            out = []
            for k, pid, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if k < 0:
                    out.append((-2, pid, data))
                    continue
                if k != current:
                    out += flush()
                    held, current = [], k
                held.append((pid, data))
            if out:
                yield _packets(out)
        if out := flush():
            yield _packets(out)

    def total(batches):
        """Sum what came back for each task's documents."""
        docs_of, scores, current = [], [], None

        def flush():
            if not docs_of:
                return None
            t = pa.Table.from_batches([pa.ipc.open_stream(d).read_all().combine_chunks().to_batches()[0] for d in docs_of]).combine_chunks()
            row = t["row"].to_numpy()
            got = t["score"].to_numpy().copy()
            low = int(row.min())
            place = np.full(int(row.max()) - low + 1, -1)
            place[row - low] = np.arange(len(row))
            for d in scores:
                x = _load(d)
                got[place[x["row"].astype(np.int64) - low]] += x["score"]
            return t.set_column(t.schema.get_field_index("score"), "score", pa.array(got)).drop_columns(["row"]).to_batches()[0]

        for batch in batches:
            for k, pid, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if pid != current:
                    if (out := flush()) is not None:
                        yield out
                    docs_of, scores, current = [], [], pid
                (docs_of if k == -2 else scores).append(data)
        if (out := flush()) is not None:
            yield out

    kind = rows.schema["id"].dataType.simpleString()
    sent_rows = rows.mapInArrow(tokenise, PACKED).repartition("shard").sortWithinPartitions("shard")
    back = sent_rows.mapInArrow(score, PACKED).repartition("pid").sortWithinPartitions("pid")
    out = back.mapInArrow(total, f"id {kind}, held_out boolean, {FINAL}")
    return out.select(F.col("id").alias(key), "held_out", "n_tokens", "n_known", F.lit(one.n).cast("long").alias("train_tokens"), "base_score", "score")


def _packets(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    a, b, d = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(d, pa.binary())], names=["shard", "pid", "data"])
