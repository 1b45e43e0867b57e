import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from loglynx.llm import lm
from loglynx.llm.eliasfano import Sequence, pack, unpack

from .helpers import LOWER, WORD, documents, odd_documents


@pytest.mark.parametrize("values", [[], [0], [5, 5, 9], [0, 1, 2, 3], [2**64 - 1], [0, 2**63, 2**64 - 1], list(range(0, 100000, 7))])
def test_elias_fano(values):
    s = Sequence.build(np.array(values, np.uint64))
    s = Sequence.of(unpack(pack(s.parts("x"))), "x")
    assert s.get(np.arange(len(values))).tolist() == values
    rng = np.random.default_rng(1)
    asked = np.concatenate([np.array(values[:2000], np.uint64), rng.integers(0, 2**64 - 1, 500, dtype=np.uint64), rng.integers(0, 110000, 500, dtype=np.uint64)])
    assert s.successor(asked).tolist() == np.searchsorted(np.array(values, np.uint64), asked).tolist()
    here = set(values)
    found = s.find(asked).tolist()
    assert all((f >= 0 and values[f] == a) if a in here else f == -1 for f, a in zip(found, asked.tolist()))


def test_elias_fano_random_and_ranges():
    rng = np.random.default_rng(2)
    v = np.sort(rng.integers(0, 1 << 40, 5000, dtype=np.uint64))
    s = Sequence.build(v)
    lo = rng.integers(0, 5000, 1000)
    hi = np.minimum(lo + rng.integers(0, 900, 1000), 5000)
    x = rng.integers(0, 1 << 40, 1000, dtype=np.uint64)
    want = [int(a + np.searchsorted(v[a:b], q)) for a, b, q in zip(lo, hi, x)]
    assert s.successor(x, lo, hi).tolist() == want
    assert (s.low_bytes * 8 + 2.1 + 8 * s.high.ones.nbytes / 5000) < 64


def brute(rows, discount=0.75, mixed=0.001, hot_words=16384, cell=500000):
    """The stated probabilities from plain dictionaries."""
    toks = [[*WORD.findall((r.text or "").translate(LOWER)), None] for r in rows]  # None: the end
    held = [zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 7 == 2 for r in rows]
    c1, c2, ctx = Counter(), defaultdict(Counter), Counter()
    for t, h in zip(toks, held):
        if not h:
            c1.update(t)
            for v, w in zip(["<s> "] + t, t):
                c2[v][w] += 1
                ctx[v] += 1
    n, vocab = sum(c1.values()), len(c1)
    p1 = lambda w: (c1[w] + 1) / (n + vocab + 1)
    out = []
    for r, t, h in zip(rows, toks, held):
        base = sum(math.log10(p1(w)) for w in t)
        out.append((r.doc_id, h, len(t), sum(c1[w] > 0 for w in t), n, base, t))
    return out, c1, c2, ctx, p1, n


def plain_score(t, c2, ctx, p1, discount=0.75, mixed=0.001):
    """The model without hot words, where it has its plain form."""
    s = 0.0
    for v, w in zip(["<s> "] + t, t):
        if not ctx[v]:
            s += math.log10(p1(w))
        else:
            s += math.log10((1 - mixed) * (max(c2[v][w] - discount, 0) / ctx[v] + discount * len(c2[v]) / ctx[v] * p1(w)) + mixed * p1(w))
    return s


def check_base(got, want):
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == Counter(x[:5] for x in want)
    for r in got:
        assert any(abs(r.base_score - x[5]) < 1e-6 * max(1, abs(x[5])) for x in want if x[0] == r.doc_id)


def test_scores_against_dictionaries(spark):
    docs = documents(spark)
    rows = docs.collect()
    want, _, c2, ctx, p1, _ = brute(rows)
    got = lm.train_and_score(docs, hot_words=1, tokens_per_shard=5000).collect()  # only the start mark is hot
    check_base(got, want)
    text = {x[0]: x[6] for x in want}
    for r in got:
        plain = plain_score(text[r.doc_id], c2, ctx, p1)
        # the start's successors are one bucket of words that are not hot: the same formula
        assert abs(r.score - plain) < 0.002 * r.n_tokens + 0.1, (r.doc_id, r.score, plain)


@pytest.mark.parametrize("options", [{}, {"hot_words": 300, "tokens_per_shard": 800}, {"hot_words": 20, "tokens_per_shard": 100000}])
def test_held_out_gain_and_layouts(spark, options):
    docs = documents(spark)
    want = brute(docs.collect())[0]
    got = lm.train_and_score(docs, **options).collect()
    check_base(got, want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def word_hash(w):
    from loglynx.llm import text as T
    if w is None:
        return int(lm.END)
    raw = np.frombuffer(w.encode(), np.uint8)
    return int(T.hashes(raw, np.array([0]), np.array([len(raw)]))[0])


def probability(v, w, c1, c2, ctx, p1, n, hot_words, tokens_per_shard, discount=0.75, mixed=0.001):
    """The stated probability with hot words and the buckets of hot contexts."""
    if not ctx[v]:
        return p1(w)
    hot = {x for x in c1 if c1[x] > n // hot_words}
    many = 1
    if v in hot or v == "<s> ":
        need = math.ceil(math.log2(max(ctx[v] / max(1, tokens_per_shard // 4), 1.0)))
        many = 1 << min(need, lm.RESIDUES.bit_length() - 1)
        bucket = lambda x: "hot" if x in hot else word_hash(x) % many
        mass = max(sum(p1(x) for x in c1 if bucket(x) == bucket(w)), 1 / (n + len(c1) + 1))
        kinds = sum(bucket(x) == bucket(w) for x in c2[v])
    else:
        mass, kinds = 1.0, len(c2[v])
    if not kinds:
        return mixed * p1(w)
    return (1 - mixed) * (max(c2[v][w] - discount, 0) + discount * kinds * p1(w) / mass) / ctx[v] + mixed * p1(w)


@pytest.mark.parametrize("options", [{"hot_words": 1, "tokens_per_shard": 1000}, {"hot_words": 12, "tokens_per_shard": 1000}, {"hot_words": 12, "tokens_per_shard": 16}])
def test_probabilities_of_hot_and_cold_contexts(spark, options):
    texts = ["a b a c a d", "a b b c a e f", "g a b", "a c a b a d e", "b a", "h i j k l m n o p q r s t u v w"] * 3
    vocab = sorted({w for t in texts for w in t.split()})
    probes = [f"{v} {w}" for v in ["a", "b", "c", "h", "zz"] for w in [*vocab, "unknown"]]
    train = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 7 == 2]
    df = spark.createDataFrame([(train[i], t) for i, t in enumerate(texts)] + [(held[i], p) for i, p in enumerate(probes)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm.train_and_score(df, **options).collect()}
    _, c1, c2, ctx, p1, n = brute(df.collect())
    p = lambda v, w: probability(v, w, c1, c2, ctx, p1, n, **options)
    for i, text in enumerate(probes):
        t = [*text.split(), None]
        want = sum(math.log10(p(v, w)) for v, w in zip(["<s> ", *t], t))
        assert abs(got[held[i]] - want) < 0.003, (text, got[held[i]], want)
    for v in ["<s> ", "a", "b", "c", "h", "zz"]:
        assert 1 - 1e-9 < sum(p(v, w) for w in [*c1, "unknown"]) < 1.01


def test_odd_rows(spark):
    odd = odd_documents(spark)
    want = brute(odd.collect())[0]
    got = lm.train_and_score(odd).collect()
    check_base(got, want)
    assert lm.train_and_score(odd.limit(0)).count() == 0
    only_held = odd.where("doc_id is not null").where("doc_id = 2")
    r = lm.train_and_score(only_held, modulus=1, rest=0).collect()
    assert len(r) == 2 and all(x.n_known == 0 and x.train_tokens == 0 and math.isfinite(x.score) for x in r)
