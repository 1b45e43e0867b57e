import hashlib
from collections import Counter

import numpy as np
import pytest

from loglynx.llm import runindex as R

from .helpers import documents, odd_documents


def brute_removed(texts, length):
    """Per text the boolean cover of strings that start at two or more places."""
    seen = Counter()
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] += 1
    out = []
    for t in texts:
        cover = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                cover[i:i + length] = True
        out.append(cover)
    return out


def expected(rows, length):
    texts = [(r.text or "").encode() for r in rows]
    out = Counter()
    for r, t, cover in zip(rows, texts, brute_removed(texts, length)):
        edge = np.diff(np.concatenate([[0], cover.astype(int), [0]]))
        kept = bytes(np.frombuffer(t, np.uint8)[~cover]) if t else b""
        out[(r.doc_id, len(t), int(cover.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest())] += 1
    return out


def found(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_suffix_array_and_statistics():
    rng = np.random.default_rng(3)
    for t in (b"", b"a", b"banana", b"a" * 300, b"ab" * 100, b"\0\0\0", b"\0\0\0\0\0\0\0\0\0\0", bytes(rng.integers(0, 3, 2000).tolist()),
              bytes(rng.integers(97, 100, 300).tolist()) * 5 + b"x" + b"abc" * 40):
        x = np.frombuffer(t, np.uint8)
        sa = R.suffix_array(x)
        order = sorted(range(len(t)), key=lambda i: t[i:])
        assert sa.tolist() == order
        index = R.RunIndex.build(x)
        assert index.lengths.sum() == len(t)
        lcp = [0] * (len(t) + 1)
        for a in range(1, len(t)):
            i, j = order[a - 1], order[a]
            while i + lcp[a] < len(t) and j + lcp[a] < len(t) and t[i + lcp[a]] == t[j + lcp[a]]:
                lcp[a] += 1
        want = np.zeros(len(t), int)
        for a, i in enumerate(order):
            want[i] = max(lcp[a], lcp[a + 1])
        assert index.statistics().tolist() == want.tolist()


def test_anchors_depend_on_the_string_alone():
    rng = np.random.default_rng(4)
    common = rng.integers(97, 123, 400).astype(np.uint8)
    a = np.concatenate([rng.integers(97, 123, 517).astype(np.uint8), common, rng.integers(97, 123, 90).astype(np.uint8)])
    b = np.concatenate([rng.integers(97, 123, 33).astype(np.uint8), common, rng.integers(97, 123, 700).astype(np.uint8)])
    (pa_, ha), (pb, hb) = R.anchors(a, 400, 256), R.anchors(b, 400, 256)
    shared = set(zip(ha.tolist(), (pa_ - 517).tolist())) & set(zip(hb.tolist(), (pb - 33).tolist()))
    assert any(0 <= p <= 144 for _, p in shared)


def rows_with_repeats():
    rng = np.random.default_rng(7)
    word = lambda n: "".join(map(chr, rng.integers(97, 117, n)))
    passage = word(61)
    texts = [word(int(rng.integers(0, 90))) + passage[int(rng.integers(0, 20)):int(rng.integers(35, 61))] + word(int(rng.integers(0, 90))) for _ in range(60)]
    near = list(word(400))
    for _ in range(30):
        near[int(rng.integers(400))] = "é"
        texts.append("".join(near))
    texts += [texts[0], texts[0], "z" * 200, "yx" * 80, None, "", word(15), texts[70][:100] + texts[71][100:150] + texts[72]]
    return [(i if i % 9 else None, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("options", [{}, {"max_broadcast": 0}, {"max_classes": 3}, {"max_classes": 0}, {"max_classes": 0, "max_aligned": 3}])
def test_removal_against_brute_force(spark, options):
    df = spark.createDataFrame(rows_with_repeats(), "doc_id long, text string").repartition(3)
    got = R.remove_repeats(df, length=24, anchor=12, **options)
    assert found(got) == expected(df.collect(), 24)


def test_documents_and_odd_rows(spark):
    docs = documents(spark)
    assert found(R.remove_repeats(docs)) == expected(docs.collect(), 400)
    odd = odd_documents(spark)
    short = odd.where("doc_id is null or doc_id <> 5")
    assert found(R.remove_repeats(short, length=40, anchor=20)) == expected(short.collect(), 40)
    r = R.remove_repeats(odd).where("doc_id = 5").first()
    assert r.n_removed == r.n_bytes and r.n_spans == 1
    assert R.remove_repeats(odd.limit(0)).count() == 0
