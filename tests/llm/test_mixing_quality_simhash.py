import os
import re
from collections import Counter

import numpy as np
import xxhash

from loglynx.llm import mixing, quality, simhash

from .helpers import DATA, LOWER, WORD, documents, odd_documents


def water_fill(sizes, weights, cap):
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = {s: w for s, w in weights.items() if s not in fixed}
        left = total - sum(fixed.values())
        share = {s: left * w / sum(rest.values()) for s, w in rest.items()} if rest else {}
        over = {s: cap * sizes[s] for s in share if share[s] > cap * sizes[s]}
        if not over:
            return fixed | share
        fixed |= over


def check_mix(docs):
    got = mixing.plan_mix(docs).collect()
    assert len(got) == docs.count()
    sizes, largest, taken = Counter(), Counter(), Counter()
    for r in got:
        sizes[r.source] += r["size"]
        largest[r.source] = max(largest[r.source], r["size"])
        taken[r.source] += r.taken
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = water_fill(sizes, {s: i % 3 + 1 for i, s in enumerate(order)}, 3)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    assert sorted(map(str, mixing.plan_mix(docs.repartition(7)).collect())) == sorted(map(str, got))
    return got


def test_mix_odd_rows_and_targets(spark):
    got = check_mix(odd_documents(spark))
    assert {r["size"] for r in got if r.doc_id in (3, 4, 6)} == {0}
    check_mix(documents(spark))


def test_mix_emits_the_planned_copies(spark):
    docs = odd_documents(spark)
    out = mixing.mix(docs)
    assert out.columns == docs.columns + ["copy"]
    want = Counter()
    for r in mixing.plan_mix(docs).collect():
        want[(r.doc_id, r.source)] += r.copies
    assert Counter((r.doc_id, r.source) for r in out.collect()) == +want


def test_mix_empty(spark):
    empty = odd_documents(spark).limit(0)
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return dict(n_words=len(words), word_chars=sum(map(len, words)), n_symbols=sum(text.count(c) for c in "#*$%&|<>"),
                n_dup_lines=dup, n_repeat_words=len(covered),
                base_failed=len(words) < 10 or 100 * len(covered) > 20 * len(words))


def brute_fertility(text, rules, model, ranks):
    sp, is_byte = quality._pieces(model)
    enc = quality._ranks(ranks)
    words = WORD.findall(text or "")
    toks = [t for w in words for t in sp.encode(w)]
    chars = sum(map(len, words))
    n = Counter(toks)
    p = np.array(list(n.values())) / max(1, len(toks))
    h = -(p * np.log2(p)).sum() / np.log2(min(len(toks), sp.vocab_size())) if len(toks) > 1 else 1.0
    return (chars / len(toks), chars / sum(len(enc.encode_ordinary(w)) for w in words),
            sum(bool(is_byte[t]) for t in toks) / len(toks), h) if toks else None


def check_quality(docs):
    rules = quality.Rules()
    model, ranks = quality.vocabularies(rules)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    rows = quality.assess(docs).collect()
    for r in rows:
        cand = [brute_quality(t) for t in texts[r.doc_id]]
        own = {k: r[k] for k in cand[0]}
        assert own in cand
        t = texts[r.doc_id][cand.index(own)]
        want = brute_fertility(t, rules, model, ranks)
        if want is None:
            assert r.token_entropy is None and r.chars_per_token is None and not r.kept
            continue
        got = (r.chars_per_token, r.chars_per_rank, r.byte_share, r.token_entropy)
        assert np.allclose(got, want), (r.doc_id, got, want)
        band = rules.bands[r.band]
        give = [rules.slack / r.n_words] * 2 + [0, 0]
        assert r.kept == (not r.base_failed and all(lo - x <= g <= hi for g, (lo, hi), x in zip(got, band, give)))
    assert len(rows) == docs.count()
    return rows


def test_quality_against_brute_force(spark):
    check_quality(odd_documents(spark))
    rows = check_quality(documents(spark))
    assert sum(r.kept for r in rows) > 0.8 * len(rows)


LARGER = os.path.join(os.path.dirname(DATA), "sf0.01")


def test_quality_separates_junk_from_good_texts(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{x}.parquet") for x in ("documents", "labels"))
    rows = quality.assess(docs).where("not base_failed").join(labels, "doc_id").join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    for lang in ("de", "en", "es", "fr"):
        good = [r.kept for r in rows if r.lang == lang and r.quality == 1]
        assert sum(good) >= 0.95 * len(good) > 0, lang
        junk = [r.kept for r in rows if r.lang == lang and 10 * len(re.findall(r"([#*$%&|<>])\1\1", r.text)) > 3 * r.n_words]
        assert sum(junk) <= 0.1 * len(junk), (lang, len(junk))


def test_quality_bands_are_fitted(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{x}.parquet") for x in ("documents", "labels"))
    wide = quality.Rules(bands=quality.BANDS | {x: quality.LATIN for x in ("de", "en", "es", "fr")})
    bands = quality.fit_bands(docs.where("doc_id % 2 = 0"), labels, wide, loss=0.02, min_rows=20)
    assert bands["han"] == quality.BANDS["han"] and bands["en"][2:] == quality.LATIN[2:] and bands["en"][0][0] > 1.9
    rest = quality.assess(docs.where("doc_id % 2 = 1"), quality.Rules(bands=bands)).where("not base_failed").join(labels, "doc_id").collect()
    good, bad = [r.kept for r in rest if r.quality == 1], [r.kept for r in rest if r.quality == 0]
    assert sum(good) >= 0.9 * len(good) and sum(bad) <= 0.4 * len(bad)
    assert quality.fit_bands(docs.limit(0), labels) == quality.BANDS


def test_quality_small_chunks(spark, monkeypatch):
    docs = documents(spark).limit(50)
    want = sorted(map(str, quality.assess(docs).collect()))
    rules = quality.Rules()
    model, ranks = quality.vocabularies(rules)
    import pyarrow as pa

    from loglynx.llm import text as T
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in docs.collect()])
    n = sum(int(quality.measure(p, "text", "lang", rules, model, ranks)["kept"].sum()) for p in T.chunks(batch, "text", 1000))
    assert n == sum("kept=True" in x for x in want)


def test_quality_keep(spark):
    docs = odd_documents(spark)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in quality.assess(docs).where("kept").collect())
    assert quality.keep(docs.limit(0)).count() == 0


def brute_fingerprint(text, k=4):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, t=4):
    n, root = len(fps), list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    arr = np.array(fps, np.uint64)
    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= t):
            root[find(int(j))] = find(i)
    low = {}
    for i in range(n):
        if ids[i] is not None:
            low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return [low.get(find(i)) for i in range(n)]


def check_simhash(docs):
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    comp = brute_components([r.doc_id for r in rows], fps)
    want = Counter((r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, comp))
    got = simhash.near_duplicates(docs)
    assert Counter(map(tuple, got.collect())) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    n_groups = len(set(zip(comp, (f if c is None else 0 for f, c in zip(fps, comp)))))
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == n_groups and set(ids) == set(comp)


def test_simhash_against_brute_force(spark):
    check_simhash(odd_documents(spark))
    check_simhash(documents(spark))
    assert simhash.near_duplicates(odd_documents(spark).limit(0)).count() == 0


def test_simhash_links_lose_nothing(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    fps = list(base)
    for x in base[:60]:  # chains and dense balls
        y = x
        for _ in range(40):
            y ^= np.uint64(1) << np.uint64(rng.integers(64))
            fps.append(y)
    for _ in range(600):
        z = base[0]
        for b in rng.choice(64, 2, replace=False):
            z ^= np.uint64(1) << np.uint64(b)
        fps.append(z)
    fps = [int(x) for x in fps]
    df = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in enumerate(fps)], "doc_id long, fp long")
    for t in (1, 4):
        got = {r.fp: r.component_id for r in simhash.classes(df, t).collect()}
        want = brute_components(list(range(len(fps))), fps, t)
        assert [got[int(np.uint64(f).view(np.int64))] for f in fps] == want
