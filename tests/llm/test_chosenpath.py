"""The chosen-path join against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from loglynx.llm import chosenpath
from tests.llm.helpers import DATA, LOWER, WORD, documents, odd_documents


def shingles(text, k=4):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, percent=80):
    """[(id, n, component, kept)] of (id, text) rows, sets joined pair by pair."""
    sets = [shingles(t) for _, t in rows]
    distinct = list({s for s in sets if s})
    parent = {s: s for s in distinct}

    def find(s):
        while parent[s] != s:
            s = parent[s]
        return s
    holders = {}
    for s in distinct:
        for t in s:
            holders.setdefault(t, []).append(s)
    done = set()
    for s in distinct:
        for o in {o for t in s for o in holders[t]}:
            if o is not s and (id(o), id(s)) not in done:
                done.add((id(s), id(o)))
                both = len(s & o)
                if 100 * both >= percent * (len(s) + len(o) - both):
                    parent[find(s)] = find(o)
    low = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            r = find(s)
            low[r] = min(low.get(r, i), i)
    out = [(i, len(s), low.get(find(s)) if s else i) for (i, _), s in zip(rows, sets)]
    return sorted(map(repr, [(i, n, c, i == c) for i, n, c in out]))


def got(df):
    return sorted(map(repr, map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect())))


def test_given_documents(spark):
    docs = documents(spark)
    assert got(chosenpath.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(chosenpath.near_duplicates(docs)) == brute(rows)
    empty = chosenpath.near_duplicates(docs.where("false"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    # one id with different texts, null ids among the linked
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split()
    rows = [(1, " ".join(text)), (1, "other words " * 9), (None, " ".join(text + ["more"])), (5, " ".join(text[1:])), (None, None), (7, "")]
    assert got(chosenpath.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def families(seed, words=120):
    """Hubs with spokes that are near the hub but not each other, chains, dense groups, and texts that share a passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10 ** 6)}"
    texts = []

    def edited(t, n):
        t = list(t)
        for i in rng.sample(range(len(t)), n):
            t[i] = word()
        return t
    for _ in range(4):
        hub = [word() for _ in range(words)]
        texts += [hub] + [edited(hub, 2) for _ in range(25)] + [edited(hub, 3) for _ in range(25)]
    chain = [word() for _ in range(words)]
    for _ in range(30):
        chain = edited(chain, 3)
        texts.append(chain)
    dense = [word() for _ in range(words)]
    texts += [dense[:-1] + [word()] for _ in range(60)]
    passage = [word() for _ in range(words // 2)]
    texts += [passage + [word() for _ in range(words // 2)] for _ in range(40)]
    texts += [[word() for _ in range(words)] for _ in range(60)]
    rows = [" ".join(t) for t in texts]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("local,work,small", [(1 << 14, 1 << 31, 384), (40, 1 << 31, 8), (1 << 14, 20_000, 384)])
def test_every_way_finds_the_same(spark, monkeypatch, local, work, small):
    """Inside a task, by distributed levels, and with clusters too large for one exact search."""
    monkeypatch.setattr(chosenpath, "SMALL", small)
    rows = families(local + work)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(chosenpath.near_duplicates(df, local=local, work=work)) == brute(rows)


def test_recall_of_single_links(spark):
    """Pairs just above the similarity, with no other member to connect them."""
    rng = random.Random(4)
    rows = []
    for i in range(300):
        t = [f"x{rng.randrange(10 ** 7)}" for _ in range(200)]
        at = rng.sample(range(10, 190, 8), 5)
        rows += [(2 * i, " ".join(t)), (2 * i + 1, " ".join("new" if j in at else w for j, w in enumerate(t)))]  # (197 - 20) / (197 + 20)
    found = chosenpath.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.where("not kept").count() >= 297


def test_branching_is_what_the_docstring_says():
    node = np.arange(1, 200_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    one, two, second = chosenpath.slots_of(node, 80)
    assert (one != two).all() and abs(1 + second.mean() - 1.25) < 0.005
    assert chosenpath.least_equal(80) == 84 and DATA


def test_group_larger_than_a_task_is_linked_through_its_origin(spark):
    """Copies that are near the text they were made from, and mostly not near each other, in a group that is branched again."""
    rng = random.Random(5)
    word = lambda letters: "".join(rng.choices(letters, k=5))
    base = [word("abcdefgh") for _ in range(120)]
    cut4 = lambda w: {tuple(w[i:i + 4]) for i in range(len(w) - 3)}
    rows, own = [(0, " ".join(base))], cut4(base)
    while len(rows) < 400:
        copy = list(base)
        for at in rng.sample(range(4, 116), 3):
            copy[at] = word("qrstuvw")
        if 100 * len(own & cut4(copy)) >= 80 * len(own | cut4(copy)):
            rows.append((len(rows), " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = chosenpath.near_duplicates(docs, local=60, work=20 * 117 * 20).collect()
    assert {r.component_id for r in found} == {0}
