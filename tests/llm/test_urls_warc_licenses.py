import base64
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loglynx.llm import licenses, urlfilter, warc
from loglynx.llm.queries import URL_RULES
from loglynx.session import work_dir

from .helpers import DATA, LOWER, odd_documents

URLS = ["http://www.example.com/en/x?q=1", "https://a.WWW.Example.COM/en/", "http://example.com/en", "http://example.com/en/", "http://example.com",
        "ftp://x.net/es/a#b", "http://x.net/es", "http://net/fr/", "http://.net/fr/x", "http://www.example.org/en/", "no scheme", "", None,
        "x://COM/?://net/fr/", "http://com:80/", "http://comé/", "a://b\nc.com/d\ne", "http://example.com//en/", "http://com./", "http://notexample.com/en/"]


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut].translate(LOWER), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fit = [(len(h.split(".")), len(p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit) if fit else None
    return host, path, best and best[3], best[2] if best else "allow"


def random_rules(n):
    rnd = random.Random(1)
    hosts = ["com", "net", "a.com", "b.a.com", "c.b.a.com", "x.net", "y.x.net"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/a", "/en/a/", "/en/ab", "/f/g/h", "/f/g/"]
    return [(rnd.choice(["allow", "block"]), rnd.choice(hosts), rnd.choice(paths)) for _ in range(n)], hosts, paths, rnd


@pytest.mark.parametrize("limit", [1000, 0])
def test_url_rules_against_brute_force(spark, limit):
    pages = spark.createDataFrame([(i, u, "h", 5) for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, _id int")
    out = urlfilter.judge(pages, URL_RULES, max_trie_rules=limit).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out) == Counter((i, *brute(u, URL_RULES)) for i, u in enumerate(URLS * 2))
    rules, hosts, paths, rnd = random_rules(60)
    urls = [f"http://{rnd.choice(['', 'q.', 'b.'])}{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', 'z', '/', '/a', 'a/b'])}" for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    listed = spark.createDataFrame(rules, "verdict string, host string, path string")
    out = urlfilter.judge(df, listed, max_trie_rules=limit).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in out} == {i: brute(u, rules)[2:] for i, u in enumerate(urls)}
    assert urlfilter.judge(pages.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages, []).collect()} == {"allow"}


def brute_warc(rows, least):
    top, out = {}, Counter()
    for i, h in rows:
        b = (h or "").encode()
        if i is not None and len(b) >= least:
            top[b] = max(top.get(b, i), i)
    for i, h in rows:
        b = (h or "").encode()
        sha = base64.b32encode(hashlib.sha1(b).digest()).decode()
        t = top.get(b)
        out[(i, len(b), sha, *(("response", None) if t is None or t == i else ("revisit", t)))] += 1
    return out


@pytest.mark.parametrize("least", [0, 5])
def test_warc_round_trip(spark, least, monkeypatch):
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "WARC/1.1\r\n\r\nnot a record"), (6, "é\u2028\x00\r\n\r\nWARC/1.1"), (7, "long " * 400000),
            (8, "long " * 400000), (None, "a"), (None, "b"), (9, "same"), (9, "same"), (10, "same"), (11, "equal payload"), (12, "equal payload")]
    pages = spark.createDataFrame([(i, f"http://x/{i} é\r\n" if i != 4 else None, h, 1) for i, h in rows], "page_id long, url string, html string, sha int")
    cols = lambda df: Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())
    assert cols(warc.round_trip(pages, min_bytes=least)) == brute_warc(rows, least)
    monkeypatch.setattr(warc, "MAX_BROADCAST_DIGESTS", -1)
    assert cols(warc.round_trip(pages, min_bytes=least)) == brute_warc(rows, least)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_pushdown_splits_and_verification(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    path = f"{work_dir(spark, 'warc-test')}/a"
    warc.write(warc.deduplicated(pages.unionAll(pages.withColumn("page_id", F.col("page_id") + 100000))), path, max_file_bytes=20000)
    n = pages.count()
    back = warc.read(spark, path, payload="none", split_bytes=7000)
    assert back.rdd.getNumPartitions() > 3 and back.count() == 2 * n
    revisits = back.where("record_type = 'revisit'")
    plan = revisits._jdf.queryExecution().executedPlan().toString()
    assert "record_type" not in plan.split("Filter")[-1] or "Filter (" not in plan  # the source has taken the predicate
    assert revisits.count() == n and revisits.where("payload is not null").count() == 0
    one = warc.read(spark, path).where("record_id = 'urn:page:100003'").collect()
    want = pages.where("page_id = 3").first()
    assert [bytes(r.payload) for r in one] == [want.html.encode()]
    assert warc.read(spark, path).where("payload_bytes > 10 and record_type in ('response', 'x')").count() == n
    # files without index or manifest are read in sequence; a wrong digest is found
    import glob
    import gzip
    import os
    other = f"{work_dir(spark, 'warc-test')}/b"
    os.makedirs(other.replace("file:", ""), exist_ok=True)
    raw = b"".join(gzip.open(f).read() for f in sorted(glob.glob(path.replace("file:", "") + "/*.gz")))
    with open(other.replace("file:", "") + "/x.warc", "wb") as f:
        f.write(raw)
    assert warc.read(spark, other).count() == 2 * n
    assert warc.read(spark, other, payload="none").where("record_type = 'response'").count() == n
    with open(other.replace("file:", "") + "/x.warc", "wb") as f:
        f.write(raw.replace(b"<title>", b"<tITle>", 1))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read(spark, other).count()


MIT = ("MIT License\n\nCopyright (c) 2020 Someone\n\n" + licenses.SENTENCES["mit-grant"].replace("deal in", "deal\nin") + ":\n\n"
       + licenses.SENTENCES["mit-notice"] + ".\n\n" + licenses.SENTENCES["mit-as-is"].replace("KIND, ", "KIND,\n") + ". IN NO EVENT.")


def test_licences(spark):
    texts = [MIT, "x\nReleased under the MIT License.", "Licensed under CC BY-NC 4.0.\nfoo. Licensed under the Apache License, Version 2.0!", None, "", "license",
             "# SPDX-License-Identifier: MIT\ncode", "released UNDER the mit license", "Not released under the MIT License.", "Released under the MIT License.\n" * 3,
             "word " * 50000 + "\nThis work is licensed under the GNU General Public License, version 3."]
    docs = spark.createDataFrame([(i if i else None, t, "r", 1) for i, t in enumerate(texts)], "doc_id int, text string, rule string, a int")
    got = Counter((r.doc_id, r.rule, r.license, r.n_sentences) for r in licenses.scan(docs).collect())
    assert got == Counter([(None, "mit-text-2", "MIT", 4), (1, "mit-released", "MIT", 1), (2, "cc-by-nc-4.0", "CC-BY-NC-4.0", 1),
                           (2, "apache-2.0-licensed", "Apache-2.0", 1), (6, "spdx-mit", "MIT", 1), (7, "mit-released", "MIT", 1), (9, "mit-released", "MIT", 1),
                           (10, "gpl-3.0-work", "GPL-3.0", 1)])
    assert licenses.scan(docs.limit(0)).count() == 0 and licenses.scan(odd_documents(spark)).count() == 0
    with pytest.raises(ValueError, match="keyword"):
        licenses.scan(docs, {"a": "plain words"}, [("r", "L", ["a"])])
