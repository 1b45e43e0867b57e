"""URL filters: a trie over reversed host labels and path segments.

A rule is (verdict, host, path).  It fits a url if the url's host is the rule's or a
subdomain of it and the url's path starts with the rule's.  Of the rules that fit, the
longest wins: the most host labels first, then the longest path; of equal rules with
different verdicts, block wins.  A url that no rule fits gets the default verdict.

The trie branches on host labels from the last to the first; every host node may have a
path trie that branches on whole segments, whose nodes hold the rules' last, possibly
partial, segments (``/en`` fits ``/english``; ``/en/`` does not).  A lookup walks down
once, remembering the deepest rule.

The trie is broadcast while the list is within ``MAX_TRIE_RULES`` (checked before it
is collected); larger lists are joined by (host, directory) keys, a few per url, and
judged by the same order.

Defined cases: null urls and urls without ``://`` have an empty host and path and get
the default verdict; empty labels and segments are labels and segments; letters outside
A-Z keep their case; repeated rows are judged alike; an empty rule list or table is fine;
other columns pass through unless they bear the name of a result column.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglynx.llm.common import free_name

MAX_TRIE_RULES = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
Rule = tuple[str, str, str]  # verdict, host, path


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


class Trie:
    """Longest match over host labels from the right, then path segments."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: list = [{}, None]  # children by label, path node
        for verdict, host, path in sorted(rules):  # allow before block: of equal rules block stays
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r}")
            node = self.root
            for label in reversed(host.split(".")):
                node = node[0].setdefault(label, [{}, None])
            node[1] = node[1] or [{}, {}]  # children by segment, rules by last piece
            *whole, last = path.split("/")
            at = node[1]
            for segment in whole:
                at = at[0].setdefault(segment, [{}, {}])
            at[1][last] = (host + path, verdict)

    @staticmethod
    def _path(at: list, path: str):
        """The rule with the longest path that ``path`` starts with."""
        best = None
        segments = path.split("/")
        for i, segment in enumerate(segments):
            for last, found in at[1].items() if len(at[1]) <= len(segment) else (
                    (segment[:k], at[1][segment[:k]]) for k in range(len(segment) + 1) if segment[:k] in at[1]):
                if segment.startswith(last) and (best is None or len(found[0]) > len(best[0])):
                    best = found
            # a rule's whole segment ends with "/": the url must have one more piece
            at = at[0].get(segment) if i + 1 < len(segments) else None
            if at is None:
                break
        return best

    def find(self, host: str, path: str):
        """(rule, verdict) or None."""
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node[0].get(label)
            if node is None:
                break
            if node[1] is not None:
                best = self._path(node[1], path) or best
        return best


def _joined(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (_id, host, path) -> (_id, rule, verdict) for large rule lists, by equi-join on (host, directory)."""
    cut_at = F.length("path") - F.length(F.element_at(F.split("path", "/"), -1))
    r = rules.select("verdict", F.col("host").alias("r_host"), F.substring(F.col("path"), F.lit(1), cut_at).alias("r_dir"),
                     F.col("path").alias("r_path")).groupBy("r_host", "r_dir", "r_path").agg(F.max("verdict").alias("verdict"))
    depth = F.size(F.split("r_dir", "/")) - 1
    deepest = r.agg(F.max(depth), F.max(F.size(F.split("r_host", r"\.")))).first()
    dirs, labels = (deepest[0] or 0), (deepest[1] or 0)
    pieces, parts = F.split("path", "/"), F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))),
                        lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."))
    tops = F.transform(F.sequence(F.lit(0), F.least(F.size(pieces) - 1, F.lit(dirs))),
                       lambda k: F.when(k == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(pieces, F.lit(1), k), "/"), F.lit("/"))))
    keys = urls.select("_id", "path", F.explode(hosts).alias("r_host"), tops.alias("tops")).select("_id", "path", "r_host", F.explode("tops").alias("r_dir"))
    fit = keys.join(r, ["r_host", "r_dir"]).where(F.expr("startswith(path, r_path)"))
    order = F.struct(F.length("r_host").alias("a"), F.length("r_path").alias("b"), F.concat("r_host", "r_path").alias("rule"), "verdict")
    return fit.groupBy("_id").agg(F.max(order).alias("m")).select("_id", F.col("m.rule").alias("rule"), F.col("m.verdict").alias("found"))


def judge(pages: DataFrame, rules: list[Rule] | DataFrame, url: str = "url", default: str = "allow",
          max_trie_rules: int = MAX_TRIE_RULES) -> DataFrame:
    """``pages`` plus host, path, rule (``host`` + ``path``; null if none fits) and verdict."""
    rest = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    parsed = pages.select(*rest, url_host(pages[url].cast("string")).alias("host"), url_path(pages[url].cast("string")).alias("path"))
    spark = pages.sparkSession
    n = rules.count() if isinstance(rules, DataFrame) else len(rules)
    if n > max_trie_rules:
        table = rules if isinstance(rules, DataFrame) else spark.createDataFrame(rules, "verdict string, host string, path string")
        pair = parsed.select("host", "path").distinct().withColumn("_id", F.struct("host", "path"))
        found = _joined(pair, table.select("verdict", "host", "path"))
        mark = free_name(parsed, "found_id")
        out = parsed.join(found.withColumnRenamed("_id", mark), F.struct("host", "path") == F.col(mark), "left")
        return out.select(*rest, "host", "path", "rule", F.coalesce("found", F.lit(default)).alias("verdict"))
    if isinstance(rules, DataFrame):
        rules = [tuple(r) for r in rules.select("verdict", "host", "path").collect()]  # n rows, checked above
    shared = spark.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def walk(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        find = shared.value.find
        found = [find(h, p) or (None, default) for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    mark = free_name(parsed, "walked")
    out = parsed.withColumn(mark, walk("host", "path"))
    return out.select(*rest, "host", "path", F.col(mark)["rule"].alias("rule"), F.col(mark)["verdict"].alias("verdict"))
