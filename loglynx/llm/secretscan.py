"""Secret scans: fixed patterns, and dictionary-primed zstandard novelty.

Patterns (``assign``, ``access``, ``hex``) are matched leftmost and non-overlapping, each
kind for itself; matches that are too short are dropped.  The method adds ``novel``
spans: a string of at least 20 code characters with a letter and a digit, in a sensitive
context (a word such as key, token or auth in the text that it is measured against, on its
line or on one before), or the body of a private key block, whose marginal compressed size
is high: the text around it is compressed with and without it, by a compressor primed with a
dictionary of common identifiers, and the bytes it adds are divided by its length.  What the
surrounding code or the dictionary repeats costs little; random strings cost most of their length.

Scanning is per document, without a shuffle.  Arrow's linear-time patterns select the
texts worth a closer look, exactly: each is a necessary condition of its kind.

Defined cases: null and empty texts have no spans; texts are scanned whole; spans count
code points, end exclusive; repeated rows have equal spans; spans of different kinds may
overlap (``novel`` overlaps none); an empty table gives an empty result; other columns
pass through ``redact`` unchanged, but ``n_chars`` is counted anew where the text changes.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglynx.llm import text as T

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs: the same spans as dropping shorter runs afterwards
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# a key block's body, line breaks and headers included, up to the five dashes of its end or the text's
BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----\s*((?:[A-Za-z0-9+/=:,.()\s]|-(?!----))+)(?<!\s)")
SENSITIVE = re.compile(r"passw|pwd|secret|token|api.?key|private.?key|access.?key|credential|bearer|authorization|signature", re.I | re.A)

# necessary conditions, in linear time (case folding there may select more, never less)
NEED = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    "access": r"AKIA[A-Z0-9]",
    "hex": r"[0-9a-f]{32}",
    "novel": r"[A-Za-z0-9+/_=-]{20}|PRIVATE KEY(?: BLOCK)?-----",
}
MIN_ACCESS, MIN_VALUE = 16, 8

# Identifiers and words that code and configuration repeat.
IDENTIFIERS = """
abstract access_token account address admin algorithm api_key application argument array async authorization
await base64 bearer boolean buffer callback certificate char class client client_id client_secret config
connection const constructor content context controller cookie count create credential data database default
delete description digest document element email encode encoding endpoint environment error event exception
export expires extends false field file filename final float format function generate handler hash header host
https identifier implements import index input instance integer interface invalid iterator javascript key
keystore length library localhost logger login manager message method module namespace network null number
object offset operator option output package parameter parent password path payload pointer port position
prefix private private_key process production property protected protocol provider proxy public public_key
query receiver record redirect reference refresh_token register release request resource response result
return runtime schema secret secret_key sequence server service session setting signature source static
status storage string struct subject suffix system table target template thread timeout timestamp token
transaction true type undefined unsigned update upload username utils value variable vector version void
window worker write 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ
""".split()


class Novelty:
    """Marginal compressed bytes per character, given the text around a string."""

    def __init__(self, identifiers: list[str] = IDENTIFIERS, around: int = 400, level: int = 9):
        prime = zstandard.ZstdCompressionDict(" ".join(identifiers).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=prime, write_checksum=False, write_content_size=False)
        self.around = around

    def __call__(self, text: str, start: int, end: int) -> float:
        before, after = text[max(0, start - self.around):start], text[end:end + self.around]
        size = lambda x: len(self.compressor.compress(x.encode("utf-8", "replace")))
        return (size(before + text[start:end] + after) - size(before + after)) / (end - start)


def spans_of(text: str, novelty: Novelty, kinds: set[str], min_novelty: float, context: int) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    out = []
    if "assign" in kinds:
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "access" in kinds:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if "hex" in kinds:
        out += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "novel" in kinds:
        base = sorted((a, b) for _, a, b in out)
        blocks = [(*m.span(1), True) for m in BLOCK.finditer(text)]
        strings = [(*m.span(), False) for m in CANDIDATE.finditer(text)]
        at = reach = done = 0
        for a, b, block in sorted(blocks + strings, key=lambda x: (x[0], -x[1])):
            while at < len(base) and base[at][0] < b:
                reach = max(reach, base[at][1])
                at += 1
            if max(reach, done) > a:
                continue
            s = text[a:b]
            if not (any(c.isdigit() for c in s) and any(c.isalpha() for c in s)):
                continue
            if (block or SENSITIVE.search(text, max(0, a - context), a)) and novelty(text, a, b) >= min_novelty:
                out.append(("novel", a, b))
                done = b
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def batch_spans(column: pa.Array, novelty: Novelty, min_novelty: float, context: int) -> list[list[tuple[str, int, int]]]:
    column = column.cast(pa.string()) if pa.types.is_null(column.type) else column
    need = {k: pc.fill_null(pc.match_substring_regex(column, pattern), False) for k, pattern in NEED.items()}
    some = need["assign"]
    for k in ("access", "hex", "novel"):
        some = pc.or_(some, need[k])
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(len(column))]
    for i in pc.indices_nonzero(some).to_pylist():
        kinds = {k for k, v in need.items() if v[i].as_py()}
        out[i] = spans_of(column[i].as_py(), novelty, kinds, min_novelty, context)
    return out


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", min_novelty: float = 0.7, context: int = 400) -> DataFrame:
    """``key`` plus spans, an array of (kind, start, end), for every document."""
    inner = docs.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t"))

    def run(batches):
        novelty = Novelty()
        for batch in batches:
            for part in T.chunks(batch, "_t"):
                found = batch_spans(part.column(1), novelty, min_novelty, context)
                rows = [[{"kind": k, "start": a, "end": b} for k, a, b in one] for one in found]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(SPAN))], names=["_k", "spans"])

    kind = inner.schema["_k"].dataType.simpleString()
    return inner.mapInArrow(run, f"_k {kind}, spans array<struct<kind:string,start:long,end:long>>").withColumnRenamed("_k", key)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by a placeholder."""
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in spans:
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], f"[secret:{kind}]"]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", count: str = "n_chars", min_novelty: float = 0.7, context: int = 400) -> DataFrame:
    """``docs`` with every secret replaced by a placeholder; no document goes."""
    counted = count in docs.columns

    def run(batches):
        novelty = Novelty()
        for batch in batches:
            for part in T.chunks(batch, text):
                at = part.schema.get_field_index(text)
                found = batch_spans(part.column(at), novelty, min_novelty, context)
                if any(found):
                    new = {i: mask(part.column(at)[i].as_py(), s) for i, s in enumerate(found) if s}
                    part = _set(part, text, new)
                    if counted:
                        part = _set(part, count, {i: len(t) for i, t in new.items()})
                yield part

    return docs.mapInArrow(run, docs.schema)


def _set(batch: pa.RecordBatch, name: str, new: dict) -> pa.RecordBatch:
    """``batch`` with some rows of a column replaced."""
    at = batch.schema.get_field_index(name)
    old = batch.column(at)
    hit = pa.array([i in new for i in range(len(old))])
    values = pc.replace_with_mask(old, hit, pa.array([new[i] for i in sorted(new)], old.type))
    return batch.set_column(at, batch.schema.field(at), values)
