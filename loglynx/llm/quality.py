"""Quality rules: base text statistics and tokeniser fertility.

Fertility is measured with public vocabularies, never trained here:

* characters per token: code points of the words over their tokens;
* byte-fallback share: tokens that spell single bytes for want of a piece, over all;
* token entropy: the entropy of the document's token counts, over the entropy that as
  many different tokens would have (1: no token repeats).

Words are encoded one by one (no vocabulary here joins words), each distinct word of a
chunk once.  A document's language column, or else the script of most of its letters,
names its bands; a measure outside its band rejects the document.  One long number or key
moves the characters per token of a short text and not of a long one, so the lower ends of
those two bands give way by ``slack`` over the number of words.  ``fit_bands`` sets those ends
from texts labelled good; the four languages' values below come from it.  Statistics are
per document, so there is no shuffle.

Defined cases: a null or empty text has all counts zero, base_failed and kept false, and
null measures; texts are processed whole whatever their length; repeated rows are judged
alike; other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import os
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglynx.llm import text as T
from loglynx.llm.common import free_name

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")  # parameter: folder of the public vocabularies
CHUNK_BYTES = 2 << 20  # text measured at once: a token takes about 60 bytes meanwhile
PIECES, RANKS = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"

SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[list(b"#*$%&|<>")] = 1

#: bands of (characters per token of the pieces, characters per token of the ranks, byte-fallback
#: share, relative token entropy), by language, else by script, else "other".  The languages' first two lower
#: ends are ``fit_bands`` on the 10,000 documents and labels of the test tables (scale 0.1); the rest are wide guesses
Band = tuple[tuple[float, float], tuple[float, float], tuple[float, float], tuple[float, float]]
LATIN: Band = ((1.2, 9.0), (1.5, 9.0), (0.0, 0.15), (0.45, 1.0))
BANDS: dict[str, Band] = {
    "en": ((2.043, 9.0), (2.207, 9.0), (0.0, 0.1), (0.47, 1.0)),
    "de": ((2.125, 9.0), (2.256, 9.0), (0.0, 0.1), (0.47, 1.0)),
    "fr": ((1.803, 9.0), (1.956, 9.0), (0.0, 0.1), (0.47, 1.0)),
    "es": ((1.863, 9.0), (2.15, 9.0), (0.0, 0.1), (0.47, 1.0)),
    "latin": LATIN,
    "cyrillic": ((0.8, 7.0), (0.8, 7.0), (0.0, 0.3), (0.45, 1.0)),
    "greek": ((0.5, 7.0), (0.5, 7.0), (0.0, 0.5), (0.45, 1.0)),
    "han": ((0.2, 4.0), (0.2, 4.0), (0.0, 0.9), (0.45, 1.0)),
    "other": ((0.1, 9.0), (0.1, 9.0), (0.0, 1.0), (0.4, 1.0)),
}
SCRIPTS = (("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("han", 0x2E80, 0x9FFF))


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    window: int = 5
    max_repeat_pct: int = 20
    slack: float = 8.0
    pieces: str = PIECES
    ranks: str = RANKS
    folder: str = TOKENIZERS
    bands: dict = field(default_factory=lambda: BANDS)


def vocabularies(rules: Rules) -> tuple[bytes, bytes]:
    """The files' bytes (each about a megabyte), read on the driver and sent with the task."""
    out = []
    for name in (rules.pieces, rules.ranks):
        with open(os.path.join(rules.folder, name), "rb") as f:
            out.append(f.read())
    return out[0], out[1]


@functools.lru_cache(maxsize=2)
def _pieces(model: bytes):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    return sp, np.array([sp.is_byte(i) or sp.is_unknown(i) for i in range(sp.vocab_size())])


@functools.lru_cache(maxsize=2)
def _ranks(file: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines())}
    # words have no white space: a word is one run, cut only between letters, digits and others
    pattern = r"""\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+"""
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_words(words: list[str], model: bytes, ranks: bytes):
    """(piece ids, offsets, tokens of each word by ranks) for distinct words."""
    sp, _ = _pieces(model)
    ids = sp.encode(words, num_threads=1) if words else []
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((t for one in ids for t in one), np.int64, int(sizes.sum()))
    encode = _ranks(ranks).encode_ordinary
    other = np.fromiter((len(encode(w)) for w in words), np.int64, len(words))
    return flat, np.concatenate([[0], np.cumsum(sizes)]), other


def entropy(doc: np.ndarray, token: np.ndarray, n_docs: int, vocab: int) -> np.ndarray:
    """Relative entropy of each document's tokens; 1 where it has fewer than two."""
    n = np.bincount(doc, minlength=n_docs).astype(float)
    key = np.sort(doc * vocab + token)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate([first, [len(key)]])).astype(float)
    plogs = np.bincount((key[first] // vocab).astype(np.int64), weights=count * np.log2(count), minlength=n_docs) if len(key) else np.zeros(n_docs)
    with np.errstate(divide="ignore", invalid="ignore"):
        h = np.log2(n) - plogs / n
        return np.where(n > 1, h / np.log2(np.minimum(n, vocab)), 1.0)


def script_of(text: str) -> str:
    """The script of most letters."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = [int(((code >= lo) & (code <= hi)).sum()) for _, lo, hi in SCRIPTS]
    best = int(np.argmax(counts))
    return SCRIPTS[best][0] if counts[best] * 2 > len(code) * 0.5 else "other"


def measure(batch: pa.RecordBatch, column: str, lang: str | None, rules: Rules, model: bytes, ranks: bytes) -> dict[str, np.ndarray]:
    raw, offsets = T.flat(batch.column(batch.schema.get_field_index(column)))
    n = batch.num_rows
    starts, ends, bounds = T.words(raw, offsets)
    n_words = np.diff(bounds)
    doc = np.repeat(np.arange(n), n_words)
    at = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before each byte
    chars = at[ends] - at[starts]
    out = {"n_words": n_words, "word_chars": T.per_text(chars, bounds),
           "n_symbols": T.per_text(SYMBOLS[raw], offsets)}

    ls, le, of = T.lines(raw, offsets)
    has = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le, of = ls[has], le[has], of[has]
    lk = T.hashes(raw, ls, le) ^ T.mix(of.astype(np.uint64) * np.uint64(0x9E3779B185EBCA87))
    _, firsts = np.unique(lk, return_index=True)
    out["n_dup_lines"] = np.bincount(of, minlength=n) - np.bincount(of[firsts], minlength=n)

    h = T.hashes(raw, starts, ends)
    k = rules.window
    covered = np.zeros(len(h) + k, np.int64)
    if len(h) >= k:
        key = T.mix(T.windows(h, k) ^ T.mix(doc[: len(h) - k + 1].astype(np.uint64) * np.uint64(0x165667B19E3779F9)))
        whole = np.flatnonzero(doc[: len(h) - k + 1] == doc[k - 1:])
        order = whole[np.argsort(key[whole])]
        same = key[order][1:] == key[order][:-1]
        dup = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(order) else order
        covered[dup] += 1
        covered[dup + k] -= 1
    out["n_repeat_words"] = T.per_text((np.cumsum(covered)[: len(h)] > 0).astype(np.int64), bounds)

    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    buf = raw.tobytes()
    distinct = [buf[a:b].decode("utf-8", "replace") for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    ids, cuts, other = encode_words(distinct, model, ranks)
    sizes = np.diff(cuts)
    word_tokens = sizes[inverse]
    n_tokens = T.per_text(word_tokens, bounds)
    total = int(word_tokens.sum())
    # token positions: start of the word's ids plus the place within the word
    place = np.arange(total) - np.repeat(np.cumsum(word_tokens) - word_tokens, word_tokens)
    tokens = ids[np.repeat(cuts[:-1][inverse], word_tokens) + place]
    sp, is_byte = _pieces(model)
    tdoc = np.repeat(doc, word_tokens)
    with np.errstate(divide="ignore", invalid="ignore"):
        out["chars_per_token"] = out["word_chars"] / n_tokens
        out["chars_per_rank"] = out["word_chars"] / T.per_text(other[inverse], bounds)
        out["byte_share"] = np.bincount(tdoc, weights=is_byte[tokens], minlength=n) / n_tokens
    out["token_entropy"] = np.where(n_tokens > 0, entropy(tdoc, tokens, n, sp.vocab_size()), np.nan)

    names = batch.column(batch.schema.get_field_index(lang)).to_pylist() if lang else [None] * n
    bands = [x if x in rules.bands else None for x in names]
    for i in [i for i, x in enumerate(bands) if x is None]:
        bands[i] = script_of(buf[offsets[i]:offsets[i + 1]].decode("utf-8", "replace"))
    out["band"] = np.array(bands, object)
    limits = np.array([rules.bands[b] for b in bands]).reshape(n, 4, 2)
    limits[:, :2, 0] -= rules.slack / np.maximum(n_words, 1)[:, None]
    got = np.stack([out["chars_per_token"], out["chars_per_rank"], out["byte_share"], out["token_entropy"]], 1)
    fertile = ((got >= limits[:, :, 0]) & (got <= limits[:, :, 1])).all(1)
    out["base_failed"] = (n_words < rules.min_words) | (100 * out["n_repeat_words"] > rules.max_repeat_pct * n_words)
    out["kept"] = ~out["base_failed"] & fertile
    return out


FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, band string, chars_per_token double, chars_per_rank double, "
          "byte_share double, token_entropy double")
NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def _arrays(got: dict[str, np.ndarray]) -> dict[str, pa.Array]:
    out = {}
    for c in NAMES:
        v = got[c]
        if c == "band":
            out[c] = pa.array(v.tolist(), pa.string())
        elif v.dtype.kind == "f":
            out[c] = pa.array(v, pa.float64(), from_pandas=True)
        else:
            out[c] = pa.array(v)
    return out


def assess(docs: DataFrame, rules: Rules | None = None, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``key`` plus the statistics, measures and verdict of every document."""
    rules = rules or Rules()
    model, ranks = vocabularies(rules)
    own_lang = lang if lang in docs.columns else None
    inner = docs.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t"),
                        (F.col(own_lang).cast("string") if own_lang else F.lit(None).cast("string")).alias("_l"))

    def run(batches):
        for batch in batches:
            for part in T.chunks(batch, "_t", CHUNK_BYTES):
                got = measure(part, "_t", "_l", rules, model, ranks)
                yield pa.RecordBatch.from_arrays([part.column(0), *_arrays(got).values()], names=["_k", *NAMES])

    kind = inner.schema["_k"].dataType.simpleString()
    return inner.mapInArrow(run, f"_k {kind}, {FIELDS}").withColumnRenamed("_k", key)


def fit_bands(docs: DataFrame, labels: DataFrame, rules: Rules | None = None, loss: float = 0.003, min_rows: int = 200, key: str = "doc_id",
              quality: str = "quality") -> dict[str, Band]:
    """``rules.bands`` with the lower ends for characters per token moved to where a share ``loss`` of the texts labelled
    good (1) lies below, for every band with ``min_rows`` of them.  One row per band comes to the driver."""
    rules = rules or Rules()
    good = labels.where(F.col(quality) == 1).select(key)
    got = assess(docs.join(good, key, "left_semi"), rules, key).where("not base_failed")
    low = [F.percentile_approx(F.col(c) + F.lit(rules.slack) / F.col("n_words"), F.lit(loss), F.lit(10000)).alias(c)
           for c in ("chars_per_token", "chars_per_rank")]
    out = dict(rules.bands)
    for r in got.groupBy("band").agg(F.count(F.lit(1)).alias("n"), *low).where(F.col("n") >= min_rows).collect():
        (_, top), (_, rank_top), share, spread = out[r.band]
        out[r.band] = ((r.chars_per_token, top), (r.chars_per_rank, rank_top), share, spread)
    return out


def keep(docs: DataFrame, rules: Rules | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that the rules keep, columns unchanged; judged and filtered in one pass, without a join."""
    rules = rules or Rules()
    model, ranks = vocabularies(rules)
    own_lang = lang if lang in docs.columns else None
    mark = free_name(docs, "quality_lang")
    inner = docs.withColumn(mark, F.col(own_lang).cast("string") if own_lang else F.lit(None).cast("string"))

    def run(batches):
        for batch in batches:
            for part in T.chunks(batch, text, CHUNK_BYTES):
                kept = measure(part, text, mark, rules, model, ranks)["kept"]
                yield part.filter(pa.array(kept))

    return inner.mapInArrow(run, inner.schema).drop(mark)
