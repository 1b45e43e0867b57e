"""Vectorised text helpers that run inside tasks, on one Arrow batch at a time.

A batch's texts are one UTF-8 buffer with offsets.  Words are maximal runs of
bytes outside ``\\x20\\x09-\\x0D`` (the class ``[^\\x20\\x09-\\x0D]+``); as all
separators are ASCII, splitting bytes or code points gives the same words.
Chunks hold a bounded number of bytes, except that one text is never split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 6 << 20  # text bytes handled at once inside a task

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = bytes(LOWER)

_P1, _P2, _P3 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
LONG_SPAN = 64  # longer spans are hashed one by one


def flat(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty texts."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    n = len(column)
    offsets = (np.frombuffer(offs, np.int64)[column.offset: column.offset + n + 1] if offs is not None and n
               else np.zeros(n + 1, np.int64))
    raw = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data is not None and n else np.zeros(0, np.uint8)
    if lower:
        raw = LOWER[raw]
    return raw, offsets - offsets[0] if n else offsets


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` text bytes (one row at least)."""
    n = batch.num_rows
    if n == 0:
        return
    _, offsets = flat(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text + total): no word spans two texts."""
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    space = SPACE[raw]
    before = np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, space[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = True
    after[inner - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text index) of the pieces between ``\\n`` bytes."""
    cut = np.flatnonzero(raw == 10)
    starts = np.sort(np.concatenate([offsets[:-1], cut + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], cut]), kind="stable")
    of = np.repeat(np.arange(len(offsets) - 1), 1 + np.diff(np.searchsorted(cut, offsets)))
    return starts, ends, of


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _P2
    return h ^ (h >> np.uint64(32))


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    size = ends - starts
    h = mix(size.astype(np.uint64) * _P3 + _P1)
    if not len(size):
        return h
    at8 = np.ndarray((len(raw),), "<u8", np.concatenate([raw, np.zeros(8, np.uint8)]), strides=(1,)) if len(raw) else None
    short = size <= LONG_SPAN
    todo = np.flatnonzero(short & (size > 0))
    k = 0
    while len(todo):
        left = size[todo] - k
        piece = at8[starts[todo] + k] & _MASKS[np.minimum(left, 8)]
        h[todo] = mix((h[todo] ^ piece) * _P1)
        k += 8
        todo = todo[left > 8]
    view = memoryview(raw) if len(raw) else None
    for i in np.flatnonzero(~short):
        h[i] = xxhash.xxh64_intdigest(view[starts[i]:ends[i]])
    return h


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` consecutive values (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out = mix(out * _P1 + h[j:j + n])
    return out


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    total = np.concatenate([np.zeros(1, np.float64 if values.dtype.kind == "f" else np.int64),
                            np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def replace_columns(batch: pa.RecordBatch, keep: list[str], **new: pa.Array) -> pa.RecordBatch:
    cols = {c: batch.column(batch.schema.get_field_index(c)) for c in keep} | new
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
