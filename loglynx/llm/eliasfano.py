"""Elias-Fano sequences over plain arrays, so that they can be written to a file and memory-mapped.

A sorted sequence of n values under u keeps each value's low bits (a whole number of
bytes here) in an array and the high parts as a unary bit vector with a directory of
counts.  Look-ups work on arrays of queries.
"""

from __future__ import annotations

import json

import numpy as np

U64 = np.uint64


class Bits:
    """A bit vector with select for ones and zeros."""

    def __init__(self, words: np.ndarray, ones: np.ndarray):
        self.words, self.ones = words, ones  # ones[i]: ones before word i

    @classmethod
    def build(cls, positions: np.ndarray, size: int) -> Bits:
        flags = np.zeros((size // 64 + 1) * 64, bool)
        flags[positions] = True
        words = np.packbits(flags, bitorder="little").view(U64)
        return cls(words, np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))

    def select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Position of the k-th (0-based) one or zero; k is in range."""
        before = self.ones if one else np.arange(len(self.ones)) * 64 - self.ones
        at = np.searchsorted(before, k, side="right") - 1
        word = self.words[at] if one else ~self.words[at]
        left, shift = k - before[at], np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count(word & U64((1 << width) - 1)).astype(np.int64)
            up = left >= low
            left = np.where(up, left - low, left)
            shift += np.where(up, width, 0)
            word = np.where(up, word >> U64(width), word)
        return at * 64 + shift


class Sequence:
    """A sorted sequence of unsigned 64-bit values, in Elias-Fano form."""

    def __init__(self, n: int, low_bytes: int, low: np.ndarray, high: Bits, top: int):
        self.n, self.low_bytes, self.low, self.high, self.top = n, low_bytes, low, high, top

    @classmethod
    def build(cls, values: np.ndarray) -> Sequence:
        values = np.asarray(values, U64)
        n, last = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (last // max(n, 1)).bit_length())
        nbytes = -(-bits // 8)
        high = (values >> U64(8 * nbytes)).astype(np.int64) if nbytes < 8 else np.zeros(n, np.int64)
        low = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(n, 8)[:, :nbytes].copy()
        top = int(high[-1]) if n else 0
        return cls(n, nbytes, low, Bits.build(high + np.arange(n), n + top + 1), top)

    def lows(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), 8), np.uint8)
        out[:, :self.low_bytes] = self.low[at]
        return out.view("<u8").reshape(-1)

    def get(self, at: np.ndarray) -> np.ndarray:
        high = (self.high.select(at, True) - at).astype(U64)
        return (high << U64(8 * self.low_bytes) if self.low_bytes < 8 else U64(0)) | self.lows(at)

    def _start(self, high: np.ndarray) -> np.ndarray:
        """Index of the first value whose high part is at least ``high``."""
        out = np.where(high > self.top, self.n, 0)
        some = np.flatnonzero((high > 0) & (high <= self.top))
        out[some] = self.high.select(high[some] - 1, False) - (high[some] - 1)
        return out

    def successor(self, x: np.ndarray, lo: np.ndarray | int = 0, hi: np.ndarray | int | None = None) -> np.ndarray:
        """Index of the first value of [lo, hi) that is at least x (hi if there is none)."""
        x = np.asarray(x, U64)
        hi = self.n if hi is None else hi
        high = np.minimum(x >> U64(8 * self.low_bytes), U64(self.top + 1)).astype(np.int64) if self.low_bytes < 8 else np.zeros(len(x), np.int64)
        a = np.clip(self._start(high), lo, hi)
        b = np.clip(self._start(high + 1), lo, hi)
        want = x & U64((1 << (8 * self.low_bytes)) - 1)
        todo = np.flatnonzero(a < b)
        while len(todo):  # binary search among the low parts
            mid = (a[todo] + b[todo]) >> 1
            less = self.lows(mid) < want[todo]
            a[todo] = np.where(less, mid + 1, a[todo])
            b[todo] = np.where(less, b[todo], mid)
            todo = todo[a[todo] < b[todo]]
        return a

    def find(self, x: np.ndarray, lo: np.ndarray | int = 0, hi: np.ndarray | int | None = None) -> np.ndarray:
        """Index of x in [lo, hi), -1 if it is not there."""
        at = self.successor(x, lo, hi)
        end = self.n if hi is None else hi
        out = np.full(len(at), -1, np.int64)
        here = np.flatnonzero(at < end)
        out[here] = np.where(self.get(at[here]) == np.asarray(x, U64)[here], at[here], -1)
        return out

    def parts(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.head": np.array([self.n, self.low_bytes, self.top], np.int64), f"{name}.low": self.low.reshape(-1),
                f"{name}.words": self.high.words, f"{name}.ones": self.high.ones}

    @classmethod
    def of(cls, parts: dict[str, np.ndarray], name: str) -> Sequence:
        n, nbytes, top = (int(x) for x in parts[f"{name}.head"])
        return cls(n, nbytes, parts[f"{name}.low"].reshape(n, nbytes), Bits(parts[f"{name}.words"], parts[f"{name}.ones"]), top)


def pack(parts: dict[str, np.ndarray]) -> bytes:
    """One file of named arrays: a header, then each array at a multiple of 8 bytes."""
    head, at, body = {}, 0, []
    for name, a in parts.items():
        data = np.ascontiguousarray(a).tobytes()
        head[name] = [a.dtype.str, at, len(a)]
        body += [data, b"\0" * (-len(data) % 8)]
        at += len(data) + -len(data) % 8
    said = json.dumps(head).encode()
    said += b" " * (-len(said) % 8)
    return len(said).to_bytes(8, "little") + said + b"".join(body)


def unpack(buffer) -> dict[str, np.ndarray]:
    """Views of a packed file's arrays; ``buffer`` may be a memory map."""
    raw = np.frombuffer(buffer, np.uint8)
    size = int(raw[:8].view("<u8")[0])
    out = {}
    for name, (kind, at, n) in json.loads(raw[8:8 + size].tobytes()).items():
        start = 8 + size + at
        out[name] = raw[start:start + n * np.dtype(kind).itemsize].view(kind)
    return out
