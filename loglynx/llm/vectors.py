"""Embedding columns as matrices, inside tasks, on one Arrow batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrices(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{length: (row numbers, rows x length doubles)} of the vectors that are not null and
    hold finite numbers only."""
    if pa.types.is_null(column.type):
        return {}
    offsets = np.asarray(column.offsets)
    values = column.values.cast(pa.float64())
    flat = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = np.asarray(column.is_valid()) & (bad[offsets[1:]] == bad[offsets[:-1]])
    size = np.diff(offsets)
    out = {}
    for n in np.unique(size[good]).tolist():
        rows = np.flatnonzero(good & (size == n))
        out[n] = rows, flat[offsets[rows][:, None] + np.arange(n)]
    return out


def scaled(m: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * m) as longs; numbers whose exact sums and products would not fit are an error."""
    x = np.floor(m * scale)
    if x.size and np.abs(x).max() >= limit:
        raise ValueError(f"vector components of {limit // scale} and more are not supported")
    return x.astype(np.int64)
