"""Slices of Arrow arrays by the bytes of their rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(array: pa.Array, sizes: pa.Array | np.ndarray, most: int) -> Iterator[pa.Array]:
    """Slices in order of at most ``most`` bytes, or of one row; ``sizes`` are the bytes of the rows, null counts as none."""
    sizes = np.asarray(pc.fill_null(sizes, 0)) if isinstance(sizes, pa.Array) else sizes
    ends = np.cumsum(sizes.astype(np.int64) + 1)  # an empty row counts as well
    start = 0
    while start < len(array):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield array.slice(start, stop - start)
        start = stop
