"""Whole Arrow string columns as flat numpy arrays, cut into pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: Bytes of text handled at once by vectorised operators; a longer text is a piece of its own.
PIECE_BYTES = 1 << 21


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [start, end) whose texts have about limit bytes together."""
    sizes = np.asarray(pa.compute.binary_length(texts).fill_null(0), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, end
        start = end


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without nulls."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]
