"""Arrow and numpy helpers for whole texts, used inside Python workers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def as_array(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def chunks(texts: pa.Array, max_bytes: int) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive runs of whole rows with about ``max_bytes`` of text each (a
    longer row stands alone), with the index of their first row."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    end = np.cumsum(size)
    at = 0
    while at < len(texts):
        before = end[at] - size[at]
        stop = max(at + 1, int(np.searchsorted(end, before + max_bytes, side="right")))
        yield at, texts.slice(at, stop - at)
        at = stop


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """Words between runs of ``[\\x20\\x09-\\x0D]`` of every row (null: none).

    Returns the number of words per row and all words in one array."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(texts)
    flat, row = parts.flatten(), pc.list_parent_indices(parts)
    full = pc.greater(pc.binary_length(flat), 0)
    row = row.filter(full).to_numpy(zero_copy_only=False)
    return np.bincount(row, minlength=len(texts)).astype(np.int64), flat.filter(full)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of the rows one after the other, and the n + 1 bounds
    (null: no bytes)."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[bounds[0]:bounds[-1]], bounds - bounds[0]


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Float sums of ``values[bounds[i]:bounds[i + 1]]``; empty rows give 0."""
    out = np.zeros(len(bounds) - 1)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full], dtype=np.float64)
    return out


def release() -> None:
    """Give memory that Arrow keeps for later back to the system: Python workers
    stay, and what one stage has needed would stay with them."""
    pa.default_memory_pool().release_unused()


def pack_numbers(values: np.ndarray) -> bytes:
    """Whole numbers from 0 to 2**32 - 1, byte by byte of all of them, as zstd."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def unpack_numbers(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of :func:`pack_numbers`."""
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
