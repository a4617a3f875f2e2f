"""Compact binary columns: sorted numbers, texts and rows of one batch."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes of their differences (sorted numbers pack well)."""
    v = values.astype(np.uint64)
    d = np.diff(v, prepend=np.uint64(0))
    planes = np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T)
    return len(v).to_bytes(8, "big") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "big")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_planes(values: np.ndarray) -> bytes:
    """Numbers in any order as compressed byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return squeeze(np.ascontiguousarray(planes).tobytes())


def unpack_planes(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(expand(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def squeeze(data: bytes) -> bytes:
    """Compressed bytes that know their length."""
    return len(data).to_bytes(8, "big") + pa.compress(data, codec="zstd", asbytes=True)


def expand(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "big"), codec="zstd", asbytes=True)


def grouped(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[dict]]]:
    """(value, its rows) of rows sorted by a column; one group is held at a time."""
    rows = (r for batch in batches for r in batch.to_pylist())
    for value, group in itertools.groupby(rows, key=lambda r: r[column]):
        yield value, list(group)
