"""Word and shingle hashes of whole texts, vectorised over a batch.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A shingle is five
consecutive words; a text of one to four words has one shingle, of all its
words; a text without a word (null or empty) has none. Hashes are 64 bits;
two different shingles share one with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WIDTH = 5
#: Bytes of text hashed at once: about 40 bytes of memory for each.
CHUNK_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, each followed by a newline, and their starts."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    starts = np.cumsum([0] + [len(p) + 1 for p in parts])
    return np.frombuffer(b"\n".join(parts) + b"\n", np.uint8), starts


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes in text order, number of words of each text)."""
    data, starts = encode(texts)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=total[1:])
    hashes = mix((total[end] - total[begin]) * _power(_INVERSE, n)[begin])
    return hashes, np.diff(np.searchsorted(begin, starts))


def shingles(texts: list[str | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes in text order, repeats included; number of each text)."""
    hashes, counts = words(texts)
    # A text of fewer words than the width is padded with a null word to one shingle.
    short = (counts > 0) & (counts < width)
    if short.any():
        at = np.cumsum(counts)[short]
        missing = width - counts[short]
        hashes = np.insert(hashes, np.repeat(at, missing), np.uint64(0))
        counts = np.where(short, width, counts)
    out = np.zeros(max(len(hashes) - width + 1, 0), np.uint64)
    for j in range(width):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[j : len(hashes) - width + 1 + j])
    ends = np.cumsum(counts)
    keep = np.ones(len(hashes), bool)
    for j in range(1, width):  # a shingle must not reach into the next text
        keep[(ends - j)[counts >= j]] = False
    number = np.maximum(counts - width + 1, 0)
    return out[keep[: len(out)]], np.where(counts > 0, number, 0)


def chunks(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[pa.RecordBatch, list]]:
    """A batch cut into pieces of about CHUNK_BYTES, with their texts as str."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.array(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    total, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + CHUNK_BYTES, side="right")))
        yield batch.slice(begin, end - begin), column.slice(begin, end - begin).to_pylist()
        begin = end


def split(hashes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct hashes of each text."""
    return [np.unique(x) for x in np.split(hashes, np.cumsum(counts)[:-1])]


def hash_functions(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """n multiply-add hash functions on 64-bit values: factors and offsets."""
    with np.errstate(over="ignore"):
        base = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(seed))
    return base[:n] | np.uint64(1), base[n:]
