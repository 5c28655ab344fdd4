"""Vectorised words and word-window hashes over Arrow string columns.

A task handles its batches in chunks of about a megabyte, cut between rows, so memory follows the
longest single text and not the batch. Words are found on UTF-8 bytes; hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_K1, _K2, _K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_COEFFICIENTS = np.random.default_rng(20240229).integers(0, 1 << 63, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_class(excluded: bytes) -> np.ndarray:
    """Truth by byte value of a word class that holds all bytes but the excluded ones."""
    table = np.ones(256, bool)
    table[np.frombuffer(excluded, np.uint8)] = False
    return table


#: `[^\x20\x09-\x0D]+`
PLAIN = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after A-Z are lower-cased
FOLDED = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _K2
    x ^= x >> np.uint64(29)
    x = x * _K3
    x ^= x >> np.uint64(32)
    return x


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbours; order counts."""
    return mix(a * _K1 + ((b << np.uint64(23)) | (b >> np.uint64(41))))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n neighbours, by doubling: about 2 log2(n) vector steps."""
    if len(h) < n:
        return h[:0]
    have, done, out, power = h, 0, None, 1
    while done < n:
        if n & power:
            out = have if out is None else pair(out[: len(have) - done], have[done:])
            done += power
        if done < n:
            have = pair(have[: len(have) - power], have[power:])
            power *= 2
    return out[: len(h) - n + 1]


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    power = 1
    while power * 2 <= width:
        h = np.minimum(h[: len(h) - power], h[power:])
        power *= 2
    rest = width - power
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def segment_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit multilinear hashes of data[start:end] for sorted, disjoint, non-empty segments."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    at = within + np.repeat(starts, lengths)
    terms = (data[at].astype(np.uint64) + np.uint64(1)) * _COEFFICIENTS[within & 0xFFFF]
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64) * _K1)


@dataclass
class Chunk:
    """Some rows of a batch. Word arrays run over all rows; first[r]:first[r + 1] are row r's words."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def valid(self, n: int) -> np.ndarray:
        """Which runs of n words lie in one row."""
        return self.row[: len(self.row) - n + 1] == self.row[n - 1 :] if len(self.row) >= n else np.zeros(0, bool)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary column; null is empty."""
    column = column.cast(pa.large_string() if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def bounds(m: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at row offsets."""
    full = offsets[1:] > offsets[:-1]
    first = m.copy()
    first[1:] &= ~m[:-1]
    heads = offsets[:-1][full]
    first[heads] = m[heads]
    last = m.copy()
    last[:-1] &= ~m[1:]
    tails = offsets[1:][full] - 1
    last[tails] = m[tails]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def chunks(column: pa.Array, table: np.ndarray, *, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    data, offsets = raw(column)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        part, own = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        if lower:
            part = LOWER[part]
        starts, ends = bounds(table[part], own) if len(part) else (np.zeros(0, np.int64),) * 2
        first = np.searchsorted(starts, own)
        yield Chunk(lo, hi, part, own, starts, ends, np.repeat(np.arange(hi - lo), np.diff(first)), first, segment_hash(part, starts, ends))
        lo = hi


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
