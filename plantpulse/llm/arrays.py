"""Texts of an Arrow batch as NumPy arrays: words, hashes and ragged gathers.

A batch is a byte array with document offsets. All steps work on whole batches, so the
cost of a text does not depend on how texts fall into batches, and neither do results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer single text is handled alone.
CHUNK_BYTES = 4_000_000
#: Bytes whose hashes are worked out at once.
HASHED_BYTES = 500_000
#: White space: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_SOLID = np.ones(256, bool)
_SOLID[list(BLANKS)] = False
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins (one more entry ends the last); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `size` bytes of text, one row at least."""
    for batch in batches:
        _, at = texts_of(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + (size or CHUNK_BYTES), side="right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs without white space, within one text), and each text's first word."""
    n = len(data)
    solid = _SOLID[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.zeros(n, bool)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.zeros(n, bool)
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, at)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            grown = np.full(size, base, np.uint64)
            grown[0] = 1
            _POWERS[k] = np.multiply.accumulate(grown)
    return _POWERS[0], _POWERS[1]


def _sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values times powers of the base: the rolling form of a Rabin-Karp hash."""
    power, _ = _powers(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[:len(values)], out=out[1:])
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        # Some spans at a time: the sums take eight times the bytes.
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + HASHED_BYTES)))
        low = starts[first]
        begin, end = starts[first:last] - low, ends[first:last] - low
        sums = _sums(_BYTE[data[low:ends[last - 1]]])
        _, inverse = _powers(int(end[-1]))
        out[first:last] = mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
        first = last
    return out


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every run of `width` values."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    sums = _sums(values)
    _, inverse = _powers(len(values))
    return mix((sums[width:] - sums[:-width]) * inverse[:len(values) - width + 1])


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions begin[0]..begin[0]+size[0]-1, begin[1].., one after another."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.repeat(begin - (np.cumsum(size) - size), size)
    out += np.arange(total)
    return out


def split_bytes(data: np.ndarray, at: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
