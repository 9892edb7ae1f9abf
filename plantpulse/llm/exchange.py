"""Packed exchange: many small values per shuffled row.

Arrays of hashes travel as binary values, one row per sender and receiver, so that Spark
partitions and shuffles them without a row per hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from plantpulse.llm.arrays import mix, split_bytes, texts_of
from plantpulse.llm.tables import for_python

#: The id that stands for a null one: larger than all others.
NO_ID = np.iinfo(np.int64).max


def low_bits(bits: int) -> int:
    """Bits of a hash below the bucket number; they fit in seven bytes."""
    return min(56, 64 - bits)


def ids_of(column: pa.Array) -> np.ndarray:
    return np.asarray(column.fill_null(NO_ID).to_numpy(zero_copy_only=False), np.int64)


def pack_by(key: np.ndarray, ids: np.ndarray, hashes: np.ndarray, size: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """One row per key: its ids, how many hashes each has, and `size` bytes of each hash."""
    order = np.lexsort((ids, key))
    key, ids, raw = key[order], ids[order], hashes[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]
    cut = np.flatnonzero(np.diff(key)) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(key)], strict=True):
        if b > a:
            begin = np.flatnonzero(np.diff(ids[a:b], prepend=ids[a] - 1))
            count = np.diff(begin, append=b - a)
            yield int(key[a]), ids[a:b][begin].tobytes(), count.astype("<u4").tobytes(), raw[a:b].tobytes()


def unpack(ids: bytes, counts: bytes, hashes: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(hashes, np.uint8).reshape(-1, size)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, :size] = raw
    return np.repeat(np.frombuffer(ids, "<i8"), np.frombuffer(counts, "<u4")), full.view("<u8").ravel()


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    return (mix(ids.view(np.uint64)) % np.uint64(groups)).astype(np.int32)


def texts_by_group(docs: DataFrame, groups: int) -> DataFrame:
    """Compressed texts with the group of their id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pack = zstandard.ZstdCompressor(level=1)
            group = group_of(ids_of(batch.column("doc_id")), groups)
            texts = [pack.compress(t) for t in split_bytes(*texts_of(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([pa.array(group), batch.column("doc_id"), pa.array(texts, pa.binary())],
                                             ["bucket", "doc_id", "packed"])

    return for_python(docs).select("doc_id", "text").mapInArrow(run, "bucket int, doc_id long, packed binary")


def unpacked_texts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, bytes and offsets of texts that `texts_by_group` packed."""
    unpacker = zstandard.ZstdDecompressor()
    raw = [unpacker.decompress(t) for t in table.column("packed").to_pylist()]
    at = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    ids = ids_of(table.column("doc_id").combine_chunks() if table.num_rows else pa.array([], pa.int64()))
    return ids, np.frombuffer(b"".join(raw), np.uint8), at
