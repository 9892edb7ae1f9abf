"""Repeated passages: Rabin-Karp hashes of every window of words, counted in Spark.

1. Every window of `WIDTH` words of every text gets a rolling hash. A chunk of texts keeps
   one entry per hash, of its smallest document; the others of the chunk are already known
   to repeat, so a passage that a third of all documents share sends one entry per chunk.
2. Entries are dealt to buckets by the leading bits of the hash, packed: per chunk and
   bucket one row. A bucket counts its hashes and finds the smallest document of each;
   every other document's window is to go.
3. Windows to go are dealt to groups of documents, beside the texts. Overlapping windows
   merge into maximal intervals of words, and what is left is joined.

The buckets and groups follow the amount of text; neither grows with one passage. Hashes
have 56 bits and the bits of the bucket number, 62 at least, so windows of different words
agree by chance about once in 10^18 pairs.

Defined results: null text has no words. Rows that repeat an id are one document for the
comparison, each with its own result. A null id counts as larger than all others. Other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.arrays import chunks, mix, ragged, span_hashes, split_bytes, texts_of, window_hashes, words
from plantpulse.llm.exchange import group_of, ids_of, low_bits, pack_by, texts_by_group, unpack, unpacked_texts
from plantpulse.llm.tables import for_python, power_of_two, text_bytes

#: Words of a window; windows of a bucket, and the least number of buckets; bytes of text of a group.
WIDTH, BUCKET_WINDOWS, LEAST_BUCKETS, GROUP_BYTES = 13, 2_000_000, 64, 8_000_000
#: A usual number of bytes per word, to choose the number of buckets.
WORD_BYTES = 6


def bucket_count(size: int) -> int:
    """Buckets for so many bytes of text; they get slowly larger, so that packed rows stay worth packing."""
    windows = size / WORD_BYTES
    return power_of_two(windows / max(BUCKET_WINDOWS, 16 * math.sqrt(windows)), LEAST_BUCKETS)


def all_windows(data: np.ndarray, at: np.ndarray, width: int, bits: int):
    """Spans of words, each text's first word, and hash, place and text of every window."""
    starts, ends, first = words(data, at)
    hashes = window_hashes(span_hashes(data, starts, ends), width) >> np.uint64(64 - bits - low_bits(bits))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.flatnonzero(text[:max(0, len(text) - width + 1)] == text[width - 1:])
    return starts, ends, first, hashes[place], place, text[place]


PACKED = "bucket int, settled boolean, ids binary, counts binary, hashes binary"


def entries(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """Packed entries by bucket; `settled` rows hold windows that repeat within their chunk."""

    low = np.uint64(low_bits(bits))
    below = (np.uint64(1) << low) - np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids = ids_of(batch.column("doc_id"))
            *_, hashes, _, text = all_windows(*texts_of(batch.column("text")), width, bits)
            owner = ids[text]
            order = np.argsort(hashes, kind="stable")
            hashes, owner = hashes[order], owner[order]
            begin = np.flatnonzero(np.diff(hashes, prepend=hashes[:1] + np.uint64(1)))
            if not len(begin):
                continue
            least = np.minimum.reduceat(owner, begin)
            rest = owner > np.repeat(least, np.diff(begin, append=len(hashes)))
            rows = []
            bucket = (hashes[begin] >> low).astype(np.int64)
            rows += [(k, False, *r) for k, *r in pack_by(bucket, least, hashes[begin] & below, 7)]
            if rest.any():
                # Nothing is left to count, so any bucket may pass these on: one per document.
                bucket = (mix(owner[rest].view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
                rows += [(k, True, *r) for k, *r in pack_by(bucket, owner[rest], hashes[rest], 8)]
            yield packed(rows)

    return for_python(docs).select("doc_id", "text").mapInArrow(run, PACKED)


def packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      ["bucket", "settled", "ids", "counts", "hashes"])


def to_go(counted: DataFrame, groups: int, bits: int) -> DataFrame:
    """Windows to remove, packed by group of documents (in the column `bucket`)."""

    def resolve(table: pa.Table) -> pa.Table:
        open_ids, open_hashes, ids, hashes = [], [], [], []
        high = np.uint64(table.column("bucket")[0].as_py()) << np.uint64(low_bits(bits))
        for row in table.to_pylist():
            own, found = unpack(row["ids"], row["counts"], row["hashes"], 8 if row["settled"] else 7)
            (ids if row["settled"] else open_ids).append(own)
            (hashes if row["settled"] else open_hashes).append(found)
        if open_ids:
            own, found = np.concatenate(open_ids), np.concatenate(open_hashes)
            order = np.argsort(found)
            own, found = own[order], found[order]
            begin = np.flatnonzero(np.diff(found, prepend=found[:1] + np.uint64(1)))
            rest = own > np.repeat(np.minimum.reduceat(own, begin), np.diff(begin, append=len(found)))
            ids.append(own[rest])
            hashes.append(found[rest] | high)
        ids, hashes = np.concatenate(ids), np.concatenate(hashes)
        rows = [(k, True, *r) for k, *r in pack_by(group_of(ids, groups), ids, hashes, 8)]
        return pa.Table.from_batches([packed(rows)]) if rows else table.slice(0, 0)

    return counted.groupBy("bucket").applyInArrow(resolve, PACKED)


def without_repeats(docs: DataFrame, width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row; with_text: also the kept text and the removed intervals.

    A word goes if it lies in a window of `width` words that also starts in a document with
    a smaller id. Intervals are word numbers [begin, end), maximal and in order.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    _, size = text_bytes(docs)
    bits = bucket_count(size).bit_length() - 1
    groups = max(1, -(-size // GROUP_BYTES))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if with_text:
        schema += ", kept string, removed array<struct<begin:long,end:long>>"

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, data, at = unpacked_texts(left)
        starts, ends, first, hashes, place, text = all_windows(data, at, width, bits)
        goes: dict[int, list[np.ndarray]] = {}
        for row in right.to_pylist():
            own, found = unpack(row["ids"], row["counts"], row["hashes"], 8)
            cut = np.flatnonzero(np.diff(own)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(own)], strict=True):
                goes.setdefault(int(own[a]), []).append(found[a:b])
        bound = np.searchsorted(text, np.arange(len(ids) + 1))
        step = np.zeros(len(starts) + 1, np.int64)
        for k, doc_id in enumerate(ids.tolist()):
            if doc_id in goes:
                a, b = bound[k], bound[k + 1]
                hit = place[a:b][np.isin(hashes[a:b], np.concatenate(goes[doc_id]))]
                step[hit] += 1
                step[hit + width] -= 1
        gone = np.cumsum(step[:-1]) > 0
        stays = ~gone
        # Kept words with the byte behind each, which becomes the joining space.
        room = np.append(data, np.uint8(32))
        from_, size_ = starts[stays], (ends - starts)[stays] + 1
        copied = room[np.minimum(ragged(from_, size_), len(data))]
        last = np.cumsum(size_) - 1
        copied[last] = 32
        kept_before = np.concatenate([[0], np.cumsum(stays)])[first]
        ends_at = np.concatenate([[0], np.cumsum(size_)])[kept_before]
        kept = [v[:-1] for v in split_bytes(copied, ends_at)]
        gone_before = np.concatenate([[0], np.cumsum(gone)])[first]
        columns = [left.column("doc_id"), pa.array(np.diff(first)), pa.array(np.diff(gone_before)),
                   pa.array([hashlib.sha256(v).hexdigest() for v in kept], pa.string())]
        if with_text:
            columns += [pa.array([v.decode("utf-8") for v in kept], pa.string()),
                        pa.array([intervals(gone[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)],
                                 pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "removed"]
        return pa.Table.from_arrays(columns, names[:len(columns)])

    found = to_go(entries(docs, width, bits), groups, bits)
    return (texts_by_group(docs, groups).groupBy("bucket")
            .cogroup(found.groupBy("bucket")).applyInArrow(finish, schema))


def intervals(mask: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return [{"begin": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS (SELECT doc_id, w, len(w) AS n_words FROM w),
win AS (SELECT doc_id, unnest(range(1, n_words - 11)) AS i, w FROM n WHERE n_words >= 13),
h AS (SELECT doc_id, i, hash(list_slice(w, i, i + 12)) AS k, list_slice(w, i, i + 12) AS s FROM win),
m AS (SELECT s, min(doc_id) AS first FROM h GROUP BY s HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT DISTINCT h.doc_id, h.i + o AS p FROM h JOIN m USING (s), (SELECT unnest(range(13)) AS o) WHERE h.doc_id > m.first),
word AS (SELECT doc_id, unnest(range(1, n_words + 1)) AS p, unnest(w) AS x FROM n),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS c FROM word ANTI JOIN hit USING (doc_id, p) GROUP BY word.doc_id)
SELECT n.doc_id, n_words, n_words - coalesce(c, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM n LEFT JOIN kept USING (doc_id)
"""
