"""Best-fit packing of documents into sequences of a fixed length.

Every document is its ids and a closing id. Longer ones than a sequence are cut into full
pieces; the remainder is the first piece. What has to be packed is then only a count of
pieces per length, at most `length` numbers whatever the corpus, and is solved on the driver:

1. Reduction by dominance. For the longest piece j left, a set with j is fixed, as often
   as counts allow, if no other set with j can be better: nothing else fits; a pair fills
   the sequence; one more piece at most fits, so the largest that fits is best; two more at
   most fit, and the largest single piece, or a pair, is at least as long, item by item, as
   all they could be exchanged with. Fixed sets leave and the instance shrinks.
2. Best fit, longest pieces first, on the remainder, for all pieces of a length at once.

The solution is a list of runs: pieces of one length, numbered, that go to consecutive
sequences at one offset. Spark numbers the pieces of each length (blocks by hash, counts
per block, a window within the block) and looks every piece up in the runs.

Defined results: null or empty text is the closing id alone. Repeated rows are packed each
for itself. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.llm.arrays import chunks, split_bytes, texts_of
from plantpulse.llm.bpe import ENCODED_BYTES, vocabulary
from plantpulse.llm.tables import for_python
from plantpulse.session import stage_table

#: Pieces of a numbering block.
BLOCK_ROWS = 20_000
NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]


@dataclass
class Runs:
    """Pieces number first .. first + per_bin * bins - 1 of one length; `per_bin` of them side by side in each sequence."""

    length: np.ndarray
    first: np.ndarray
    per_bin: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def reduce_by_dominance(left: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Take fixed sets (pieces of each length, how often) out of `left`, counts by length."""
    fixed: list[tuple[dict[int, int], int]] = []
    order = sorted(left)

    def available(most: int, j: int) -> int:
        """The largest length up to `most` that is left beside one piece of length j; 0 if none."""
        k = bisect_left(order, most + 1) - 1
        while k >= 0 and left[order[k]] - (order[k] == j) <= 0:
            k -= 1
        return order[k] if k >= 0 else 0

    def smallest(count: int, j: int) -> list[int]:
        out: list[int] = []
        for s in order:
            out += [s] * min(count - len(out), left[s] - (s == j))
            if len(out) == count:
                break
        return out

    def best_pair(room: int, j: int) -> tuple[int, int]:
        """The two pieces beside j with the largest sum up to `room`."""
        have = [s for s in order if s < room and left[s] - (s == j) > 0]
        lo, hi, best = 0, len(have) - 1, (0, 0)
        while lo <= hi:
            a, b = have[hi], have[lo]
            if a + b > room:
                hi -= 1
            else:
                if a + b > sum(best) and (a != b or left[a] - (a == j) > 1):
                    best = (a, b)
                lo += 1
        return best

    def fix(*parts: int) -> None:
        need = {s: parts.count(s) for s in parts}
        times = min(left[s] // n for s, n in need.items())
        fixed.append((need, times))
        for s, n in need.items():
            left[s] -= n * times
            if not left[s]:
                del left[s]
                order.remove(s)

    changed = True
    while changed:
        changed = False
        for j in sorted(left, reverse=True):
            while left.get(j):
                room = size - j
                mate = available(room, j)
                if not mate:
                    fix(j)
                elif j + mate == size:
                    fix(j, mate)
                else:
                    low = smallest(3, j)
                    if sum(low[:2]) > room or len(low) < 2:
                        fix(j, mate)
                    elif sum(low) > room or len(low) < 3:
                        a, b = best_pair(room, j)
                        if mate >= a + b:
                            fix(j, mate)
                        elif a == mate and b >= available(room // 2, j):
                            fix(j, a, b)
                        else:
                            break
                    else:
                        break
                changed = True
    return fixed


def best_fit(left: dict[int, int], size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins as (lengths with repeats in a row, how many such bins), longest pieces first."""
    room_order: list[int] = []
    open_bins: dict[int, list[tuple[tuple, int]]] = {}

    def put(room: int, contents: tuple, bins: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            insort(room_order, room)
        open_bins[room].append((contents, bins))

    for s in sorted(left, reverse=True):
        todo = left[s]
        while todo:
            k = bisect_left(room_order, s)
            if k < len(room_order):
                room = room_order[k]
                contents, bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    del room_order[k]
            else:
                room, contents, bins = size, (), -(-todo // (size // s))
            each = room // s
            full = min(bins, todo // each)
            rest = todo - full * each if full < bins else 0
            if full:
                put(room - each * s, (contents, s, each), full)
            if rest:
                put(room - rest * s, (contents, s, rest), 1)
            if bins - full - (rest > 0):
                put(room, contents, bins - full - (rest > 0))
            todo -= full * each + rest

    def unfold(contents: tuple) -> list[tuple[int, int]]:
        parts = []
        while contents:
            contents, s, n = contents
            parts.append((s, n))
        return parts[::-1]

    return [(unfold(contents), bins) for groups in open_bins.values() for contents, bins in groups]


def solve(counts: dict[int, int], size: int) -> Runs:
    """Runs that place counts[s] pieces of each length s in sequences of `size`."""
    left = {int(s): int(n) for s, n in counts.items() if n}
    bins = [([*need.items()], times) for need, times in reduce_by_dominance(left, size)]
    bins += best_fit(left, size)
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for parts, times in bins:
        offset = 0
        for s, n in parts:
            rows.append((s, used.get(s, 0), n, sequence, offset))
            used[s] = used.get(s, 0) + n * times
            offset += s * n
        sequence += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return Runs(*columns, sequence)


def place(runs: Runs, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces given by length and number within the length."""
    begin = np.searchsorted(runs.length, length)
    # Keys that sort by length and then by the first number of the run.
    scale = int(runs.first.max(initial=0)) + 1
    at = np.searchsorted(runs.length * scale + runs.first, length * scale + np.minimum(number, scale - 1), side="right") - 1
    at = np.maximum(at, begin)
    rank = number - runs.first[at]
    return runs.sequence[at] + rank // runs.per_bin[at], runs.offset[at] + rank % runs.per_bin[at] * length


def cut(docs: DataFrame, path: str, size: int, closing_id: int, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32 (and their ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in chunks(batches, size=ENCODED_BYTES):
            ids, at = vocab.encode(*texts_of(batch.column("text")))
            closed = np.insert(ids.astype("<u4"), at[1:], closing_id)
            total = np.diff(at) + 1
            where = np.concatenate([[0], np.cumsum(total)])
            pieces = -(-total // size)
            row = np.repeat(np.arange(len(total)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = total - (pieces - 1) * size
            start = np.where(piece > 0, head[row] + (piece - 1) * size, 0)
            length = np.where(piece > 0, size, head[row])
            begin = where[row] + start
            spans = split_bytes(closed.view(np.uint8), np.append(begin, where[-1]) * 4)
            columns = [batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                       pa.array(length), pa.array([zlib.crc32(v) for v in spans], pa.int64())]
            if with_ids:
                columns.append(pa.array(spans, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, NAMES[:len(columns)])

    texts = for_python(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long"
                            + ", ids binary" * with_ids)


def pack(pieces: DataFrame, size: int) -> DataFrame:
    """`pieces` (stored, with a `length` from 1 to `size`) with sequence_id and offset."""
    columns = pieces.columns
    total = pieces.count()
    blocks = max(1, -(-total // BLOCK_ROWS))
    keyed = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)).cast("int"))
    counts = stage_table(keyed.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n")))
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = solve(by_length, size)

    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = keyed.withColumn("number", F.row_number().over(order)).join(starts, ["length", "block"])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = place(runs, batch.column("length").to_numpy(), batch.column("number").to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)],
                                             [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"
    return for_python(numbered).select(*columns, (F.col("number") + F.col("before") - 1).alias("number")).mapInArrow(look_up, schema)


def packed_documents(docs: DataFrame, path: str, size: int = 2048, closing_id: int = 0,
                     with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most `size` ids."""
    return pack(stage_table(cut(docs, path, size, closing_id, with_ids)), size)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and `ids` of each sequence, from pieces packed with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
