"""Byte-level BPE: encoding and decoding as the tokenizers library does, for whole texts.

Texts are cut into pieces by the vocabulary's pattern, worked out on arrays of character
classes. Each distinct piece of a chunk is encoded once by a contiguous rank array: parts
and the rank of each adjacent pair stand side by side; the smallest rank is found by a
scan, its boundary deleted, and the two neighbouring ranks refreshed. This runs for all
new pieces of a chunk in step, one row of the array each. Pieces beyond `SHORT` bytes keep
the same order of merges in a heap, as a scan per merge would grow with the square of
their length. Encoded pieces are kept in a bounded table per worker.

The text of an added token (`<|endoftext|>`) becomes that token's id, as the library's
default is; pieces never reach across it.

Defined results: null text is empty and has no ids; repeated rows, ties and other columns
need no rule, as each row is encoded for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.arrays import chunks, ragged, span_hashes, split_bytes, texts_of
from plantpulse.llm.tables import for_python

#: Bytes up to which a piece is encoded by scanning; pieces kept per worker before the older ones go.
SHORT, KEPT = 64, 200_000
#: Bytes of text encoded at once.
ENCODED_BYTES = 2_000_000
_NO_RANK = np.int32(2**31 - 1)

# Characters that the pattern's \s takes.
SPACES = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that the pattern splits off after an apostrophe.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]

SPACE, LETTER, NUMBER, OTHER = range(4)
_LOADED: dict[str, "Vocabulary"] = {}


def byte_of_symbol() -> dict[str, int]:
    """The printable symbol that stands for each byte in the vocabulary file, inverted."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tables of one vocabulary file, and the pieces that this worker has encoded."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbol = byte_of_symbol()
        ids: dict[str, int] = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.byte_id = [0] * 256
        for ch, b in symbol.items():
            self.byte_id[b] = ids[ch]
        self.added = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        spelled = {i: bytes(symbol[c] for c in s) for s, i in ids.items() if all(c in symbol for c in s)}
        spelled |= {i: s for s, i in self.added.items()}
        count = max(spelled) + 1
        spans = [spelled.get(i, b"") for i in range(count)]
        self.size = np.array([len(s) for s in spans], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(spans), np.uint8)
        key = np.array([a * count + b for a, b in self.merges], np.int64)
        order = np.argsort(key)
        self.pair_key, self.count = key[order], count
        self.pair_rank = np.arange(len(key), dtype=np.int32)[order]
        self.pair_new = np.array([new for _, new in self.merges.values()], np.int32)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        kind = np.full(0x110000, OTHER, np.uint8)
        for cp in range(0x110000):
            major = unicodedata.category(chr(cp))[0]
            if major == "L":
                kind[cp] = LETTER
            elif major == "N":
                kind[cp] = NUMBER
        kind[SPACES] = SPACE
        self.kind = kind

    def look_up(self, texts: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces, as little-endian unsigned 32-bit values."""
        if len(self.known) > KEPT:
            # Two generations: what was used since the last turn stays.
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing = []
        for t in texts:
            if t not in known:
                if t in older:
                    known[t] = older[t]
                else:
                    missing.append(t)
        if missing:
            missing.sort(key=len)
            short = [t for t in missing if len(t) <= SHORT]
            for k in range(0, len(short), 8192):
                known.update(zip(short[k:k + 8192], self.merge_by_scan(short[k:k + 8192]), strict=True))
            for t in missing[len(short):]:
                known[t] = np.array(self.merge_by_heap([self.byte_id[b] for b in t]), "<u4").tobytes()
            for t, i in self.added.items():
                known[t] = np.array([i], "<u4").tobytes()
        return [known[t] for t in texts]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair; `_NO_RANK` where the pair never merges or an end is missing."""
        key = left.astype(np.int64) * self.count + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where((self.pair_key[at] == key) & (left >= 0) & (right >= 0), self.pair_rank[at], _NO_RANK)

    def merge_by_scan(self, texts: list[bytes]) -> list[bytes]:
        size = np.array([len(t) for t in texts], np.int64)
        out = np.full((len(texts), int(size.max()) + 1), -1, np.int32)
        row = np.repeat(np.arange(len(texts)), size)
        raw = np.frombuffer(b"".join(texts), np.uint8)
        out[row, ragged(np.zeros(len(texts), np.int64), size)] = np.array(self.byte_id, np.int32)[raw]
        live = np.arange(len(texts))
        parts = out.copy()
        rank = np.full_like(parts, _NO_RANK)
        rank[:, :-1] = self.ranks(parts[:, :-1], parts[:, 1:])
        place = np.arange(parts.shape[1])
        while len(live):
            best = rank.argmin(axis=1)
            here = np.arange(len(live))
            least = rank[here, best]
            done = least == _NO_RANK
            if done.any():
                out[live[done]] = parts[done]
                go = ~done
                live, parts, rank, best, least = live[go], parts[go], rank[go], best[go], least[go]
                here = np.arange(len(live))
                if not len(live):
                    break
            source = np.minimum(place + (place > best[:, None]), len(place) - 1)
            parts = np.take_along_axis(parts, source, axis=1)
            parts[:, -1] = -1
            parts[here, best] = self.pair_new[least]
            # The rank after the deleted boundary moves up; its neighbours are refreshed.
            rank = np.take_along_axis(rank, source, axis=1)
            rank[:, -1] = _NO_RANK
            follow = np.minimum(best + 1, len(place) - 1)
            rank[here, best] = self.ranks(parts[here, best], parts[here, follow])
            prior = np.maximum(best - 1, 0)
            rank[here, prior] = np.where(best > 0, self.ranks(parts[here, prior], parts[here, best]), rank[here, prior])
        kept = out >= 0
        count = kept.sum(axis=1)
        flat = out[kept].astype("<u4").view(np.uint8)
        return split_bytes(flat, np.concatenate([[0], np.cumsum(count)]) * 4)

    def merge_by_heap(self, parts: list[int]) -> list[int]:
        n = len(parts)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (m := self.merges.get((parts[i], parts[j]))):
                heap.append((m[0], i, parts[i], parts[j], m[1]))

        for i in range(n - 1):
            offer(i)
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = right[i] if parts[i] == a else n
            if j >= n or parts[j] != b:
                continue  # one of the two parts has merged since
            parts[i], parts[j] = new, -1
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            fresh, heap_size = [k for k in (left[i], i) if k >= 0], len(heap)
            for k in fresh:
                offer(k)
            added = heap[heap_size:]
            del heap[heap_size:]
            for entry in added:
                heapq.heappush(heap, entry)
        return [p for p in parts if p >= 0]

    def pieces(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends (in bytes) of the pattern's pieces, and each text's first piece."""
        n = len(data)
        raw = data.tobytes()
        cuts, whole = [], []
        for token in self.added:
            hit = raw.find(token)
            while hit >= 0:
                text = int(np.searchsorted(at, hit, side="right"))
                if hit + len(token) <= at[text]:
                    cuts += [hit, hit + len(token)]
                    whole.append((hit, hit + len(token)))
                    hit = raw.find(token, hit + len(token))
                else:
                    hit = raw.find(token, hit + 1)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        cps = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        if not len(cps):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
        kind = self.kind[cps]
        fence = np.zeros(len(cps) + 1, bool)
        fence[np.searchsorted(lead, np.concatenate([at, np.array(cuts, np.int64)]))] = True
        first = fence[:-1]
        last = fence[1:]
        before = np.empty_like(kind)
        before[0], before[1:] = OTHER, kind[:-1]
        start = first | (kind != before)
        blank = kind == SPACE
        final = blank & ~last
        final[:-1] &= ~blank[1:]
        start |= final
        glued = np.zeros(len(cps), bool)
        glued[1:] = (cps[:-1] == 32) & ~blank[1:]
        start &= ~glued | first
        for i in np.flatnonzero((cps == 39) & start & ~last).tolist():
            stop = i + 1
            while stop < min(len(cps), i + 3) and not fence[stop] and kind[stop] == LETTER:
                stop += 1
            tail = "".join(map(chr, cps[i + 1:stop].tolist()))
            size = next((len(e) for e in ENDINGS if tail.startswith(e)), 0)
            if size:
                start[i + 1:i + 1 + size] = False
                end = i + 1 + size
                if end < len(cps) and not fence[end] and kind[end] == LETTER:
                    start[end] = True
        starts = lead[start]
        if whole:
            keep = np.ones(len(starts), bool)
            for a, b in whole:
                keep[np.searchsorted(starts, a + 1):np.searchsorted(starts, b)] = False
            starts = starts[keep]
        return starts, np.append(starts[1:], n), np.searchsorted(starts, at)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin."""
        starts, ends, first = self.pieces(data, at)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        code, distinct = pd.factorize(span_hashes(data, starts, ends))
        example = np.empty(len(distinct), np.int64)
        example[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        raw = data.tobytes()
        found = self.look_up([raw[a:b] for a, b in zip(starts[example].tolist(), ends[example].tolist(), strict=True)])
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(size) - size
        sizes = size[code]
        ids = np.frombuffer(b"".join(found), "<u4")[ragged(begin[code], sizes)]
        total = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(sizes, out=total[1:])
        return ids, total[first]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all id sequences, and where each begins."""
        size = self.size[ids]
        total = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        return self.bytes[ragged(self.begin[ids], size)], total[at]


def vocabulary(path: str) -> Vocabulary:
    """The tables of a file, loaded once per worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def readable(raw: bytes) -> bytes:
    """Bytes as valid UTF-8; broken sequences become the replacement character."""
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace").encode("utf-8")
    return raw


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and `ids`: little-endian unsigned 32-bit ids in one binary value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in chunks(batches, size=ENCODED_BYTES):
            ids, at = vocab.encode(*texts_of(batch.column("text")))
            values = split_bytes(ids.astype("<u4").view(np.uint8), at * 4)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.binary())], ["doc_id", "ids"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with `ids` as `encoded` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            data, at = texts_of(batch.column("ids"))
            out, where = vocab.decode(np.frombuffer(data.tobytes(), "<u4"), at // 4)
            texts = [readable(raw).decode("utf-8") for raw in split_bytes(out, where)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return for_python(rows).select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the ids and the decoded text by their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in chunks(batches, size=ENCODED_BYTES):
            ids, at = vocab.encode(*texts_of(batch.column("text")))
            out, where = vocab.decode(ids, at)
            sha = [hashlib.sha256(v).hexdigest() for v in split_bytes(ids.astype("<u4").view(np.uint8), at * 4)]
            back = [hashlib.sha256(readable(v)).hexdigest() for v in split_bytes(out, where)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(at)), pa.array(sha, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return for_python(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
