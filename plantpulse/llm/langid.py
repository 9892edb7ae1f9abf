"""Language by cross-parsing entropy.

From a bounded sample of labelled text a suffix automaton is built per language: it reads
exactly the substrings of the sample. A text is parsed greedily into the longest phrases
that a language's sample holds; when the automaton cannot read on, a phrase ends and the
next begins. Phrases times log2 of the longest sample, per symbol, estimate the cross entropy;
the language with the least wins, ties to the first by name. Samples are cut to the length of
the shortest, though not below `LEAST_SYMBOLS`, and a phrase has one price in all languages: a
language with little text reads short phrases and wins only where the others read shorter ones.

Symbols: letters in lower case, any run of other characters as one blank. The commonest
letters of the samples, each language weighing alike, have numbers; the others are spelled by
their rank with a fixed count of sixteen digits, so scripts of many letters lose none. A letter
that no sample holds is a phrase of its own everywhere. Texts are parsed in blocks of `BLOCK`
symbols, all blocks of a batch in step, so that a batch holds one very long text as well as
many short ones; a block's end also ends a phrase, for all languages alike.

Bounds (parameters): `SAMPLE_SYMBOLS` symbols per language, from `SAMPLE_ROWS` rows taken
in the order of a hash of the id, one piece of `PIECE` characters of each, at a place given
by the hash.

Defined results: `und` with score 0 for null text, text without a letter, or when nothing
could be learned. The score is the winner's share as `confidence` states it. Repeated rows are predicted each for itself; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.tables import for_python

#: Rows and symbols of a language's sample, characters taken of a row, symbols of a block.
SAMPLE_ROWS, SAMPLE_SYMBOLS, PIECE, BLOCK = 400, 60_000, 400, 1024
#: Samples are not cut below this many symbols; letters with a number of their own; digits for the others.
LEAST_SYMBOLS, COMMON, DIGITS = 20_000, 46, 16
#: Characters that are handled at once.
CHUNK_CHARS = 2_000_000
BLANK = 0
_AUTOMATA: dict[str, "Automata"] = {}
_KIND: list[np.ndarray] = []


def folding() -> np.ndarray:
    """For every code point: its lower-case letter, or 0 where it is no letter."""
    if not _KIND:
        fold = np.zeros(0x110000, np.uint32)
        for cp in range(0x110000):
            ch = chr(cp)
            if unicodedata.category(ch)[0] == "L":
                low = ch.lower()
                fold[cp] = ord(low) if len(low) == 1 else cp
        _KIND.append(fold)
    return _KIND[0]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded letters of all texts with 0 for each run of others, and where each text begins."""
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    folded = folding()[raw]
    letter = folded > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a run of others, the first
    inside = at[:-1][np.diff(at) > 0]
    keep[inside] = letter[inside]  # no blank at the start of a text
    total = np.concatenate([[0], np.cumsum(keep)])
    return folded[keep], total[at]


def suffix_automaton(seq: list[int], width: int) -> np.ndarray:
    """Transitions [state, symbol] of the automaton of all substrings; -1 where there is none."""
    following: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in seq:
        new = len(following)
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(following)
                following.append(following[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    table = np.full((len(following), width), -1, np.int32)
    for state, edges in enumerate(following):
        for c, to in edges.items():
            table[state, c] = to
    return table


class Automata:
    """One parsing table per language. Where a phrase ends, the entry is the complement of the next state."""

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        parts = {name: symbols([samples[name]])[0] for name in self.names}
        share = Counter()
        for part in parts.values():
            for symbol, n in Counter(part.tolist()).items():
                share[symbol] += n / len(part)
        letters = [s for s, _ in sorted(share.items(), key=lambda kv: (-kv[1], kv[0])) if s != 0]
        common, rare = letters[:COMMON], letters[COMMON:]
        self.places = 0
        while DIGITS ** self.places < len(rare) or (rare and not self.places):
            self.places += 1
        self.first_digit = len(common) + 1
        # Blank, letters, digits if any letter needs them, and the code of letters that no sample holds.
        self.width = self.first_digit + (DIGITS if rare else 0) + 1
        self.code = np.full(0x110000, self.width - 1, np.uint8)
        self.code[0] = BLANK
        for k, s in enumerate(common):
            self.code[s] = k + 1
        self.rank = np.full(0x110000 if rare else 0, -1, np.int32)
        self.rank[rare] = np.arange(len(rare)) if rare else 0
        self.tables, self.bits = [], []
        coded = {name: self.coded(part, np.array([0, len(part)]))[0][:SAMPLE_SYMBOLS] for name, part in parts.items()}
        length = max([LEAST_SYMBOLS, min(map(len, coded.values()), default=0)])
        coded = {name: seq[:length] for name, seq in coded.items()}
        price = np.log2(max([2, *map(len, coded.values())]))
        for name in self.names:
            seq = coded[name]
            table = suffix_automaton(seq.tolist(), self.width)
            # A symbol that the sample lacks is a phrase of its own: a last state that reads nothing.
            root = np.where(table[0] >= 0, table[0], len(table)) * self.width
            ends = np.broadcast_to(~root, (len(table) + 1, self.width)).astype(np.int32)
            ends[:-1][table >= 0] = table[table >= 0] * self.width
            ends[0] = root
            self.tables.append(ends.ravel())
            self.bits.append(price)

    def coded(self, folded: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all symbols, and where each text begins among them."""
        codes = self.code[folded]
        rank = self.rank[folded] if len(self.rank) else np.full(1, -1)
        if not (rank >= 0).any():
            return codes, at
        size = np.where(rank >= 0, self.places, 1)
        ends = np.concatenate([[0], np.cumsum(size)])
        out = np.repeat(codes, size)
        spelled = np.flatnonzero(rank >= 0)
        for place in range(self.places):
            digit = rank[spelled] // DIGITS ** (self.places - 1 - place) % DIGITS
            out[ends[spelled] + place] = self.first_digit + digit
        return out, ends[at]

    def entropies(self, folded: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Estimated cross entropy of each text [text, language], in bits per symbol."""
        letters = np.diff(at)
        coded, at = self.coded(folded, at)
        size = np.diff(at)
        per = -(-size // BLOCK)
        owner = np.repeat(np.arange(len(size)), per)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        begin = at[:-1][owner] + nth * BLOCK
        length = np.minimum(size[owner] - nth * BLOCK, BLOCK)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        live = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")
        out = np.zeros((len(size), len(self.names)))
        state = [np.zeros(len(owner), np.int32) for _ in self.names]
        phrases = [np.ones(len(owner), np.int32) for _ in self.names]
        for step, n in enumerate(live.tolist()):
            symbol = coded[begin[:n] + step]
            for table, s, count in zip(self.tables, state, phrases, strict=True):
                to = table[s[:n] + symbol]
                ended = to >> 31  # -1 where a phrase ended
                count[:n] -= ended
                np.bitwise_xor(to, ended, out=s[:n])
        for k, count in enumerate(phrases):
            out[:, k] = np.bincount(owner, count, len(size)) * self.bits[k]
        return out / np.maximum(letters, 1)[:, None]


def automata(samples: dict[str, str]) -> Automata:
    """Built once per worker."""
    key = hashlib.sha256(pickle.dumps(sorted(samples.items()))).hexdigest()
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = Automata(samples)
    return _AUTOMATA[key]


def confidence(entropy: np.ndarray) -> np.ndarray:
    """Share of the best language when each weighs 2 to the minus 8 times its bits per symbol."""
    gap = entropy - entropy.min(axis=1, keepdims=True)
    return 1 / np.exp2(-8 * gap).sum(axis=1)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def learn(docs: DataFrame) -> dict[str, str]:
    """Sample text per language from rows that are not held out."""
    rows = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & (F.length("text") > 0))
    rows = rows.select("lang", F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = F.xxhash64("doc_id")
    place = F.pmod(F.xxhash64("doc_id", F.lit("piece")), F.greatest(F.length("text") - PIECE + 1, F.lit(1)))
    piece = F.substring("text", (place + 1).cast("int"), F.lit(PIECE))
    # One row of each bucket, the first by hash: a sample of fixed size from partial aggregates.
    bucket = F.pmod(order, F.lit(SAMPLE_ROWS))
    picked = (rows.select("lang", bucket.alias("bucket"), F.struct(order.alias("h"), "doc_id", piece.alias("piece")).alias("row"))
              .groupBy("lang", "bucket").agg(F.min("row").alias("row")).select("lang", "row.*"))
    samples: dict[str, list] = {}
    for r in picked.toArrow().to_pylist():
        samples.setdefault(r["lang"], []).append((r["h"], r["doc_id"], r["piece"]))
    return {lang: " ".join(p for _, _, p in sorted(rows)) for lang, rows in samples.items()}


def predicted(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = automata(samples)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            begin = 0
            while begin < len(texts):
                end, chars = begin, 0
                while end < len(texts) and (end == begin or chars + len(texts[end]) <= CHUNK_CHARS):
                    chars += len(texts[end])
                    end += 1
                folded, at = symbols(texts[begin:end])
                lang, score = np.full(end - begin, "und", object), np.zeros(end - begin)
                some = np.diff(at) > 0
                if model.names and some.any():
                    entropy = model.entropies(folded, at)
                    best = np.array(model.names, object)[entropy.argmin(axis=1)]
                    lang[some], score[some] = best[some], confidence(entropy)[some]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(begin, end - begin), pa.array(lang, pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"])
                begin = end

    rows = for_python(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double").select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
