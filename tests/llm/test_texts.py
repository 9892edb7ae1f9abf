"""Exact dedup, BPE, packing, window dedup and the Jaccard join against plain Python."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_cases import DATA, ODD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plantpulse.llm import bpe, exact_dedup, exchange, packing, partenum, window_dedup
from plantpulse.operators.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


# Exact dedup

def equal_groups(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    return sorted((i, max(g), len(g), i == max(g), sha(t.encode())) for t, g in groups.items() for i in g)


@pytest.mark.parametrize("which", ["odd", "given", "repeated"])
def test_exact_groups(spark, odd, which):
    df = {"odd": odd, "given": documents(spark), "repeated": odd.union(odd)}[which]
    got = sorted(tuple(r) for r in exact_dedup.exact_groups(df).collect())
    assert got == equal_groups(texts(df))


def test_exact_groups_in_many_runs(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "RUN_ROWS", 3)
    rows = [(i, "same" if i % 3 else f"own {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert exact_dedup.run_count(300) == 256
    assert sorted(tuple(r) for r in exact_dedup.exact_groups(df).collect()) == equal_groups(rows)


def test_exact_plan_has_no_python(spark, odd):
    plan = exact_dedup.exact_groups(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_exact_keep_one(odd, none):
    kept = {r["doc_id"] for r in exact_dedup.keep_one(odd).collect()}
    assert kept == {i for i, _, _, k, _ in equal_groups(ODD) if k}
    assert exact_dedup.keep_one(odd).columns == odd.columns
    assert exact_dedup.exact_groups(none).count() == 0


# BPE

@pytest.fixture(scope="module")
def library(vocab_path):
    return Tokenizer.from_file(vocab_path)


def same_as_library(vocab, library, rows):
    import pyarrow as pa
    ids, at = vocab.encode(*bpe.texts_of(pa.array(rows, pa.string())))
    out, where = vocab.decode(ids, at)
    for k, t in enumerate(rows):
        expected = library.encode(t or "", add_special_tokens=False).ids
        assert ids[at[k]:at[k + 1]].tolist() == expected, t
        assert bpe.readable(out[where[k]:where[k + 1]].tobytes()).decode() == library.decode(
            expected, skip_special_tokens=False)


def test_bpe_is_the_library(vocab_path, library):
    vocab = bpe.vocabulary(vocab_path)
    rng = random.Random(3)
    alphabet = [*"aabst rev'lmd  \n\té中1 !?-", "<|endoftext|>", "'s", "'ll", " '", " ", "\x85", "\x1c"]
    same_as_library(vocab, library, ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(800)])
    same_as_library(vocab, library, [t for _, t in ODD])
    same_as_library(vocab, library, ["x" * 5000, "ab" * 900, "=-" * 2000, "thethe" * 300])


def test_bpe_classes_of_all_characters(vocab_path, library):
    """Every fifth code point, between letters and digits."""
    vocab = bpe.vocabulary(vocab_path)
    points = [c for c in range(0, 0x110000, 5) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 20000):
        same_as_library(vocab, library, [" ".join(f"a{chr(c)}1{chr(c)}{chr(c)}b" for c in points[k:k + 20000])])


def test_bpe_long_and_short_pieces_agree(vocab_path):
    vocab, rng = bpe.vocabulary(vocab_path), random.Random(5)
    pieces = list({bytes(rng.choices(b"theandiorsg ", k=rng.randint(1, 60))) for _ in range(500)})
    short = vocab.merge_by_scan(pieces)
    for piece, ids in zip(pieces, short, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == vocab.merge_by_heap([vocab.byte_id[b] for b in piece])


def test_bpe_query(spark, odd, none, vocab_path, library):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in bpe.round_trip(odd, vocab_path).collect()}
    for i, t in ODD:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode()))
    back = {r["doc_id"]: r["text"] for r in bpe.decoded(bpe.encoded(odd, vocab_path), vocab_path).collect()}
    assert back == {i: t or "" for i, t in ODD}
    assert bpe.round_trip(none, vocab_path).count() == 0


# Packing

def optimum(items, size):
    best = [(99, 0)] * (1 << len(items))
    best[0] = (0, size)
    for mask in range(1 << len(items)):
        bins, room = best[mask]
        for i, w in enumerate(items):
            if not mask >> i & 1:
                best[mask | 1 << i] = min(best[mask | 1 << i], (bins, room + w) if room + w <= size else (bins + 1, w))
    return best[-1][0]


def places(counts, size):
    runs = packing.solve(counts, size)
    bins = collections.defaultdict(list)
    for s, n in counts.items():
        sequence, offset = packing.place(runs, np.full(n, s), np.arange(n))
        for b, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            bins[b].append((o, s))
    for parts in bins.values():
        end = 0
        for o, s in sorted(parts):
            assert o == end
            end += s
        assert end <= size
    assert len(bins) == runs.sequences
    return runs.sequences


def test_packing_is_close_to_the_optimum():
    rng, extra = random.Random(1), 0
    for _ in range(200):
        size = rng.choice([10, 20, 30])
        items = [rng.randint(1, size) for _ in range(rng.randint(1, 10))]
        extra += places(collections.Counter(items), size) - optimum(items, size)
    assert 0 <= extra <= 2


def test_reduction_keeps_the_optimum():
    """Fixed sets together with the best packing of what is left are a best packing of all."""
    rng, fixed_sets = random.Random(2), 0
    for _ in range(300):
        size = rng.choice([12, 20, 40])
        items = [rng.randint(2, size) for _ in range(rng.randint(2, 9))]
        left = dict(collections.Counter(items))
        fixed = sum(times for _, times in packing.reduce_by_dominance(left, size))
        fixed_sets += fixed
        assert fixed + optimum([s for s, n in left.items() for _ in range(n)], size) == optimum(items, size)
    assert fixed_sets > 300


def test_packing_large_counts():
    counts = {s: 10 ** 9 + s for s in range(1, 2049)}
    runs = packing.solve(counts, 2048)
    assert runs.sequences <= 1.02 * sum(s * n for s, n in counts.items()) / 2048
    assert len(runs.length) < 50_000
    assert packing.solve({}, 2048).sequences == 0


def packed_ok(rows, docs, library, size):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    for i, t in docs:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        assert sum(r["length"] for r in parts) == len(ids)
        assert all(r["length"] == size for r in parts[1:])
        for r in parts:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]


@pytest.mark.parametrize("size", [64, 2048])
def test_packed_documents(odd, none, vocab_path, library, size):
    packed_ok(packing.packed_documents(odd, vocab_path, size).collect(), ODD, library, size)
    assert packing.packed_documents(none, vocab_path, size).count() == 0


def test_packed_given_documents(spark, vocab_path, library, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ROWS", 17)
    rows = packing.packed_documents(documents(spark), vocab_path).collect()
    packed_ok(rows, texts(documents(spark)), library, 2048)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 2048) + 1


def test_packed_sequences(odd, vocab_path):
    packed = packing.packed_documents(odd, vocab_path, 64, with_ids=True).cache()
    found = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        part = found[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])]
        assert zlib.crc32(part) == r["ids_crc32"]


# Window dedup

def without_repeats(rows, width):
    first, split = {}, [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in sorted(split):
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k:k + width]), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < i:
                gone[k:k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), sha(kept.encode())))
    return sorted(out)


@pytest.mark.parametrize("which", ["odd", "given", "repeated"])
def test_window_dedup(spark, odd, which):
    df = {"odd": odd, "given": documents(spark), "repeated": odd.union(odd)}[which]
    for width in (2, 13):
        got = sorted(tuple(r) for r in window_dedup.without_repeats(df, width).collect())
        assert got == without_repeats(texts(df), width)


def test_window_dedup_over_many_chunks(spark, monkeypatch):
    from plantpulse.llm import arrays
    monkeypatch.setattr(arrays, "CHUNK_BYTES", 500)
    monkeypatch.setattr(window_dedup, "GROUP_BYTES", 3000)
    rng = random.Random(4)
    shared = " ".join(rng.choices("abcdefgh", k=30))
    rows = [(i, " ".join([*rng.choices("abc", k=rng.randint(0, 40)), shared, *rng.choices("abc", k=9)])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted(tuple(r) for r in window_dedup.without_repeats(df, 5).collect()) == without_repeats(rows, 5)


def test_window_dedup_text_and_intervals(spark, none):
    rows = [(1, "a b c d e"), (2, "x a b c y  b c d z"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in window_dedup.without_repeats(df, 3, with_text=True).collect()}
    assert got[2]["kept"] == "x y z" and [tuple(i) for i in got[2]["removed"]] == [(1, 4), (5, 8)]
    assert got[1]["kept"] == "a b c d e" and got[3]["kept"] == ""
    assert window_dedup.without_repeats(none).count() == 0


def test_window_dedup_bucket_bits():
    """Results do not depend on the number of buckets, and buckets grow with the text."""
    assert window_dedup.bucket_count(0) == 64
    assert window_dedup.bucket_count(10 ** 14) > window_dedup.bucket_count(10 ** 10)
    for bits in (1, 6, 8, 11, 20):
        assert bits + exchange.low_bits(bits) <= 64 and exchange.low_bits(bits) <= 56


# Jaccard join

def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= 75 * len(a | b) and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return sorted((i, len(s), root(i)) for i, s in sets.items())


def near_copies(rng, n):
    """Families of texts with a few words changed each, of all sizes, and texts that share a passage only."""
    words = [f"w{k}" for k in range(4000)]
    passage = rng.choices(words, k=25)
    rows = []
    while len(rows) < n:
        base = rng.choices(words, k=int(2 ** rng.uniform(0, 9)))
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            copy += rng.choices(words, k=rng.choice([0, 0, 0, len(base) // 8]))
            rows.append((len(rows), " ".join(copy if rng.random() < 0.7 else passage + copy)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_groups(spark, seed, monkeypatch):
    monkeypatch.setattr(partenum, "GROUP_BYTES", 50_000)
    rows = near_copies(random.Random(seed), 400)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(tuple(r) for r in partenum.near_groups(df).collect()) == near_groups(rows)


def phrases_that_recur(groups):
    """Linked pairs whose phrases recur in unrelated texts, with other candidates before and between the two."""
    rng, made = random.Random(groups), iter(range(10 ** 9))
    own = lambda n: [f"w{next(made)}" for _ in range(n)]
    rows = []
    for g in range(groups):
        text = own(30)
        other = text[:27] + own(3)
        first, second = own(25) + other[23:28], own(25) + other[25:30]
        unrelated = [text[:rng.randint(8, 27)] for _ in range(12)] + [t[:29] for t in (first, second) for _ in range(8)]
        rows += [(100 * g + k, t) for k, t in enumerate([first, text, second, other, *[t + own(60 - len(t)) for t in unrelated]])]
    return [(i, " ".join(t)) for i, t in rows]


def test_near_groups_with_phrases_that_recur(spark):
    """The first signature of two sets depends on texts that are no candidates."""
    rows = phrases_that_recur(20)
    want = near_groups(rows)
    assert sum(i != c for i, _, c in want) == 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in partenum.near_groups(df).collect()) == want


def test_near_groups_of_repeated_ids(spark):
    """An id with two texts keeps the links of both; its rows get one component."""
    a, b, c = ([f"{name}{k}" for k in range(40)] for name in "abc")
    rows = [(1, a), (5, a), (5, b), (7, b[:39] + ["x"]), (9, c), (8, c[:39] + ["y"]), (3, ["z"] * 9)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in partenum.near_groups(df).collect()}
    assert got == {(1, 1), (5, 1), (7, 1), (9, 8), (8, 8), (3, 3)}


def test_near_groups_odd(odd, none):
    assert sorted(tuple(r) for r in partenum.near_groups(odd).collect()) == near_groups(ODD)
    kept = {r["doc_id"] for r in partenum.keep_one(odd).collect()}
    assert kept == {i for i, _, c in near_groups(ODD) if i == c}
    assert partenum.keep_one(odd).columns == odd.columns
    assert partenum.near_groups(none).count() == 0
    assert sorted(tuple(r) for r in partenum.near_groups(odd.union(odd)).collect()) == sorted(near_groups(ODD) * 2)


def test_signatures_meet_for_all_similar_sets():
    """Two sets at or above the similarity share a signature among their rarest (differences + 1), in any order."""
    rng = np.random.default_rng(8)
    for _ in range(1500):
        n = int(2 ** rng.uniform(0, 8))
        base = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64))
        take = rng.random(len(base)) < rng.uniform(0.7, 1)
        other = np.union1d(base[take], rng.integers(0, 2 ** 63, rng.integers(0, n // 4 + 1), dtype=np.uint64))
        if not len(other) or 4 * len(np.intersect1d(base, other)) < 3 * len(np.union1d(base, other)):
            continue
        values = np.concatenate([base, other])
        at = np.array([0, len(base), len(values)])
        owner, _, differ, begin, found, _ = partenum.signatures(values, at)
        chosen = [set(), set()]
        for e, own in enumerate(owner.tolist()):
            ranked = sorted(found[begin[e]:begin[e + 1]].tolist(), key=lambda s: (s * 2654435761) % 1000003)
            chosen[own] |= set(ranked[:int(differ[e]) + 1])
        assert chosen[0] & chosen[1]


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (12, 11), (20, 20), (5, 4), (2, 1)] + [(100 + k, 101 + k) for k in range(60)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 12: 10, 4: 4, 5: 4} | {100 + k: 100 for k in range(61)}
    assert components(df.where(F.lit(False))).count() == 0
