"""Exact Jaccard join of shingle sets by PartEnum signatures.

Sets of one size band share a partition of the hash domain into equal ranges. Two sets with
a similarity of 3/4 differ in at most (|r| + |s|) / 7 shingles, so all but that many of
their partitions agree. A signature is the content of one non-empty partition. A set with
more non-empty partitions than the largest difference allowed thus shares a signature with
every set it links with, and the subsets of partitions that have to be enumerated are
single ones. Sets too small or unlucky for that (no more non-empty partitions than
differences) all get one signature of their band. A set that may link with larger ones of
the next band also gets signatures there.

Which signatures lead to candidates is settled by exact counts:

1. Texts are dealt to groups by a hash of the id. A group sends each distinct signature once,
   packed by bucket; buckets return, to each group, the signatures that more than one set
   has, with their number.
2. A set with fewer repeated signatures than must agree has no link. Of the others, ordered by
   rarity, the first (differences + 1) signatures suffice: two linked sets meet in one of them.
3. Equal sets fall into one class. In a few rounds every set is compared with one set of
   another component that shares a signature with it, and components are joined by the
   links found, so a large group of near copies costs a few comparisons per member. Then
   all pairs of sets that share a signature and are still in different components are
   compared, except those ruled out by position: two linked sets differ in every partition
   whose signature is rarer than the first they share, so they cannot meet first in a
   signature that comes after more partitions of the two than shingles may differ; and by
   short prints of their shingles by hash slot, of which no more may differ either. No link
   between different sets is lost.

Sets travel as sorted 64-bit hashes, so counts and comparisons are exact up to a chance
agreement of hashes (about 10^-13 for a pair of long texts).

Defined results: null or empty text, or text without words, has an empty set and is linked
with nothing; fewer words than a shingle are one shingle. Rows that repeat an id belong to
one component. A null id counts as larger than all others and its row has a null id. Other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.arrays import chunks, lower_ascii, mix, span_hashes, window_hashes, words
from plantpulse.llm.exchange import NO_ID, low_bits, texts_by_group, unpack, unpacked_texts
from plantpulse.llm.tables import power_of_two, text_bytes
from plantpulse.operators.components import components
from plantpulse.session import stage_table

#: Words of a shingle; similarity as a fraction.
SHINGLE, SHARE, WHOLE = 5, 3, 4
#: Sizes of band i start at RATIO ** i; a band has at least LEAST_PARTS partitions.
RATIO, LEAST_PARTS = 4, 64
#: Bytes of text of a group; signatures of a bucket, and the least number of buckets.
GROUP_BYTES, BUCKET_SIGNATURES, LEAST_BUCKETS = 4_000_000, 1_000_000, 64
#: 64-bit words that mark partitions (by their number, folded); rounds of single comparisons.
MARK_WORDS, ROUNDS = 8, 2
#: 64-bit words of four-bit prints of the shingles in each hash slot.
PRINT_WORDS = 16
WORD_BYTES = 6


def shingle_sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, and where each text's begin."""
    data = lower_ascii(data)
    starts, ends, first = words(data, at)
    word = span_hashes(data, starts, ends)
    size = np.diff(first)
    owner = np.repeat(np.arange(len(size)), size)
    hashes = window_hashes(word, SHINGLE)
    place = np.flatnonzero(owner[:max(0, len(owner) - SHINGLE + 1)] == owner[SHINGLE - 1:])
    hashes, owner = hashes[place], owner[place]
    few = np.flatnonzero((size > 0) & (size < SHINGLE))
    if len(few):
        short = [window_hashes(word[first[k]:first[k + 1]], int(size[k]))[0] ^ np.uint64(size[k]) for k in few.tolist()]
        hashes, owner = np.concatenate([hashes, np.array(short, np.uint64)]), np.concatenate([owner, few])
    order = np.argsort(hashes)
    order = order[np.argsort(owner[order].astype(np.uint16 if len(size) < 65536 else np.int64), kind="stable")]
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(len(size) + 1))


def bands(size: np.ndarray) -> np.ndarray:
    """The band of each size (0 for size 0)."""
    edges = np.array([RATIO ** i for i in range(1, 31)], np.int64)
    return np.searchsorted(edges, size, side="right")


def parts_of(band: np.ndarray) -> np.ndarray:
    return np.maximum(LEAST_PARTS, 2 * RATIO ** band.astype(np.int64)).astype(np.uint64)


def signatures(hashes: np.ndarray, at: np.ndarray):
    """Signatures of all sets with their partition (-1: none). For each (set, band) entry its set, band, largest
    difference and where its signatures begin."""
    size = np.diff(at)
    band = bands(size)
    largest = size * WHOLE // SHARE
    upper = np.array([RATIO ** (i + 1) - 1 for i in range(31)], np.int64)
    own = np.flatnonzero(size > 0)
    crossing = np.flatnonzero((size > 0) & (largest > upper[band]))
    owner = np.concatenate([own, crossing])
    level = np.concatenate([band[own], band[crossing] + 1])
    mate = np.concatenate([np.minimum(largest, upper[band])[own], largest[crossing]])
    differ = (size[owner] + mate) * (WHOLE - SHARE) // (WHOLE + SHARE)
    length = size[owner]
    entry = np.repeat(np.arange(len(owner)), length)
    source = np.repeat(at[:-1][owner] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    value = hashes[source]
    part = ((value >> np.uint64(32)) * parts_of(level)[entry]) >> np.uint64(32)
    fresh = np.ones(len(value), bool)
    fresh[1:] = (entry[1:] != entry[:-1]) | (part[1:] != part[:-1])
    begin = np.flatnonzero(fresh)
    if not len(begin):
        return owner, level, differ, np.zeros(len(owner) + 1, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    content = np.add.reduceat(mix(value), begin)
    of = entry[begin]
    found = mix(content + mix(level[of].astype(np.uint64) + np.uint64(1)))
    where = np.searchsorted(of, np.arange(len(owner) + 1))
    place = part[begin].astype(np.int64)
    # Sets without a spare partition share one signature of their band.
    poor = np.flatnonzero(np.diff(where) <= differ)
    if len(poor):
        found = np.insert(found, where[poor + 1], mix(level[poor].astype(np.uint64) + np.uint64(1 << 40)))
        place = np.insert(place, where[poor + 1], -1)
        where = where + np.concatenate([[0], np.cumsum(np.diff(where) <= differ)])
    return owner, level, differ, where, found, place


def cut_short(found: np.ndarray, bits: int) -> np.ndarray:
    """Signatures of as many bits as travel: 56 and those of the bucket number, 64 at most."""
    return found >> np.uint64(64 - bits - low_bits(bits))


def send(texts: DataFrame, bits: int) -> DataFrame:
    """Distinct signatures of each group, packed by bucket (leading bits left out); those of several sets of the
    group also with their number."""
    low = np.uint64(low_bits(bits))

    def run(table: pa.Table) -> pa.Table:
        group = table.column("bucket")[0].as_py()
        ids, data, at = unpacked_texts(table)
        hashes, where = shingle_sets(data, at)
        found = cut_short(signatures(hashes, where)[4], bits)
        value, count = np.unique(found, return_counts=True)
        cut = np.searchsorted(value >> low, np.arange((1 << bits) + 1, dtype=np.uint64))
        raw = value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]
        rows = [(k, group, raw[a:b].tobytes(), value[a:b][many].tobytes(), (count[a:b][many]).astype("<i8").tobytes())
                for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if b > a
                for many in [count[a:b] > 1]]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                    ["bucket", "sender", "values", "many", "counts"])

    return texts.groupBy("bucket").applyInArrow(
        run, "bucket int, sender int, values binary, many binary, counts binary")


def answer(sent: DataFrame, bits: int) -> DataFrame:
    """To each group (`bucket`): its signatures that several sets have, and how many have them."""
    low = np.uint64(low_bits(bits))
    keep = (np.uint64(1) << low) - np.uint64(1)

    def run(table: pa.Table) -> pa.Table:
        senders = np.array(table.column("sender").to_pylist(), np.int32)
        high = np.uint64(table.column("bucket")[0].as_py()) << low
        parts = [unpack(b"", b"", v, 7)[1] for v in table.column("values").to_pylist()]
        many = np.concatenate([np.frombuffer(v, "<u8") for v in table.column("many").to_pylist()])
        extra = np.concatenate([np.frombuffer(v, "<i8") for v in table.column("counts").to_pylist()]) - 1
        value = (np.concatenate(parts) & keep) | high
        sender = np.repeat(senders, [len(p) for p in parts])
        order = np.argsort(value)
        value, sender = value[order], sender[order]
        begin = np.flatnonzero(np.diff(value, prepend=value[:1] + np.uint64(1)))
        total = np.diff(begin, append=len(value))
        np.add.at(total, np.searchsorted(value[begin], many), extra)
        several = np.repeat(total > 1, np.diff(begin, append=len(value)))
        total = np.repeat(total, np.diff(begin, append=len(value)))
        value, sender, total = value[several], sender[several], total[several]
        order = np.argsort(sender, kind="stable")
        value, sender, total = value[order], sender[order], total[order]
        cut = [0, *(np.flatnonzero(np.diff(sender)) + 1).tolist(), len(sender)]
        rows = [(int(sender[a]), value[a:b].tobytes(), total[a:b].astype("<i8").tobytes())
                for a, b in zip(cut[:-1], cut[1:], strict=True) if b > a]
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.binary(), pa.binary()], strict=True)],
                                    ["bucket", "values", "totals"])

    return sent.groupBy("bucket").applyInArrow(run, "bucket int, values binary, totals binary")


CHOSEN = pa.struct([("band", pa.int32()), ("lone", pa.list_(pa.int32())), ("signatures", pa.list_(pa.int64())),
                    ("places", pa.list_(pa.int32())), ("numbers", pa.list_(pa.int64()))])
SETS = ("doc_id long, n long, d1 long, d2 long, "
        "chosen array<struct<band:int,lone:array<int>,signatures:array<long>,places:array<int>,numbers:array<long>>>, "
        "prints array<long>, hashes binary")


def prints(hashes: np.ndarray) -> np.ndarray:
    """Four bits of each shingle, combined per hash slot: sets that differ in d shingles differ in d slots at most."""
    slots = np.zeros(16 * PRINT_WORDS, np.uint8)
    np.bitwise_xor.at(slots, ((hashes >> np.uint64(8)) % np.uint64(len(slots))).astype(np.int64),
                      (hashes & np.uint64(15)).astype(np.uint8))
    return (slots[::2] | slots[1::2] << 4).view("<i8")


def choose(texts: DataFrame, answers: DataFrame, bits: int) -> DataFrame:
    """One row per text: size and digest of its set; where a link is possible, the set and per band its chosen
    signatures, rarest first, with their partitions and numbers, and the partitions that no other set shares."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, data, at = unpacked_texts(left)
        hashes, where = shingle_sets(data, at)
        owner, level, differ, begin, found, place = signatures(hashes, where)
        found = cut_short(found, bits)
        value = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(v, "<u8") for v in right.column("values").to_pylist())])
        total = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(v, "<i8") for v in right.column("totals").to_pylist())])
        order = np.argsort(value)
        value, total = np.append(value[order], np.uint64(0)), np.append(total[order], 0)
        spot = np.minimum(np.searchsorted(value[:-1], found), max(0, len(value) - 2))
        number = np.where(value[spot] == found, total[spot], 1)
        repeated = np.concatenate([[0], np.cumsum(number > 1)])
        repeated = repeated[begin[1:]] - repeated[begin[:-1]]
        single = np.diff(begin) - repeated
        chosen: list[list[dict] | None] = [None] * len(ids)
        for e in np.flatnonzero((repeated > 0) & (single <= differ)).tolist():
            a, b = begin[e], begin[e + 1]
            rank = np.lexsort((found[a:b], number[a:b]))
            lone, rank = rank[:single[e]], rank[single[e]:differ[e] + 1]
            # A shared signature without a partition marks none.
            own, alone = int(owner[e]), place[a:b][lone]
            chosen[own] = [*(chosen[own] or []), {
                "band": int(level[e]), "lone": (alone[alone >= 0] % (64 * MARK_WORDS)).astype(np.int32),
                "signatures": found[a:b][rank].view(np.int64), "places": place[a:b][rank].astype(np.int32),
                "numbers": number[a:b][rank]}]
        size = np.diff(where)
        digest = []
        for values in (hashes, mix(hashes ^ np.uint64(0x5851F42D4C957F2D))):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
            digest.append(mix(sums[where[1:]] - sums[where[:-1]]).view(np.int64))
        sets = [hashes[where[k]:where[k + 1]].tobytes() if c else None for k, c in enumerate(chosen)]
        marks = [prints(hashes[where[k]:where[k + 1]]) if c else None for k, c in enumerate(chosen)]
        return pa.Table.from_arrays(
            [pa.array(ids), pa.array(size), pa.array(digest[0]), pa.array(digest[1]),
             pa.array(chosen, pa.list_(CHOSEN)), pa.array(marks, pa.list_(pa.int64())), pa.array(sets, pa.binary())],
            ["doc_id", "n", "d1", "d2", "chosen", "prints", "hashes"])

    return texts.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(run, SETS)


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, and any other columns) whose sets reach the similarity."""
    names = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A pair brings two whole sets, so pairs are taken by the bytes of the first.
        for batch in chunks(batches, "x"):
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(WHOLE * common >= SHARE * (len(x) + len(y) - common))
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(x, "a").join(y, "b").select(*names, "x", "y").mapInArrow(run, pairs.schema)


def near_size(n: Column, m: Column) -> Column:
    """Sizes of sets that can reach the similarity."""
    return (n * WHOLE >= m * SHARE) & (m * WHOLE >= n * SHARE)


def may_link(a: str, b: str) -> Column:
    """Whether sizes, the partitions before the shared signature, and the prints leave room for a link, and the
    signature is the first that the two share: so each pair is met once."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    marks = [F.bit_count(F.col(f"{a}.mark_{k}").bitwiseOR(F.col(f"{b}.mark_{k}"))) for k in range(MARK_WORDS)]
    differ = [_differing(F.col(f"{a}.print_{k}").bitwiseXOR(F.col(f"{b}.print_{k}"))) for k in range(PRINT_WORDS)]
    room = (n + m) * (WHOLE - SHARE)
    return (near_size(n, m) & (sum(marks[1:], marks[0]) * (WHOLE + SHARE) <= room)
            & (sum(differ[1:], differ[0]) * (WHOLE + SHARE) <= room)
            & ~F.arrays_overlap(f"{a}.earlier", f"{b}.earlier"))


def _differing(x: Column) -> Column:
    """How many groups of four bits are not zero."""
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
    return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))


def marked(bands: DataFrame, opened: DataFrame) -> DataFrame:
    """Open entries with the size of their set, marks of the partitions whose signatures come before, and the open
    signatures among these: the first that two sets share is always open."""
    names = ["signature", "doc_id", "component", "n", *[f"mark_{k}" for k in range(MARK_WORDS)],
             *[f"print_{k}" for k in range(PRINT_WORDS)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                places = np.array([p % (64 * MARK_WORDS) if p >= 0 else -1 for p in r["places"]], np.int64)
                wanted = set(r["open"])
                keep = [k for k, sig in enumerate(r["signatures"]) if sig in wanted]
                marks = np.zeros((len(places) + 1, 64 * MARK_WORDS), np.uint8)
                later = np.flatnonzero(places >= 0)
                marks[later + 1, places[later]] = 1
                marks[0, r["lone"]] = 1
                words = np.packbits(np.maximum.accumulate(marks)[keep], axis=1, bitorder="little").view("<i8")
                count = len(keep)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["signatures"][k] for k in keep], pa.int64()), *(
                        pa.array(np.full(count, r[c], np.int64)) for c in ("doc_id", "component", "n")),
                     *(pa.array(np.ascontiguousarray(words[:, k])) for k in range(MARK_WORDS)),
                     *(pa.array(np.full(count, x, np.int64)) for x in r["prints"]),
                     pa.array([[r["signatures"][k] for k in keep[:i]] for i in range(count)], pa.list_(pa.int64()))],
                    [*names, "earlier"])

    mine = opened.groupBy("doc_id", "band").agg(F.first("component").alias("component"),
                                                F.collect_list("signature").alias("open"))
    rows = bands.join(mine, ["doc_id", "band"]).select(
        "doc_id", "n", "component", "lone", "signatures", "places", "prints", "open")
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names) + ", earlier array<long>")


def placed(entry: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Entries with the component that their set is known to belong to: at first its own."""
    return entry.withColumn("component", F.col("doc_id")) if labels is None else entry.join(labels, "doc_id")


def one_each(now: DataFrame, turn: int) -> DataFrame:
    """For every set beside the lowest component of a signature, one set of that component, with both components."""
    hub = now.groupBy("signature").agg(F.min("component").alias("p"), F.max("component").alias("high"),
                                       F.min_by("doc_id", "component").alias("a")).where("p < high").drop("high")
    met = now.join(hub, "signature").where("component > p")
    pick = F.max_by if turn % 2 else F.min_by
    return met.groupBy(F.col("doc_id").alias("b"), F.col("component").alias("q")).agg(
        pick("a", "a").alias("a"), pick("p", "a").alias("p"))


def open_entries(now: DataFrame) -> DataFrame:
    """Entries of the signatures whose sets are in several components.

    Of signatures that the same sets have, the first in the order of `choose` stands for
    all: where two sets meet first is never left out. The number belongs to that order, as
    it counts sets that have a signature but did not choose it. An id that has several
    sets does not tell which of them is meant, so its signatures all stay.
    """
    apart = now.groupBy("signature").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members"),
        F.min("number").alias("number"), F.max(F.when(F.col("again"), F.col("signature"))).alias("own"),
        F.bit_xor(F.xxhash64("doc_id")).alias("who"), F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("who_else"))
    # Signatures are ordered as unsigned numbers; flipping the sign bit orders them as signed ones.
    order = F.struct("number", F.col("signature").bitwiseXOR(F.lit(-(1 << 63))).alias("unsigned"))
    once = apart.where("low < high").groupBy("members", "who", "who_else", "own").agg(F.min(order).alias("first"))
    once = once.select(F.col("first.unsigned").bitwiseXOR(F.lit(-(1 << 63))).alias("signature"))
    return now.join(once, "signature", "left_semi")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; components of links with a Jaccard similarity of 3/4 or more."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    _, size = text_bytes(docs)
    groups = max(1, -(-size // GROUP_BYTES))
    bits = power_of_two(size / WORD_BYTES / BUCKET_SIGNATURES, LEAST_BUCKETS).bit_length() - 1
    texts = texts_by_group(docs, groups)
    rows = stage_table(choose(texts, answer(send(texts, bits), bits), bits))

    # Equal sets are one class, represented by its smallest id.
    classes = rows.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("class"), F.count(F.lit(1)).alias("copies"))
    classes = classes.where("copies > 1").drop("copies")
    known = rows.select("doc_id", "n", "d1", "d2").join(classes, ["n", "d1", "d2"], "left")
    other = F.col("doc_id") != F.col("class")
    member = stage_table(known.withColumn("class", F.coalesce("class", "doc_id")).select(
        "doc_id", "n", "class", F.when(other, F.col("d1")).alias("d1"), F.when(other, F.col("d2")).alias("d2")))
    # Ids that occur with different texts; all rows of one belong together.
    twice = stage_table(rows.groupBy("doc_id").agg(F.min("d1").alias("low"), F.max("d1").alias("high"))
                        .where("low < high").select("doc_id"))
    sets = stage_table(rows.where(F.col("chosen").isNotNull())
                       .join(member.where("doc_id <> class").select("doc_id", "d1", "d2").distinct(),
                             ["doc_id", "d1", "d2"], "left_anti")
                       .join(twice.withColumn("again", F.lit(True)), "doc_id", "left")
                       .select("doc_id", "n", "again", "chosen", "prints", "hashes"))
    bands = sets.select("doc_id", "n", "again", "prints", F.explode("chosen").alias("c")).select(
        "doc_id", "n", "again", "prints", "c.*")
    entry = bands.select("doc_id", "band", "again", F.explode(F.arrays_zip("signatures", "numbers")).alias("s")).select(
        "doc_id", "band", "again", F.col("s.signatures").alias("signature"), F.col("s.numbers").alias("number"))
    several = entry.groupBy("signature").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("signature")
    entry = stage_table(entry.join(several, "signature"))

    links, labels = None, None
    for turn in range(ROUNDS):
        fresh = stage_table(linked(stage_table(one_each(placed(entry, labels), turn)), sets))
        links = fresh.select("a", "b") if links is None else links.union(fresh.select("a", "b"))
        # One step towards the components is enough for another round.
        known = sets.select("doc_id", F.col("doc_id").alias("component")).distinct() if labels is None else labels
        moved = fresh.groupBy(F.col("q").alias("component")).agg(F.min("p").alias("to"))
        labels = stage_table(known.join(moved, "component", "left").select(
            "doc_id", F.coalesce("to", "component").alias("component")))

    # All pairs that are still apart, but for those that are ruled out.
    near = stage_table(components(links)).withColumnRenamed("node", "doc_id").withColumnRenamed("component", "root")
    labels = sets.select("doc_id").distinct().join(near, "doc_id", "left").select(
        "doc_id", F.coalesce("root", "doc_id").alias("component"))
    meet = stage_table(marked(bands, open_entries(placed(entry, labels))))
    pair = meet.alias("x").join(meet.alias("y"), (F.col("x.signature") == F.col("y.signature"))
                                & (F.col("x.component") < F.col("y.component")) & may_link("x", "y"))
    pair = pair.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()
    more = linked(stage_table(pair), sets)
    mine = member.join(twice.where(F.col("doc_id") != NO_ID), "doc_id").select("doc_id", F.col("class").alias("a"))
    same = mine.join(mine.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").select("a", "b")
    found = components(links.union(more.select("a", "b")).union(same))

    out = member.join(found.withColumnRenamed("node", "class"), "class", "left")
    real = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    component = F.coalesce("component", "class")
    return out.select(real.alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.when(component != NO_ID, component).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with one document of each component, its smallest id; columns as they were."""
    dropped = near_groups(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_dropped_id")).distinct()
    return docs.join(dropped, F.col("doc_id").cast("long") == F.col("_dropped_id"), "left_anti")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT w.doc_id, count(s) AS n_shingles FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s AS a JOIN s AS b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n_shingles + y.n_shingles - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS component FROM n UNION SELECT e.b, r.component FROM r JOIN e ON e.a = r.doc_id WHERE r.component < e.b)
SELECT n.doc_id, n_shingles, min(component) AS component_id FROM n JOIN r USING (doc_id) GROUP BY ALL
"""
