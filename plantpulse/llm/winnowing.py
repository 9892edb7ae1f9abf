"""Benchmark decontamination by winnowing, with DataFrame functions only.

A text's words are hashed, and every run of `k` of them (a k-gram) gets a hash of its
word hashes. Of each `w` successive k-grams the least hash is the fingerprint of the
`k + w - 1` words they span. It depends on these words alone, so two texts that share
such a span share its fingerprint: no shared span of that length can be missed. With
windows of m words, k = (m + 1) // 2 and w = m + 1 - k. Successive spans mostly have one
fingerprint and form one entry, so a text gives about one entry for each m / 3 words.

    fingerprints of the items     one row per distinct value
    entries of the documents      joined with them; the rest goes, with its text
    extension                     the spans of the entries left are compared word by word
    hits                          spans equal to a window of an item; a word under any is hit

The documents are read once. Windows are compared as strings, so hashes decide nothing
but what is compared. A window that many items share is one row: items are kept by class,
the set of items that have a window, and a document meets each class once.

Items of fewer than `WINDOW` words are windows of their own length; each length that
occurs has its own fingerprints (nine lengths at most).

Defined results: null text has no words. Rows are never merged: a repeated row, or a
repeated or null doc_id, has its own result row. Items that share an item_id count as one
item with all their windows; a null item_id is the empty string. Equal windows of several
items are hits of all of them. An empty benchmark leaves all documents clean; no documents
give no rows. A text is held by one task, which takes some hundred bytes a word. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.session import stage_table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What ends a word once A-Z are lower-cased: all of ASCII but digits and a-z.
BREAKS = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: Words of a window.
WINDOW = 10
#: Spans of one entry at most, so an entry holds few words in a text that repeats one.
ENTRY_SPANS = 32
#: Rows of a table that may be broadcast: fingerprints, windows or classes of items.
BROADCAST_ROWS = 1 << 18
#: Copies of a larger table, for keys that a third of the documents may share.
SALTS = 16


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + BREAKS, UPPER.lower() + " " * len(BREAKS))
    return F.array_remove(F.split(plain, " "), "")


def with_entries(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Add `entries`: fingerprints of the spans of each of the `lengths`, with their place.

    Needs `words`. An entry stands for `spans` successive spans of `m` words, the first
    from word `at` on (0-based), which all have the fingerprint `h`.
    """
    df = df.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))
    found = []
    for m in lengths:
        k = (m + 1) // 2
        grams, least, starts = f"grams_{m}", f"least_{m}", f"starts_{m}"
        # The last k - 1 runs lack words; no span reaches them.
        df = df.withColumn(grams, F.transform("hashes", _gram(k)))
        places = F.when(F.size("words") >= m, F.sequence(F.lit(0), F.size("words") - m)).otherwise(
            F.array().cast("array<int>"))
        df = df.withColumn(least, F.transform(places, _least(grams, m + 1 - k)))
        df = df.withColumn(starts, F.filter(places, _new(least)))
        found.append(F.transform(starts, _entry(m, starts, least)))
    return df.withColumn("entries", F.concat(*found))


def _gram(k: int):
    """Hash of the k word hashes from a place on."""
    return lambda x, i: F.xxhash64(x, *[F.get("hashes", i + j) for j in range(1, k)])


def _least(grams: str, w: int):
    """The least of w successive hashes."""
    return lambda i: F.get(grams, i) if w == 1 else F.least(*[F.get(grams, i + j) for j in range(w)])


def _new(least: str):
    """Places whose fingerprint is not that of the place before."""
    return lambda i: (i % ENTRY_SPANS == 0) | (F.get(least, i) != F.get(least, i - 1))


def _entry(m: int, starts: str, least: str):
    return lambda i, j: F.struct(
        F.lit(m).alias("m"), i.alias("at"),
        (F.coalesce(F.get(starts, j + 1), F.size("words") - (m - 1)) - i).alias("spans"), F.get(least, i).alias("h"))


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item, m, span, h): the windows of every item and their fingerprints."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                             words(F.col(text_col)).alias("words"))
    own = F.least(F.size("words"), F.lit(WINDOW))
    # explode() of a column would test its size below all steps, and so work them out anew inside each other.
    entries = with_entries(items, list(range(1, WINDOW + 1))).select(
        "item", "words", own.alias("own"), F.explode_outer("entries").alias("e")).where("e.m = own")
    return opened(entries.select("item", "e.*", spanned().alias("seg"))).select("item", "m", "span", "h").distinct()


def spanned() -> Column:
    """The words under the spans of the entry `e`."""
    return F.slice("words", F.col("e.at") + 1, F.col("e.spans") + F.col("e.m") - 1)


def opened(entries: DataFrame) -> DataFrame:
    """One row per span of each entry, with its words as a string."""
    rows = entries.withColumn("step", F.explode(F.sequence(F.lit(0), F.col("spans") - 1)))
    return rows.select(*[c for c in entries.columns if c not in ("seg", "at", "spans")],
                       (F.col("at") + F.col("step")).alias("at"),
                       F.array_join(F.slice("seg", F.col("step") + 1, F.col("m")), " ").alias("span"))


def met(left: DataFrame, right: DataFrame, keys: list[str], rows: int, how: str = "inner") -> DataFrame:
    """Join with a table of `rows` rows: sent to all tasks if small, else copied to `SALTS`
    parts, of which each row of `left` meets one, so no key of `left` fills one task."""
    if rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), keys, how)
    salt = F.array(*[F.lit(i) for i in range(SALTS)])
    part = F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")
    return left.withColumn("salt", part).join(right.withColumn("salt", F.explode(salt)), [*keys, "salt"], how).drop("salt")


def candidates(docs: DataFrame, prints: DataFrame, rows: int, lengths: list[int], id_col: str, text_col: str) -> DataFrame:
    """One row per document (`m` 0, with `n_words`), and its entries whose fingerprint an item has."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if rows > BROADCAST_ROWS:
        # The join below is a shuffle then, and rows must be numbered right before a write.
        docs = stage_table(docs.withColumn("rid", F.monotonically_increasing_id()))
    else:
        docs = docs.withColumn("rid", F.monotonically_increasing_id())
    split = with_entries(docs.select("rid", "doc_id", words(F.col("text")).alias("words")), lengths)
    itself = F.array(F.struct(F.lit(0).alias("m"), F.lit(0).alias("at"), F.lit(0).alias("spans"),
                              F.xxhash64("rid").alias("h")))
    rows_of = split.select("rid", "doc_id", "words", F.explode(F.concat(itself, "entries")).alias("e"))
    own = F.col("e.m") == 0
    seg = F.when(~own, spanned()).alias("seg")
    last = ["rid", F.when(own, F.col("doc_id")).alias("doc_id"), F.when(own, F.size("words")).cast("long").alias("n_words")]
    known = prints.withColumn("known", F.lit(True))
    if rows <= BROADCAST_ROWS:
        # Words are cut out only for the entries that are left.
        joined = met(rows_of.withColumns({"m": F.col("e.m"), "h": F.col("e.h")}), known, ["m", "h"], rows, "left")
        return joined.where((F.col("m") == 0) | F.col("known")).select(*last, "e.m", "e.at", "e.spans", seg)
    slim = rows_of.select(*last, "e.*", seg)
    return met(slim, known, ["m", "h"], rows, "left").where((F.col("m") == 0) | F.col("known")).drop("known", "h")


def hits(found: DataFrame, windows: DataFrame, rows: int) -> DataFrame:
    """Spans of documents that are windows of items: rid, at, m, and the class of the window."""
    return met(opened(found.where("m > 0").select("rid", "m", "at", "spans", "seg")), windows, ["m", "span"], rows).drop("span")


def window_classes(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(m, span, class) of every distinct window, and (class, item): the items of each class.

    A class is the set of items that have a window: their number and two sums of hashes.
    """
    def folded(seed: int) -> Column:
        return F.bit_xor(F.xxhash64("item", F.lit(seed)))

    of_span = stage_table(items.groupBy("m", "span").agg(F.count(F.lit(1)).alias("n"), folded(1).alias("x"), folded(2).alias("y")))
    key = F.concat_ws(":", "n", "x", "y").alias("class")
    windows = of_span.select("m", "span", key)
    one = windows.groupBy("class").agg(F.min(F.struct("m", "span")).alias("one")).select("class", "one.*")
    return windows, stage_table(one.join(items, ["m", "span"]).select("class", "item").distinct())


def hit_words(hit: DataFrame) -> DataFrame:
    """n_hit per rid: words under any span."""
    end = F.col("at") + F.col("m")
    before = Window.partitionBy("rid").orderBy("at", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(before), F.lit(0))
    spans = hit.select("rid", "at", end.alias("end")).distinct().withColumn("reach", reach)
    return spans.groupBy("rid").agg(F.sum(
        F.greatest(F.lit(0), F.col("end") - F.greatest("at", "reach"))).cast("long").alias("n_hit"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted as strings), contaminated."""
    items = stage_table(item_windows(benchmark, item_col, item_text_col))
    # Ten lengths at most.
    lengths = sorted(r["m"] for r in items.select("m").distinct().collect()) or [WINDOW]
    prints = stage_table(items.select("m", "h").distinct())
    windows, members = window_classes(items.select("item", "m", "span"))

    found = stage_table(candidates(docs, prints, prints.count(), lengths, id_col, text_col))
    hit = stage_table(hits(found, windows, windows.count()))
    classes = hit.select("rid", "class").distinct()
    of_doc = met(classes, members, ["class"], members.count()).groupBy("rid").agg(
        F.sort_array(F.collect_set("item")).alias("items"))
    rows = found.where("m = 0").select("rid", "doc_id", "n_words")
    none = F.array().cast("array<string>")
    return rows.join(hit_words(hit), "rid", "left").join(of_doc, "rid", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`contamination` with the items as number and hash."""
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS win
       FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS i
             FROM (SELECT item, w, least(len(w), 10) AS m FROM b WHERE len(w) > 0))),
dw AS (SELECT rid, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
       FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i
             FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)),
h AS (SELECT rid, i, dw.m, item FROM dw JOIN bw ON dw.m = bw.m AND dw.win = bw.win),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM h) GROUP BY rid),
listed AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN listed USING (rid)
"""
