"""Quality by compression: how much better a text fits a dictionary of good or of bad texts.

From a bounded sample of labelled rows two zstandard dictionaries are trained. A text is
compressed block by block with each, and without any. Three ratios describe it: the size
difference per byte, the size difference by the larger size, and the plain size per byte.
A logistic curve, fitted on other labelled rows of the sample and weighted to the label
counts of all learned rows, turns them into a probability. Blocks keep the dictionaries at
work in long texts, which otherwise serve as their own dictionary after some kilobytes.

Bounds (parameters): `SAMPLE_ROWS` rows per label for the dictionaries and as many for the
curve, taken in the order of a hash of the id; one block of each serves the dictionary.
Label counts cover all rows.

Defined results: null and empty texts have all ratios 0 and get the curve's value there.
Without labels every score is 0.5; with one label only, the smoothed share of that label.
A document with several labels counts with the smallest. Other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.arrays import chunks, split_bytes, texts_of
from plantpulse.llm.tables import for_python

#: Rows per label for each of the two fits; bytes of a block; bytes of a dictionary; compression level.
SAMPLE_ROWS, BLOCK_BYTES, DICTIONARY_BYTES, LEVEL = 3000, 4096, 112 << 10, 3
_COMPRESSORS: dict[int, list] = {}


def blocks(text: bytes) -> list[bytes]:
    return [text[i:i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from sample blocks; the blocks themselves where they are too few to train on."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, total // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


@dataclass
class Model:
    """Dictionaries of good and bad text and the curve over the ratios."""

    good: bytes = b""
    bad: bytes = b""
    center: np.ndarray = field(default_factory=lambda: np.zeros(3))
    scale: np.ndarray = field(default_factory=lambda: np.ones(3))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(3))
    bias: float = 0.0

    def compressors(self) -> list:
        key = zlib.crc32(self.good + b"|" + self.bad)
        if key not in _COMPRESSORS:
            _COMPRESSORS.clear()
            plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
            made = [zstandard.ZstdCompressor(**plain)]
            for raw in (self.good, self.bad):
                made.append(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw), **plain)
                            if raw else made[0])
            _COMPRESSORS[key] = made
        return _COMPRESSORS[key]

    def ratios(self, text: bytes) -> tuple[float, float, float]:
        if not text:
            return 0.0, 0.0, 0.0
        parts = blocks(text)
        plain, good, bad = (sum(len(c.compress(b)) for b in parts) for c in self.compressors())
        return (good - bad) / len(text), (good - bad) / max(good, bad), plain / len(text)

    def score(self, ratios: np.ndarray) -> np.ndarray:
        z = (ratios - self.center) / self.scale @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps; the last value is the bias."""
    a = np.c_[x, np.ones(len(x))]
    ridge = np.diag([1e-2] * x.shape[1] + [1e-9])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p) + 1e-9)[:, None]).T @ a + ridge,
                               a.T @ (weight * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labels of rows that are not held out."""
    learned = (labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
               .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("label")))
    counts = {r["label"]: r["n"] for r in learned.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        share = (counts.get(1, 0) + 1) / (total + 2)
        return Model(bias=float(np.log(share / (1 - share))))
    order = F.xxhash64("doc_id")
    picked = None
    for label in (0, 1):
        rows = learned.where(F.col("label") == label).orderBy(order, "doc_id").limit(2 * SAMPLE_ROWS)
        picked = rows if picked is None else picked.union(rows)
    # At most 4 * SAMPLE_ROWS ids, so the texts stay where they are.
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    which = F.pmod(F.xxhash64("doc_id", F.lit("block")),
                   F.greatest(F.ceil(F.octet_length("text") / BLOCK_BYTES), F.lit(1)))
    cut = F.substring(F.col("text").cast("binary"), (which * BLOCK_BYTES + 1).cast("int"), F.lit(BLOCK_BYTES))
    by_hash = sorted(sample.select("doc_id", "label", cut.alias("block")).toArrow().to_pylist(),
                     key=lambda r: (zlib.crc32(b"%d" % r["doc_id"]), r["doc_id"]))
    first, second = {0: [], 1: []}, []
    for r in by_hash:
        half = first[r["label"]]
        if r["block"] and len(half) < min(SAMPLE_ROWS, counts[r["label"]] // 2 + 1):
            half.append(bytes(r["block"]))
        else:
            second.append(r["doc_id"])
    model = Model(good=dictionary(first[1]), bad=dictionary(first[0]))
    fitting = set(second)
    rows = [r for r in _ratios(sample.select("doc_id", "text", "label"), model, "label int").toArrow().to_pylist()
            if r["doc_id"] in fitting]
    rows.sort(key=lambda r: (r["doc_id"], r["r0"], r["r1"], r["r2"]))
    y = np.array([r["label"] for r in rows], float)
    if len(set(y.tolist())) < 2:
        share = (counts[1] + 1) / (total + 2)
        model.bias = float(np.log(share / (1 - share)))
        return model
    x = np.array([[r["r0"], r["r1"], r["r2"]] for r in rows])
    model.center, model.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    each = np.where(y == 1, counts[1] / max(1, (y == 1).sum()), counts[0] / max(1, (y == 0).sum()))
    w = fit_curve((x - model.center) / model.scale, y, each / each.mean())
    model.weights, model.bias = w[:-1], float(w[-1])
    return model


def _ratios(rows: DataFrame, model: Model, more: str) -> DataFrame:
    extra = more.split(" ")[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([model.ratios(t) for t in split_bytes(*texts_of(batch.column("text")))]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column(extra), *(pa.array(c) for c in x.T)],
                                             ["doc_id", extra, "r0", "r1", "r2"])

    return for_python(rows).mapInArrow(run, f"doc_id long, {more}, r0 double, r1 double, r2 double")


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([model.ratios(t) for t in split_bytes(*texts_of(batch.column("text")))]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return for_python(rows).mapInArrow(run, "doc_id long, score double").select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` whose score reaches the threshold, with their columns as they were."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Some texts at a time: what goes back is a copy.
        for batch in chunks(batches):
            x = np.array([model.ratios(t) for t in split_bytes(*texts_of(batch.column("text")))]).reshape(-1, 3)
            yield batch.filter(pa.array(model.score(x) >= threshold))

    return for_python(docs).mapInArrow(run, schema)
