"""Approximate nearest neighbours by learned partitions.

Learning, on a bounded sample: the neighbour graph of the sample is cut into balanced parts
(recursive halving along the graph's slowest mode, then exchanges that keep the balance).
One small softmax classifier learns the part of a row, from its components and from what its
norm leaves below the largest (nearness is an inner product, so norms matter). A second one
learns where the neighbours of a query lie: its targets are the parts of the nearest rows by
inner product of three quarters of the sample, taken as queries. Indexing: the first puts every
row of the table into its most probable part. Searching: a query goes to its most probable parts
until they hold a share of the probability and enough rows for its list, and is compared there
with all rows, exactly. The share is measured on the other quarter of the sample: the least one
that finds `RECALL` of its neighbours.

Parts are dealt in blocks of at most `BLOCK_ROWS` rows, and queries of a part in blocks as
well, so a part with a third of all rows, or of all queries, is many tasks; every block
returns the best `k` of its own, which are merged per query.

Bounds (parameters): `SAMPLE_ROWS` vectors for the graph and the classifier, taken in the
order of a hash of the id; as many parts as hold `PART_ROWS` of them each. Every row is
indexed, and the counts of rows per part come to the driver. Recall is measured in the tests.

Defined results: vectors that are null, empty, zero, of another dimension than most, or hold
null or non-finite components take no part. Ties go to the smaller vec_id. Rows that repeat
an id are candidates each for themselves, but never for a query of the same id; query rows
that repeat id and vector have one list. An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.llm.tables import for_python
from plantpulse.session import stage_table

#: Vectors to learn from, neighbours of the graph, rows of the sample per part, share of neighbours to find.
SAMPLE_ROWS, GRAPH, PART_ROWS, RECALL = 4096, 12, 64, 0.95
#: Neighbours of a query that the second classifier learns from, and steps of learning.
NEAREST, STEPS = 20, 200
#: Rows and queries of a block.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 2048
#: Scores closer than this may be ties, and are computed again one by one.
MARGIN = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    """Vectors of length one; components are brought to one first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def highest(left: np.ndarray, right: np.ndarray, k: int) -> np.ndarray:
    """For every row of `left` the k rows of `right` of the largest inner product but itself, in blocks."""
    out = np.empty((len(left), k), np.int64)
    for a in range(0, len(left), 1024):
        score = left[a:a + 1024] @ right.T
        score[np.arange(len(score)), np.arange(a, a + len(score))] = -np.inf
        out[a:a + 1024] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest of every row by distance: |a - b|^2 is least where a.b - |b|^2 / 2 is largest."""
    return highest(np.column_stack([x, np.ones(len(x))]), np.column_stack([x, -0.5 * (x * x).sum(axis=1)]), k)


def halve(nodes: np.ndarray, graph: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two equal halves of `nodes` with few edges between them."""
    local = np.full(len(graph), -1)
    local[nodes] = np.arange(len(nodes))
    to = local[graph[nodes]]
    src, dst = np.repeat(np.arange(len(nodes)), graph.shape[1]), to.ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    both = np.concatenate([src, dst]), np.concatenate([dst, src])
    degree = np.maximum(np.bincount(both[0], minlength=len(nodes)), 1).astype(float)
    v = rng.standard_normal(len(nodes))
    for _ in range(60):
        v -= (v * degree).sum() / degree.sum()
        v = 0.5 * v + 0.5 * np.bincount(both[0], v[both[1]], len(nodes)) / degree
        v /= np.linalg.norm(v) + 1e-300
    side = np.zeros(len(nodes), bool)
    side[np.argsort(v, kind="stable")[len(nodes) // 2:]] = True
    for _ in range(20):
        across = np.bincount(both[0], side[both[1]] != side[both[0]], len(nodes))
        gain = across - (np.bincount(both[0], minlength=len(nodes)) - across)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        n = min(len(left), len(right))
        swap = np.flatnonzero(gain[left[:n]] + gain[right[:n]] > 0)[:max(1, n // 16)]
        if not len(swap):
            break
        side[left[swap]], side[right[swap]] = True, False
    return nodes[~side], nodes[side]


def balanced_parts(graph: np.ndarray, size: int, seed: int = 7) -> np.ndarray:
    """Part of every node: halves until at most `size` nodes are left."""
    rng = np.random.default_rng(seed)
    part = np.zeros(len(graph), np.int64)
    todo, found = [np.arange(len(graph))], 0
    while todo:
        nodes = todo.pop()
        if len(nodes) > size:
            todo += halve(nodes, graph, rng)
        else:
            part[nodes] = found
            found += 1
    return part


@dataclass
class Softmax:
    """Classifier of parts."""

    weights: np.ndarray
    bias: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return features @ self.weights + self.bias

    def shares(self, features: np.ndarray) -> np.ndarray:
        z = self.scores(features)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def train(features: np.ndarray, target: np.ndarray) -> Softmax:
    """Softmax regression by Adam, from the mean features of each part."""
    weights = 4 * (features.T @ target / (target.sum(axis=0) + 1e-9))
    model = Softmax(weights - weights.mean(axis=1, keepdims=True), np.zeros(target.shape[1]))
    state = [model.weights, model.bias]
    moment = [[np.zeros_like(s), np.zeros_like(s)] for s in state]
    for step in range(1, STEPS + 1):
        error = (model.shares(features) - target) / len(features)
        for s, m, g in zip(state, moment, (features.T @ error + 1e-6 * state[0], error.sum(axis=0)), strict=True):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            s -= 0.1 * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-9)
    return model


def spread(neighbours: np.ndarray, part: np.ndarray, parts: int) -> np.ndarray:
    """The share of each part among the neighbours of every row."""
    out = np.zeros((len(neighbours), parts))
    at = np.repeat(np.arange(len(neighbours)), neighbours.shape[1])
    np.add.at(out, (at, part[neighbours].ravel()), 1 / neighbours.shape[1])
    return out


def ahead(shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts by falling share, and the sum of the shares before each."""
    order = np.argsort(-shares, axis=1, kind="stable")
    ranked = np.take_along_axis(shares, order, 1)
    return order, np.cumsum(ranked, axis=1) - ranked


@dataclass
class Partition:
    """Parts of rows, and the parts where a query's neighbours lie."""

    size: float       # what components are divided by
    largest: float    # norm of the sample's longest vector, so divided
    rows: Softmax
    queries: Softmax
    share: float

    def features(self, x: np.ndarray) -> np.ndarray:
        x = x / self.size
        below = np.maximum(0, self.largest ** 2 - (x * x).sum(axis=1))
        return np.column_stack([x, np.sqrt(below) / self.largest])

    def part(self, x: np.ndarray) -> np.ndarray:
        return self.rows.scores(self.features(x)).argmax(axis=1)

    def probes(self, x: np.ndarray, held: np.ndarray, least: np.ndarray) -> list[np.ndarray]:
        """The parts of each query: up to the share, and until they hold `least` of the `held` rows."""
        order, before = ahead(self.queries.shares(unit(x)))
        rows = np.cumsum(held[order], axis=1) - held[order]
        used = (before <= self.share) | (rows < least[:, None])
        return [o[u] for o, u in zip(order, used, strict=True)]


def learn(x: np.ndarray) -> Partition:
    """A partition from sample vectors."""
    if len(x) < 4:
        none = Softmax(np.zeros((x.shape[1] + 1, 1)), np.zeros(1))
        return Partition(1.0, 1.0, none, Softmax(none.weights[1:], none.bias), 1.0)
    largest = np.abs(x).max()
    size = largest * np.sqrt(((x / largest) ** 2).sum(axis=1).mean())
    x = x / size
    graph = neighbour_graph(x, min(GRAPH, len(x) - 1))
    part = balanced_parts(graph, PART_ROWS)
    parts = int(part.max()) + 1
    target = spread(graph, part, parts)
    target[np.arange(len(x)), part] += 1
    out = Partition(1.0, float(np.linalg.norm(x, axis=1).max()), Softmax(np.zeros(0), np.zeros(0)), Softmax(np.zeros(0), np.zeros(0)), 1.0)
    out.rows = train(out.features(x), target / 2)
    # Where the rows that answer a query went.
    found = spread(highest(x, x, min(NEAREST, len(x) - 1)), out.part(x), parts)
    kept = np.arange(len(x)) % 4 != 0
    out.queries = train(unit(x[kept]), found[kept])
    order, before = ahead(out.queries.shares(unit(x[~kept])))
    # Found neighbours by falling need of share: as many as `RECALL` asks for.
    need, gain = before.ravel(), np.take_along_axis(found[~kept], order, 1).ravel()
    rank = np.argsort(need, kind="stable")
    total = np.cumsum(gain[rank])
    out.share = float(need[rank][min(np.searchsorted(total, RECALL * total[-1]), len(total) - 1)])
    out.size = float(size)
    return out


def fit(vectors: DataFrame) -> Partition:
    """A partition from a bounded sample of `vectors` (vec_id, v)."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toArrow().to_pylist()
    # In the order of the hash, so that each quarter is as mixed as the whole.
    x = np.array([r["v"] for r in sorted(rows, key=lambda r: (zlib.crc32(str(r["vec_id"]).encode()), r["vec_id"], r["v"]))], float)
    return learn(x if len(x) else np.zeros((0, 1)))


def usable(table: DataFrame) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part."""
    v = F.transform("embedding", lambda e: e.cast("double"))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
        & F.exists("v", lambda e: e != 0))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (usual[0]["n"] if usual else 0))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def indexed(rows: DataFrame, partition: Partition) -> DataFrame:
    """Rows with their part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(partition.part(matrix(batch.column("v"))), pa.int64())], [*batch.schema.names, "part"])

    return rows.mapInArrow(run, "vec_id long, v array<double>, part long")


def routed(queries: DataFrame, partition: Partition, held: np.ndarray) -> DataFrame:
    """Queries (query_id, q, least) with the array of the parts they are sent to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parts = partition.probes(matrix(batch.column("q")), held, batch.column("least").to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("q"), pa.array(parts, pa.list_(pa.int64()))],
                                                 ["query_id", "q", "parts"])

    return queries.mapInArrow(run, "query_id long, q array<double>, parts array<long>")


def best(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple]:
    """For each query its place, and the ids and scores of its best k rows."""
    rough = queries @ rows.T
    for q in range(len(queries)):
        score = np.where(ids == own[q], -np.inf, rough[q])
        if len(score) > k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            near = np.flatnonzero((score >= least - MARGIN * max(1.0, abs(least))) & (score > -np.inf))
        else:
            near = np.flatnonzero(score > -np.inf)
        # One by one in a fixed order of summation, so that equal vectors have equal scores.
        exact = (rows[near] * queries[q]).sum(axis=1)
        order = np.lexsort((ids[near], -exact))[:k]
        yield q, ids[near][order], exact[order]


def nearest(table: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of every query, by inner product."""
    vectors = usable(for_python(table))
    partition = fit(vectors)
    index = stage_table(indexed(vectors, partition))
    held = np.zeros(len(partition.rows.bias), np.int64)
    for r in index.groupBy("part").count().collect():
        held[r["part"]] = r["count"]
    # Rows of the query's own id are no candidates: as many more are asked for.
    own = vectors.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg((F.count(F.lit(1)) + k).alias("least"))
    asked = vectors.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).distinct().join(own, "query_id")
    asked = stage_table(routed(asked.select("query_id", "q", "least"), partition, held)
                        .select("query_id", "q", F.explode("parts").alias("part")))
    # Blocks per part: rows and queries are dealt by hash, so that each block stays bounded.
    blocks = index.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("row_blocks")).join(
        asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).alias("query_blocks")), "part")
    blocks = stage_table(blocks)
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    dealt = index.join(blocks, "part").select(
        "part", F.pmod(F.xxhash64("vec_id", "v"), F.col("row_blocks")).alias("rb"), spread("query_blocks").alias("qb"), "vec_id", "v")
    asking = asked.join(blocks, "part").select(
        "part", spread("row_blocks").alias("rb"), F.pmod(F.xxhash64("query_id", "q"), F.col("query_blocks")).alias("qb"), "query_id", "q")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if left.num_rows and right.num_rows:
            rows, ids = matrix(left.column("v").combine_chunks()), left.column("vec_id").to_numpy()
            queries, own = matrix(right.column("q").combine_chunks()), right.column("query_id").to_numpy()
            for q, found, score in best(queries, rows, ids, own, k):
                out[0].append(np.full(len(found), own[q]))
                out[1].append(found)
                out[2].append(score)
                out[3].append(np.full(len(found), right.column("key")[q].as_py()))
        cat = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.Table.from_arrays([cat(out[0], pa.int64()), cat(out[3], pa.int64()), cat(out[1], pa.int64()),
                                     cat(out[2], pa.float64())], ["query_id", "key", "vec_id", "score"])

    at = ["part", "rb", "qb"]
    found = (dealt.groupBy(*at).cogroup(asking.withColumn("key", F.xxhash64("q")).groupBy(*at))
             .applyInArrow(compare, "query_id long, key long, vec_id long, score double"))
    # A query row that repeats an id keeps its own list, by its vector.
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
