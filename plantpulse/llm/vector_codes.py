"""Vector compression by product codes, with norm-of-sum bounds.

Vectors are cut into `PARTS` parts; each part position has a codebook of up to `ENTRIES`
entries. `ROUNDS` rounds assign every part to its nearest entry and replace each entry by
the mean of its parts; a last assignment gives the codes. All components are integers, so
distances, means and results are exact and depend neither on order nor on partitions.

Most distances are never worked out. Entries of a codebook fall into groups of near ones.
For each part of each vector and each group a lower bound of the distance to the group's
entries is kept, with the round it was taken in (its stamp). The driver keeps the whole
codebook history, so a bound of round s is lowered in round t by the true net displacement
|c(t) - c(s)| of its entries, not by the sum of the moves of all rounds between: entries
that move to and fro cost nothing. A round rescans the group that holds the assigned entry,
and then only groups whose lowered bound does not exceed the distance found there.

Between rounds the vectors, codes, bounds and stamps are one Parquet table in the shared
folder; that of the round before is then deleted. Sums travel as one row per task and entry.
The driver holds codebooks only: `PARTS` x `ENTRIES` entries, whatever the number of rows.

Defined results: rows go whose vector is null or holds a null, NaN or infinite component;
an empty vector is kept. Components are read as floats. Vectors shorter than the longest
count as if zeros followed, and the length is rounded up to a multiple of `PARTS`. Equal
distances go to the lower index. A null vec_id comes after all others; of equal vec_ids the
smaller vector comes first. Rows are never merged: each repeated row has its result row.
Fewer than `ENTRIES` rows give shorter codebooks, an empty table an empty result. Errors
beyond a long are the largest long. Integers of any size are exact; where squares could
exceed 2^53 they are Python's. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.tables import for_python
from plantpulse.session import drop_one, stage_table, staged_mark

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Groups of a codebook's entries, each with one bound.
GROUPS = 8
#: Vector components handled at once.
CHUNK = 1 << 20
#: Rounding of square roots and of bounds kept as 32-bit floats, on the safe side.
SLACK = 1e-6
#: The largest bound kept.
FAR = 3e38
#: Bits of the two lower limbs in which sums travel.
LIMB = 40
LONG = (1 << 63) - 1
#: A label with more rows than this share of all is joined by broadcast; there are fewer than 1 / share.
HOT_SHARE = 1e-3


def usable(vector: Column) -> Column:
    """Vectors without null or non-finite components."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


@dataclass
class Codebooks:
    """All versions of the codebooks, and what assignments need of them."""

    #: Per round: PARTS arrays (entries, width).
    history: list[list[np.ndarray]]
    #: Components are whole float64 numbers, small enough that squared distances are exact.
    small: bool
    #: Per part: entry numbers of each group.
    groups: list[list[np.ndarray]] = field(default_factory=list)

    def __post_init__(self) -> None:
        if not self.groups:
            self.groups = [near_groups(c) for c in self.history[0]]

    def moved(self, part: int) -> np.ndarray:
        """[stamp, group]: the farthest that an entry of a group is from where it was at that stamp."""
        now = self.history[-1][part]
        return np.array([[np.sqrt(float(squared(now[g] - then[part][g]).max())) for g in self.groups[part]]
                         for then in self.history])

    def digest(self) -> str:
        """Hash of all entries' components."""
        out = hashlib.sha256()
        out.update(",".join(str(int(x)) for c in self.history[-1] for x in c.ravel()).encode())
        return out.hexdigest()


def squared(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=-1) if x.shape[-1] else np.zeros(x.shape[:-1], x.dtype)


def near_groups(entries: np.ndarray, groups: int = GROUPS) -> list[np.ndarray]:
    """Entry numbers in groups of near entries: halved along the widest component, again and again."""
    found = [np.arange(len(entries))]
    if not len(entries):
        return found
    while len(found) < groups and max(map(len, found)) > 1:
        found.sort(key=len)
        own = found.pop()
        values = entries[own].astype(float)
        order = own[np.argsort(values[:, np.ptp(values, axis=0).argmax()], kind="stable")] if values.shape[1] else own
        found += [np.sort(order[:len(order) // 2]), np.sort(order[len(order) // 2:])]
    return sorted(found, key=lambda g: int(g[0]))


def integers(vectors: np.ndarray, small: bool) -> np.ndarray:
    """floor(SCALE * x): as whole float64 numbers, or as Python's integers."""
    whole = np.floor(vectors.astype(np.float64) * SCALE)
    return whole if small else np.frompyfunc(int, 1, 1)(whole)


def gaps(x: np.ndarray, c: np.ndarray, small: bool) -> np.ndarray:
    """Squared distances of all rows of x and c, exact."""
    if small:
        return squared(x)[:, None] + squared(c)[None, :] - 2.0 * (x @ c.T)
    out = np.zeros((len(x), len(c)), object)
    for i in range(x.shape[1]):
        out += (x[:, i, None] - c[None, :, i]) ** 2
    return out


def assign(x: np.ndarray, part: int, books: Codebooks, code: np.ndarray, bound: np.ndarray, stamp: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entries of rows x of one part, their squared distances, and how many distances were taken.

    `bound` and `stamp` (rows, groups) are brought up to date in place.
    """
    now, entries = len(books.history) - 1, books.history[-1][part]
    moved, groups = books.moved(part), books.groups[part]
    home = np.zeros(len(entries), int)
    for k, g in enumerate(groups):
        home[g] = k
    best = np.zeros(len(x), np.int64)
    least = np.full(len(x), np.inf) if books.small else np.full(len(x), None, object)
    taken = 0

    def scan(rows: np.ndarray, k: int) -> None:
        nonlocal taken
        g = groups[k]
        d = gaps(x[rows], entries[g], books.small)
        taken += d.size
        at = d.argmin(axis=1)
        found, name = d[np.arange(len(rows)), at], g[at]
        new = np.array([m is None for m in least[rows]]) if not books.small else np.isinf(least[rows])
        old = np.where(new, found, least[rows])
        better = new | (found < old) | ((found == old) & (name < best[rows]))
        best[rows[better]] = name[better]
        least[rows[better]] = found[better]
        bound[rows, k] = np.minimum(np.sqrt(found.astype(float)) * (1 - SLACK), FAR)
        stamp[rows, k] = now

    first = home[code]
    for k in range(len(groups)):
        rows = np.flatnonzero(first == k)
        if len(rows):
            scan(rows, k)
    for k in range(len(groups)):
        reach = np.sqrt(least.astype(float)) * (1 + SLACK)
        rows = np.flatnonzero((first != k) & (bound[:, k] - moved[stamp[:, k], k] * (1 + SLACK) <= reach))
        if len(rows):
            scan(rows, k)
    return best, least, taken


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as one matrix of floats, ended by zeros."""
    at = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < at[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _state(column: pa.Array, rows: int, shape: tuple[int, ...], kind: type) -> np.ndarray:
    """Packed values of the round before; zeros in the first round."""
    if column.null_count:
        return np.zeros((rows, *shape), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(rows, *shape).copy()


def _packed(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(values)], pa.binary())


def _pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, CHUNK // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


STATE = "vec_id long, label int, vector array<float>, codes binary, bounds binary, stamps binary"


def assigned(state: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """`state` after one assignment; `error` is the squared distance to the new codes."""
    own = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, width):
            n = batch.num_rows
            x = integers(_matrix(batch.column("vector"), width), books.small)
            codes = _state(batch.column("codes"), n, (PARTS,), np.uint8)
            bounds = _state(batch.column("bounds"), n, (PARTS, GROUPS), np.float32)
            stamps = _state(batch.column("stamps"), n, (PARTS, GROUPS), np.uint8)
            error = np.zeros(n, object)
            taken = 0
            for p in range(PARTS):
                codes[:, p], found, scans = assign(x[:, p * own:(p + 1) * own], p, books, codes[:, p], bounds[:, p], stamps[:, p])
                error += found.astype(np.int64).astype(object) if books.small else found
                taken += scans
            error = pa.array([min(int(e), LONG) for e in error], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("vector"), _packed(codes), _packed(bounds),
                 _packed(stamps), error, pa.array([taken] + [0] * (n - 1), pa.int64())],
                ["vec_id", "label", "vector", "codes", "bounds", "stamps", "error", "scans"])

    return for_python(state).select("vec_id", "label", "vector", "codes", "bounds", "stamps").mapInArrow(
        run, STATE + ", error long, scans long")


def _limbs(x: int, small: bool) -> tuple[int, ...]:
    low = (1 << LIMB) - 1
    return (x,) if small else (x & low, (x >> LIMB) & low, x >> (2 * LIMB))


def totals(state: DataFrame, width: int, small: bool) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Number and sums of the parts of each (part, entry) in use: `PARTS` x `ENTRIES` rows at most."""
    own = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((PARTS, ENTRIES), np.int64)
        sums = np.zeros((PARTS, ENTRIES, own), np.int64 if small else object)
        for batch in _pieces(batches, width):
            x = integers(_matrix(batch.column("vector"), width), small)
            x = x.astype(np.int64) if small else x
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, PARTS)
            for p in range(PARTS):
                order = np.argsort(codes[:, p], kind="stable")
                used, at = np.unique(codes[order, p], return_index=True)
                count[p, used] += np.diff(at, append=len(order))
                if own:
                    sums[p, used] += np.add.reduceat(x[order, p * own:(p + 1) * own], at, axis=0)
        rows = [{"part": p, "entry": e, "n": int(count[p, e]), "sums": [v for s in sums[p, e] for v in _limbs(int(s), small)]}
                for p, e in zip(*map(np.ndarray.tolist, np.nonzero(count)), strict=True)]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(
            [("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))

    partial = for_python(state).select("vector", "codes").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    places = partial.select("part", "entry", "n", F.posexplode_outer("sums")).groupBy("part", "entry", "pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("value"))
    found = places.groupBy("part", "entry").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("sums")).collect()
    step = len(_limbs(0, small))
    out = {}
    for r in found:
        limbs = [int(s["value"]) for s in r["sums"] if s["pos"] is not None]
        out[r["part"], r["entry"]] = (r["n"], [sum(v << (LIMB * i) for i, v in enumerate(limbs[at:at + step]))
                                               for at in range(0, len(limbs), step)])
    return out


def renewed(books: Codebooks, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> None:
    """The next version of the codebooks: means, rounded down; unused entries stay."""
    new = [c.copy() for c in books.history[-1]]
    for (p, e), (n, total) in sums.items():
        new[p][e] = [s // n for s in total]
    books.history.append(new)


@dataclass
class Fit:
    """Codes of all kept rows, the final codebooks, and the number of distances taken in each assignment."""

    rows: DataFrame
    books: Codebooks
    scans: list[int]


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> Fit:
    """One row per kept vector: vec_id, label, codes (a byte per part), error."""
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("int").alias("label"),
                          F.col(vector_col).cast("array<float>").alias("vector")).where(usable(F.col("vector")))
    facts = kept.agg(F.max(F.size("vector")).alias("width"), F.max(F.array_max(
        F.transform("vector", lambda x: F.abs(x)))).alias("most")).first()
    width = -(-(facts["width"] or 0) // PARTS) * PARTS
    most = float(facts["most"] or 0.0) * SCALE + 1
    small = (width // PARTS) * 4 * most * most < 2 ** 53
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).collect()
    start = integers(_matrix(pa.array([r["vector"] for r in first], pa.list_(pa.float32())), width), small)
    books = Codebooks([np.split(start, PARTS, axis=1)], small)

    none = F.lit(None).cast("binary")
    state = kept.withColumns({"codes": none, "bounds": none, "stamps": none})
    spark = vectors.sparkSession
    scans, before = [], None
    for _ in range(ROUNDS):
        mark = staged_mark()
        after = stage_table(assigned(state, books, width))
        if before is not None:
            drop_one(spark, before)
        state, before = after, mark
        scans.append(state.agg(F.sum("scans")).first()[0] or 0)
        renewed(books, totals(state, width, small))
    rows = stage_table(assigned(state, books, width).select("vec_id", "label", "codes", "error", "scans"))
    drop_one(spark, before)
    scans.append(rows.agg(F.sum("scans")).first()[0] or 0)
    return Fit(rows.drop("scans"), books, scans)


def label_errors(rows: DataFrame) -> DataFrame:
    """Add `label_error`: the error summed over rows of equal label.

    Labels with many rows are few and are sent to all tasks; the rest join by their key.
    """
    of = stage_table(rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"),
                                               F.count(F.lit(1)).alias("n")))
    least = HOT_SHARE * (of.agg(F.sum("n")).first()[0] or 0)
    error = F.least("total", F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error")
    many = of.where(F.col("n") >= least).select(F.col("label").alias("hot"), error)
    few = of.where(F.col("n") < least).select(F.col("label").alias("cold"), error.alias("rest_error"))
    found = rows.join(F.broadcast(many), F.col("label").eqNullSafe(F.col("hot")), "left")
    if few.isEmpty():
        return found.drop("hot")
    # Rows of the many meet nothing here: their key is their own.
    key = F.when(F.col("label_error").isNull(), F.struct("label", F.lit(0).cast("long").alias("own"))).otherwise(
        F.struct("label", F.coalesce("vec_id", F.lit(0)).bitwiseOR(F.lit(1).cast("long")).alias("own")))
    few = few.withColumn("cold_key", F.struct(F.col("cold").alias("label"), F.lit(0).cast("long").alias("own")))
    met = found.withColumn("key", key).join(few, F.col("key") == F.col("cold_key"), "left")
    return met.withColumn("label_error", F.coalesce("label_error", "rest_error")).drop("hot", "cold", "key", "cold_key", "rest_error")


def digests(vectors: DataFrame) -> DataFrame:
    """`compress` with codes as hexadecimal digits and one hash of the codebooks."""
    fit = compress(vectors)
    return label_errors(fit.rows).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(fit.books.digest()).alias("codebooks_sha256"))


def _round(t: int) -> str:
    return f"""
a{t} AS MATERIALIZED (SELECT rid, part, min(struct_pack(d := d, entry := entry)) AS best FROM (
    SELECT rid, part, entry, sum((v - c) * (v - c)) AS d FROM comp JOIN c{t} USING (part, place) GROUP BY rid, part, entry)
    GROUP BY rid, part)"""


def _mean(t: int) -> str:
    return f"""
c{t + 1} AS MATERIALIZED (SELECT entry, part, place, CAST(coalesce((s - ((s % n + n) % n)) // n, c) AS BIGINT) AS c FROM c{t} LEFT JOIN (
    SELECT best.entry AS entry, part, place, sum(v) AS s, count(*) AS n FROM comp JOIN a{t} USING (rid, part)
    GROUP BY ALL) USING (entry, part, place))"""


#: For vectors of one length that is a multiple of `PARTS`.
ORACLE_SQL = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rid, vec_id, label, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
comp AS MATERIALIZED (
    SELECT rid, (i - 1) // (len(embedding) // {PARTS}) AS part, (i - 1) % (len(embedding) // {PARTS}) AS place,
           CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS v
    FROM (SELECT rid, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
c0 AS MATERIALIZED (SELECT rid AS entry, part, place, v AS c FROM comp WHERE rid < {ENTRIES}),
{",".join(_round(t) + "," + _mean(t) for t in range(ROUNDS))},{_round(ROUNDS)},
done AS MATERIALIZED (SELECT rid, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code,
                             CAST(sum(best.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY rid),
books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN done USING (rid), books
"""
