"""Exact duplicates by a tree merge of digest runs.

Only DataFrame functions. Rows are dealt to runs by their id. Level 0 reduces each run
to one entry per digest: how many rows, and the identifier to keep. In each round the
`FAN` runs whose numbers share a quotient are merged into one, keeping the entry of the
verified winner, until one run is left. The answer then walks down the same tree. An
entry never meets more than `FAN` others, so a text with a third of all rows costs no
task more than any other: its rows meet in as many runs as there are.

A run is not a task: its entries are spread over all partitions by (digest, run).
Entries are equal only if the digest, the length and a second hash all agree.

Defined results: null text counts as empty. Repeated rows (same id and text) form one
group; all of them have the same keep_id, and `kept` is true for each row with that id.
A null id is smaller than any other. An empty table gives an empty result. Other columns
of the input, whatever their names, are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.session import stage_table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Runs that merge into one in a round.
FAN = 16
#: Rows of a run: also the most rows of one text that meet under one key.
RUN_ROWS = 8192
KEY = ["digest", "n_bytes", "check"]


def normalised(text: Column) -> Column:
    """Null as empty, and A-Z in lower case; other letters stay."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def run_count(rows: int) -> int:
    """Runs for `rows` rows: a power of `FAN`."""
    rounds = max(1, math.ceil(math.log(max(1, rows / RUN_ROWS), FAN)))
    return FAN ** rounds


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays.
    """
    n = normalised(F.col(text_col))
    leaves = stage_table(docs.select(F.col(id_col).cast("long").alias("doc_id"), n.alias("t")).select(
        "doc_id", F.unhex(F.sha2("t", 256)).alias("digest"), F.octet_length("t").alias("n_bytes"),
        F.xxhash64("t").alias("check")))
    runs = run_count(leaves.count())
    leaves = leaves.withColumn("run", F.pmod(F.xxhash64("doc_id"), F.lit(runs)).cast("int"))

    levels = [leaves.groupBy(*KEY, "run").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))]
    while runs > 1:
        runs //= FAN
        levels.append(stage_table(levels[-1].groupBy(*KEY, F.floor(F.col("run") / FAN).cast("int").alias("run")).agg(
            F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))))

    # Only texts with copies need an answer; a text of one row is its own winner.
    answer = levels.pop().where("group_size > 1")
    while len(levels) > 1:
        below = levels.pop().select(*KEY, "run", F.floor(F.col("run") / FAN).cast("int").alias("above"))
        answer = below.join(answer.withColumnRenamed("run", "above"), [*KEY, "above"]).drop("above")
    leaves = leaves.withColumn("above", F.floor(F.col("run") / FAN).cast("int")).drop("run")
    found = leaves.join(answer.withColumnRenamed("run", "above"), [*KEY, "above"], "left")
    return found.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("group_size").isNull(), F.lit(True)).otherwise(
            F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with their columns as they were.

    A repeated row (same id) stays as often as it is given.
    """
    dropped = exact_groups(docs).where(~F.col("kept")).select(
        F.col("doc_id").alias("_dropped_id"), F.col("text_sha256").alias("_dropped_sha")).distinct()
    sha = F.sha2(normalised(F.col("text")), 256)
    if docs.select("doc_id").schema[0].dataType.typeName() != "long":
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.join(dropped, F.col("doc_id").eqNullSafe(F.col("_dropped_id")) & (sha == F.col("_dropped_sha")),
                     "left_anti")


ORACLE_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""
