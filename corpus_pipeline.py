"""The corpus pipeline: stages over `documents`, each written as Parquet and read again.

    STAGES          name and function of each stage, in order
    run(spark, dir) the result of the last stage over the documents of `dir`

A stage takes (spark, docs, sf_dir). All but the last return the columns of documents.
Rows that a stage drops are gone for all later ones. An empty table passes through.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plantpulse.llm import exact_dedup, packing, partenum, pii, quality
from plantpulse.llm.queries import VOCABULARY
from plantpulse.llm.tables import table
from plantpulse.session import drop_staged, staged_mark, staged_root


#: Bytes of the batches that go to Python workers, whole rows with all columns.
BATCH_BYTES = "8m"


def _small_batches(spark: SparkSession) -> None:
    """A worker holds a batch, its copy and the result: keep them small beside the executor's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of `sf_dir`, does not reject."""
    _small_batches(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_equals(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    _small_batches(spark)
    return exact_dedup.keep_one(docs)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the row with the smallest id."""
    _small_batches(spark)
    return partenum.keep_one(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data; lengths stay."""
    _small_batches(spark)
    return pii.pseudonymised(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their place in sequences."""
    _small_batches(spark)
    return packing.packed_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [("quality_classifier", good_documents), ("exact_dedup", one_of_equals), ("jaccard_join", one_of_similar),
          ("pii", pseudonyms), ("best_fit_packing", sequences)]

#: SQL cannot express the classifier, the pseudonyms and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    root = f"{staged_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        mark = staged_mark()
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        # What the stage kept on its way is not needed once its result is written.
        drop_staged(spark, mark)
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
