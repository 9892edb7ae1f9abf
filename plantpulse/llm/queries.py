"""The registered queries of this package: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.llm import (ann, bpe, exact_dedup, langid, packing, page_text, partenum, pii, quality, turn_repair,
                            vector_codes, window_dedup, winnowing)
from plantpulse.llm.tables import table

VOCABULARY = "byte_bpe_50k.json"


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predicted(docs, langid.learn(docs))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.near_groups(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extracted(table(spark, sf_dir, "pages"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(table(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digests(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.digests(table(spark, sf_dir, "conversations"))


ALL = (op1_best_fit_packing, op2_language_id, op3_jaccard_join, op4_html_extraction, op5_substring_dedup, op6_bpe,
       op7_pii, op8_nearest_neighbours, op9_exact_dedup, op10_quality, op11_decontamination, op12_vector_codes,
       op13_conversation_repair)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in ALL}


def oracle_sql() -> dict[str, str]:
    return {"op3_jaccard_join": partenum.ORACLE_SQL, "op5_substring_dedup": window_dedup.ORACLE_SQL,
            "op9_exact_dedup": exact_dedup.ORACLE_SQL, "op11_decontamination": winnowing.ORACLE_SQL,
            "op12_vector_codes": vector_codes.ORACLE_SQL, "op13_conversation_repair": turn_repair.ORACLE_SQL}
