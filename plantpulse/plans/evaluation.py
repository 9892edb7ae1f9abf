"""Evaluation of stored predictions (ML01-ML03), as aggregates.

Rows carry a label and what a model or a rule said of them. Rows without a label or a
prediction are not counted. A measure whose divisor is zero is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.running import running_sum


def _share(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


def binary(scored: DataFrame) -> DataFrame:
    """One row for (label, prediction) of 0 or 1 and a `score`: counts, accuracy, precision, recall, F1, ROC-AUC.

    ROC-AUC is the share of (failed, sound) pairs whose failed row has the higher score; ties
    count half. Rows collapse to one per score, and a running sum tells the sound rows below.
    """
    rows = scored.filter(F.col("label").isNotNull() & F.col("prediction").isNotNull())
    true, said = F.col("label") == 1, F.col("prediction") == 1
    per_score = rows.groupBy(F.col("score").cast("double").alias("score")).agg(
        F.count_if(true).alias("n_true"), F.count_if(~true).alias("n_false"), F.count_if(said).alias("n_said"),
        F.count_if(true & said).alias("n_hit"), F.count_if(true == said).alias("n_right"))
    # Rows without a score count for all but the ROC-AUC.
    known = F.col("score").isNotNull()
    ranked = running_sum(per_score, [], ["score"], F.when(known, F.col("n_false")).otherwise(0), "below")
    n, failed, hit, said = F.sum(F.col("n_true") + F.col("n_false")), F.sum("n_true"), F.sum("n_hit"), F.sum("n_said")
    above = F.sum(F.when(known, F.col("n_true") * (F.col("below") + F.col("n_false") / 2.0)))
    pairs = F.sum(F.when(known, F.col("n_true"))).cast("double") * F.sum(F.when(known, F.col("n_false")))
    return ranked.agg(n.alias("n_test"), failed.alias("n_failed"), _share(F.sum("n_right"), n).alias("accuracy"),
                      _share(hit, said).alias("precision"), _share(hit, failed).alias("recall"),
                      _share(2.0 * hit, said + failed).alias("f1"), _share(above, pairs).alias("roc_auc"))


def classes(scored: DataFrame) -> DataFrame:
    """One row per class seen in labels or predictions: n_label, n_prediction, n_hit, F1."""
    confusion = scored.filter(F.col("label").isNotNull() & F.col("prediction").isNotNull()).groupBy("label", "prediction").agg(
        F.count("*").alias("n"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = confusion.select(F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("n_label"), F.lit(0).cast("long").alias("n_prediction"), hit.alias("n_hit")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("n_label"), F.col("n").alias("n_prediction"),
                 F.lit(0).cast("long").alias("n_hit")))).alias("s")).select("s.*")
    return sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("n_label", "n_prediction", "n_hit")]).withColumn(
        "f1", 2.0 * F.col("n_hit") / (F.col("n_label") + F.col("n_prediction")))


def several(scored: DataFrame) -> DataFrame:
    """One row: n_test, n_classes, accuracy and the unweighted mean F1 of the classes."""
    return classes(scored).agg(
        F.sum("n_label").alias("n_test"), F.count_if(F.col("n_label") > 0).alias("n_classes"),
        F.max("n_label").alias("n_commonest"), _share(F.sum("n_hit"), F.sum("n_label")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"))


def errors(scored: DataFrame, by: list[str]) -> DataFrame:
    """Mean absolute error and rows per group, of number labels."""
    gap = F.abs(F.col("label") - F.col("prediction"))
    return scored.filter(gap.isNotNull()).groupBy(*by).agg(F.count("*").alias("n_test"), F.avg(gap).alias("mae"))
