"""Supervised models over gold features (ML01-ML05)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.interventions import hours_to_next
from ..session import stage_table
from . import evaluation

# The twenty model inputs in order.
INPUTS = [
    "target_cycle", *C.SENSORS,
    *[f"{c}_{s}" for c in C.ROLLED for s in ("roll_mean_10", "roll_std_10", "delta")],
    "load_proxy", "energy_per_cycle", "hours_since_last_intervention",
]
SEED = 42


def label_remaining_hours(gold: DataFrame, interventions: DataFrame, instants: DataFrame | None = None) -> DataFrame:
    """Remaining useful life: hours to the machine's next intervention. `instants`, the silver rows,
    have the machines and times of `gold`."""
    return hours_to_next(gold, interventions, instants)


def split(df: DataFrame, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Earlier `share` of each machine's time span for training, the rest for
    testing, so no test row precedes a training row of its machine.

    The spans are stored, one row per machine: a small table joins without a shuffle of the rows,
    which a model reads several times.
    """
    spans = df.groupBy("machine_id").agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    cut = F.unix_seconds("first") + share * (F.unix_seconds("last") - F.unix_seconds("first"))
    marked = df.join(stage_table(spans.select("machine_id", cut.alias("cut"))), "machine_id")
    early = F.unix_seconds("timestamp") <= F.col("cut")
    return marked.filter(early).drop("cut"), marked.filter(~early).drop("cut")


def fill_inputs(train: DataFrame, *others: DataFrame) -> list[DataFrame]:
    """Missing inputs become the median of the training rows, so every row is used and scored.

    The medians are one row from a bounded sketch. An input without any value becomes 0.
    """
    known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in INPUTS}
    middle = train.agg(*[F.percentile_approx(known[c], 0.5, 10_000).alias(c) for c in INPUTS]).first()
    filled = {c: F.coalesce(known[c], F.lit(float(middle[c] or 0.0))) for c in INPUTS}
    return [df.withColumns(filled) for df in (train, *others)]


def _assemble() -> VectorAssembler:
    return VectorAssembler(inputCols=INPUTS, outputCol="features", handleInvalid="error")


def failure_predictions(train: DataFrame, test: DataFrame, trees: int = 20) -> DataFrame:
    """Failed or not, of all test rows: label, prediction and the forest's share of votes as score. Stored."""
    train, test = fill_inputs(train, test)
    label = (F.col("failure") > 0).cast("double").alias("label")
    forest = RandomForestClassifier(numTrees=trees, seed=SEED)
    model = Pipeline(stages=[_assemble(), forest]).fit(train.select("*", label))
    return stage_table(model.transform(test.select("*", label)).select(
        "machine_id", "timestamp", "label", "prediction", vector_to_array("probability")[1].alias("score")))


def failure_classifier(train: DataFrame, test: DataFrame, trees: int = 20) -> DataFrame:
    """Counts, accuracy, precision, recall and F1 of the failed class, and ROC-AUC over all test rows."""
    return evaluation.binary(failure_predictions(train, test, trees))


def type_predictions(train: DataFrame, test: DataFrame, trees: int = 20) -> DataFrame:
    """none / Breakage / Overheat, of all test rows. Stored.

    A class the training rows lack has an index of its own and counts as missed.
    """
    train, test = fill_inputs(train, test)
    indexer = StringIndexer(inputCol="failure_type", outputCol="label", handleInvalid="keep")
    forest = RandomForestClassifier(numTrees=trees, seed=SEED)
    scored = Pipeline(stages=[indexer, _assemble(), forest]).fit(train).transform(test)
    return stage_table(scored.select("machine_id", "timestamp", "failure_type", "label", "prediction"))


def type_classifier(train: DataFrame, test: DataFrame, trees: int = 20) -> DataFrame:
    """Accuracy and macro F1 over all test rows."""
    return evaluation.several(type_predictions(train, test, trees))


def remaining_hours_predictions(train: DataFrame, test: DataFrame, rounds: int = 10) -> DataFrame:
    """Hours to the next intervention, of all test rows that have one; and the mean of the training rows. Stored."""
    known = F.col("hours_to_next_intervention").isNotNull()
    trees = GBTRegressor(labelCol="hours_to_next_intervention", maxIter=rounds, seed=SEED)
    train, test = fill_inputs(train.filter(known), test.filter(known))
    model = Pipeline(stages=[_assemble(), trees]).fit(train)
    usual = train.agg(F.avg("hours_to_next_intervention")).first()[0]
    return stage_table(model.transform(test).select(
        "machine_id", "timestamp", F.col("hours_to_next_intervention").alias("label"), "prediction", F.lit(usual).alias("usual")))


def remaining_hours_regressor(train: DataFrame, test: DataFrame, rounds: int = 10) -> DataFrame:
    """Mean absolute error of the model and of the training mean."""
    scored = remaining_hours_predictions(train, test, rounds)
    return scored.agg(F.count("*").alias("n_test"), F.avg(F.abs(F.col("label") - F.col("prediction"))).alias("mae"),
                      F.avg(F.abs(F.col("label") - F.col("usual"))).alias("mae_of_mean"))
