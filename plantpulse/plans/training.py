"""Training: gold rows to model tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import dbscan, scaling, scoring
from ..operators.scaling import KEY
from ..session import stage_table


@dataclass(frozen=True)
class Model:
    """A trained model as tables; nothing of it lives on the driver."""

    scaler: DataFrame
    points: DataFrame
    eps: float
    min_samples: int

    @property
    def reference(self) -> DataFrame:
        return dbscan.reference_points(self.points)

    @cached_property
    def index(self) -> scoring.ReferenceIndex:
        """The tree over the reference points, grown once for all that score with the model or store it."""
        return scoring.index_points(self.reference)

    @property
    def summary(self) -> DataFrame:
        return dbscan.model_summary(self.points)


def scaled_rows(gold: DataFrame, min_samples: int = C.MIN_SAMPLES, models: str = "all"
                ) -> tuple[DataFrame, DataFrame]:
    """Standardised rows per model and the scaler table.

    `models` is `all`, `machines` or `global`.
    """
    rows = scaling.model_rows(scaling.model_matrix(gold), min_samples)
    if models == "machines":
        rows = rows.filter(F.col(KEY) != C.GLOBAL_MODEL)
    elif models == "global":
        rows = rows.filter(F.col(KEY) == C.GLOBAL_MODEL)
    rows = stage_table(rows)
    scaler = stage_table(scaling.fit_scaler(rows))
    return scaling.standardise(rows, scaler), scaler


def train(gold: DataFrame, eps: float = C.EPS, min_samples: int = C.MIN_SAMPLES,
          models: str = "all") -> Model:
    scaled, scaler = scaled_rows(gold, min_samples, models)
    if scaler.filter(F.col(KEY) != C.GLOBAL_MODEL).isEmpty() and models != "global":
        raise ValueError("no machine has enough rows to train on")
    points = stage_table(dbscan.cluster_points(scaled, eps, min_samples))
    return Model(scaler, points, eps, min_samples)
