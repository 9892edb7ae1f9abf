"""The batch job: bronze files to silver, gold, serving tables and a model."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import constants as C
from ..operators import interventions
from ..session import drop_staged, staged_mark, use_utc
from ..sources import bronze_csv, layers, serving
from . import gold as gold_plan
from . import silver as silver_plan
from . import training


def ingest(spark: SparkSession, bronze: str, root: str, version: str | None = None) -> str | None:
    """Read bronze, write one version of silver and gold, refresh serving.

    Files that cannot be used are listed, with a reason, in a layer of their own.
    Each layer is written before the next step reads it back, so a lost executor
    never recomputes past the last layer. Returns the version, or None when there
    was nothing to write.
    """
    use_utc(spark)
    mark = staged_mark()
    version = version or layers.new_version(spark)
    files = bronze_csv.inspect_files(spark, bronze)
    layers.write_layer(bronze_csv.rejected_files(spark, bronze, files), root, "rejected_files", version)
    silver = silver_plan.silver(bronze_csv.read_sensors(spark, bronze, files))
    if not layers.write_layer(silver, root, "silver", version):
        return None
    log = interventions.clean_interventions(bronze_csv.read_interventions(spark, bronze, files))
    layers.write_layer(log, root, "interventions", version)
    silver = layers.read_version(spark, root, "silver", version)
    log = layers.read_version(spark, root, "interventions", version) or log.limit(0)
    layers.write_layer(gold_plan.gold(silver, log), root, "gold", version)
    serving.refresh(silver, log, layers.read_version(spark, root, "gold", version), f"{root}/serving")
    drop_staged(spark, mark)
    return version


def retrain(spark: SparkSession, root: str, version: str | None = None, eps: float = C.EPS,
            min_samples: int = C.MIN_SAMPLES) -> str:
    """Train on the newest gold layer and store the model."""
    use_utc(spark)
    mark = staged_mark()
    source = layers.latest_version(spark, root, "gold")
    if source is None:
        raise FileNotFoundError(f"no gold layer under {root}")
    version = version or layers.new_version(spark)
    model = training.train(layers.read_version(spark, root, "gold", source), eps, min_samples)
    layers.save_model(model, f"{root}/models", version, f"gold/{source}")
    drop_staged(spark, mark)
    return version
