"""Live scoring of a stream of sensor rows (ST03, ST04, ST06, ST07)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import scoring
from ..sources import layers, serving


def score_batch(spark: SparkSession, batch: DataFrame, batch_id: int, models: str, out: str,
                stamp=None, eps: float = C.EPS, threshold: float = C.ALERT_THRESHOLD, stream: str | None = None) -> None:
    """Clamp, shape, validate and score one batch; store sensors and predictions.

    The newest model is looked up per batch, so a retrained one takes over at
    the next batch. Its reference is a stored tree; a batch opens the leaves near its
    readings and neither writes nor aggregates reference points. Outputs are keyed by stream and batch id: a repeated batch
    replaces itself. Rows that fail validation go to a quarantine table. Without
    a model the batch fails, so it is not committed and comes again.
    """
    model = layers.load_model(spark, models)
    if model is None:
        raise RuntimeError(f"no model under {models}; batch {batch_id} waits")
    version, scaler, reference = model
    stream = stream or serving.stream_name(spark)
    # What a batch is made of is worked out once: the stored records are validated and scored.
    records = serving.append_batch(scoring.sensor_records(batch, stamp), out, "sensor_data", str(batch_id), stream)
    readings = scoring.to_readings(records, extra=["timestamp"])
    good, bad = scoring.valid_readings(readings)
    serving.append_batch(bad, out, "quarantine", str(batch_id), stream)
    scored = scoring.score(good, scaler, reference, eps, threshold, known=False).withColumnRenamed("timestamp", "recorded_at")
    serving.append_batch(serving.prediction_rows(scored, version), out, "predictions", str(batch_id), stream)


def live_scoring(stream: DataFrame, models: str, out: str, checkpoint: str,
                 restamp: Callable[[], object] | None = None, eps: float = C.EPS):
    """Start scoring every batch of the stream; returns the running query.

    A failing batch stops the query and is retried from the checkpoint.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch.sparkSession, batch, batch_id, models, out,
                    restamp() if restamp else None, eps)

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def now_stamp():
    return F.current_timestamp()
