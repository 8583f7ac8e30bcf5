"""Scoring of a stream and the request/response log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.training import score

MILLION = 1_000_000
# Open requests carry every feature, so their number must not be bounded by an executor's heap: they are kept on its disk, in one
# store a partition (the join's third layout), with this much memory for all stores of an executor together.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def score_stream(stream: DataFrame, model: PipelineModel, keep: Sequence[str] | None = None) -> DataFrame:
    """Fraud probability of each arriving record; stateless, so no watermark."""
    return score(model, stream, keep)


def sampled(df: DataFrame, row_id: str, rate: float = 1.0) -> DataFrame:
    """Rows chosen by a hash of their id: a replayed batch logs the same ones."""
    if not 0 <= rate <= 1:
        raise ValueError(f"rate must lie between 0 and 1, not {rate}")
    if rate == 1:
        return df
    return df.where(F.pmod(F.xxhash64(row_id), F.lit(MILLION)) < int(rate * MILLION))


def labelled_log(
    requests: DataFrame, labels: DataFrame, model: PipelineModel, row_id: str, requested: str, settled: str,
    delay_days: int = 7, grace: str = "1 day", late: str = "1 hour",
) -> DataFrame:
    """Every request with its score and the label that settles ``delay_days`` later, streaming or batch.

    A label counts when it comes between the delay and ``grace`` after it.  In a
    stream a request with a label is sent as soon as both are there; one without is sent with
    NULL once its interval has passed, records up to ``late`` out of order included.
    The state holds requests and labels of open intervals only.
    """
    scored = score(model, requests)
    names = [c for c in labels.columns if c != row_id]
    if requests.isStreaming:
        scored, labels = scored.withWatermark(requested, late), labels.withWatermark(settled, late)
    right = labels.select(F.col(row_id).alias("_label_id"), *names)
    due = F.col(requested) + F.expr(f"INTERVAL {int(delay_days)} DAYS")
    match = (F.col(row_id) == F.col("_label_id")) & (F.col(settled) >= due) & (F.col(settled) <= due + F.expr(f"INTERVAL {grace}"))
    return scored.join(right, match, "left_outer").drop("_label_id")


def append_log(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Start appending to a Parquet log, exactly once through the checkpoint.

    The state is kept as ``STATE`` says; a log that was started otherwise goes on as its checkpoint says.
    """
    conf = stream.sparkSession.conf
    before = {key: conf.get(key, None) for key in STATE}
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    try:
        for key, value in STATE.items():
            conf.set(key, value)
        return writer.start()  # which takes a copy of the session's settings
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)
