"""Windowed histograms of served features, for drift checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stats import binned, drift


def window_histograms(
    df: DataFrame, ts: str, columns: Sequence[str], edges: DataFrame, window: str = "6 hours", late: str = "1 hour", bins: int = 10
) -> DataFrame:
    """Counts per (window, feature, bin), batch or streaming.

    The state is one number per open window, feature and bin.  Rows later than
    ``late`` behind the newest are dropped from a stream.
    """
    timed = df.withColumn("_ts", F.col(ts).cast("timestamp"))
    if df.isStreaming:
        timed = timed.withWatermark("_ts", late)
    spread = binned(timed, columns, edges, bins, keep=["_ts"])
    return (
        spread.groupBy(F.window("_ts", window), "feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "feature", "bin", "n")
    )


def write_histograms(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append closed windows to a table."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def drift_report(histogram_table: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Distances between consecutive closed windows with alerts."""
    return drift(histogram_table, thresholds)


def alert_writer(folder: str, thresholds: Mapping[str, float], steps: Callable[[DataFrame, Mapping[str, float]], DataFrame] = drift):
    """A ``foreachBatch`` function that compares every closed window with the one before it.

    ``steps`` turns windows into distances with alerts: ``drift`` for histograms, ``share_steps`` for
    attributions.  Each batch owns three folders named by its id below ``folder``: the closed ``windows``,
    their ``alerts`` and ``newest``, the last window of each feature, which the next batch starts
    from.  A replayed batch reads what its predecessor left and overwrites its own folders, so nothing is
    written twice and no window is compared twice.  The work of a batch depends on its own windows only.
    """

    def write(closed: DataFrame, batch_id: int) -> None:
        spark, schema = closed.sparkSession, closed.schema

        def stored(df: DataFrame, name: str) -> DataFrame:
            path = f"{folder}/{name}/batch={batch_id}"
            df.write.mode("overwrite").parquet(path)
            return spark.read.schema(df.schema).parquet(path)

        known = stored(closed, "windows")
        if batch_id:
            known = known.unionByName(spark.read.schema(schema).parquet(f"{folder}/newest/batch={batch_id - 1}"))
        stored(steps(known, thresholds), "alerts")
        last = known.groupBy("feature").agg(F.max("window_start").alias("window_start"))
        stored(known.join(last, ["feature", "window_start"], "left_semi").select(*closed.columns), "newest")

    return write


def watch(
    closed: DataFrame, folder: str, thresholds: Mapping[str, float], steps: Callable = drift, trigger: dict | None = None,
    writer: Callable[[DataFrame, int], None] | None = None,
):
    """Alerts of a live stream of closed windows (``window_histograms``, ``window_attributions``); progress is kept in the folder as well."""
    return (
        closed.writeStream.outputMode("append")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(writer or alert_writer(folder, thresholds, steps))
        .start()
    )


def read_alerts(spark, folder: str) -> DataFrame:
    """All alerts so far: (window_start, feature, distance, threshold, alert)."""
    return spark.read.parquet(f"{folder}/alerts").drop("batch")
