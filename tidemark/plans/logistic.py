"""Logistic regression by damped Newton steps over stored rows.

    minimise  mean loss + penalty / 2 |w|^2,   loss = log(1 + exp(-y f(x))),   y in {-1, 1}   (the intercept is free)

The objective of MLlib's ``LogisticRegression`` without standardisation, which keeps every training row as a dense
block in memory or on the executors' disks until the fit is over.  Here a pass reads the rows where they
are written and a task leaves one small table: loss, gradient and second derivatives.  A step that does not lower
the objective enough is halved; the fit ends when a full step could lower it no further.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.shards import SHARDS

ROWS = 4096  # rows that are multiplied at once


def sums(x: np.ndarray, label: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Loss, gradient and second derivatives (by each weight, then the intercept) added over the rows, as one array."""
    d = x.shape[1] + 1
    loss, slope, bend = 0.0, np.zeros(d), np.zeros((d, d))
    for low in range(0, len(x), ROWS):
        y = label[low : low + ROWS]
        part = np.hstack([x[low : low + ROWS], np.ones((len(y), 1))])
        margin = part @ weights
        p = 0.5 * (1.0 + np.tanh(0.5 * margin))
        loss += float((np.logaddexp(0.0, margin) - y * margin).sum())
        slope += (p - y) @ part
        bend += (part * (p * (1.0 - p))[:, None]).T @ part
    return np.concatenate([[loss], slope, bend.ravel()])


def totals(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """``sums`` over all rows (``x`` an array, ``y`` 0 or 1): a row a task, added up by groups of tasks and then here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, found = TaskContext.get().partitionId(), None
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                part = sums(x, batch.column(1).to_numpy(zero_copy_only=False), weights)
                found = part if found is None else found + part
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([task % SHARDS]), pa.array([task]), pa.array([found.tobytes()], pa.binary())], ["shard", "task", "sums"])

    def added(group: pa.Table) -> pa.Table:
        blobs = group.sort_by("task").column("sums").to_pylist()  # an order of their own, so the digits repeat
        whole = np.sum([np.frombuffer(blob, np.float64) for blob in blobs], axis=0)
        return group.slice(0, 1).select(["shard"]).append_column("sums", pa.array([whole.tobytes()], pa.binary()))

    merged = rows.mapInArrow(run, "shard bigint, task bigint, sums binary").groupBy("shard").applyInArrow(added, "shard bigint, sums binary")
    return np.sum([np.frombuffer(r["sums"], np.float64) for r in sorted(merged.collect(), key=lambda r: r["shard"])], axis=0)


def newton(rows: DataFrame, count: int, positives: int, width: int, penalty: float, max_iter: int, tol: float) -> np.ndarray | None:
    """Weights and intercept of the least objective; None where numbers run out of range."""
    pull = np.append(np.full(width, penalty), 0.0)

    def at(w: np.ndarray):
        found = totals(rows, w) / count
        return found[0] + pull @ (w * w) / 2, found[1 : width + 2] + pull * w, found[width + 2 :].reshape(width + 1, -1) + np.diag(pull)

    w = np.zeros(width + 1)
    w[-1] = np.log(positives / (count - positives))
    value, slope, bend = at(w)
    passes = 1
    while passes < max(2, max_iter):
        if not (np.isfinite(value) and np.isfinite(slope).all() and np.isfinite(bend).all()):
            return None
        unit = np.sqrt(np.maximum(np.diag(bend), 1e-300))  # columns of any size weigh alike
        step = -np.linalg.lstsq(bend / unit[:, None] / unit, slope / unit, rcond=1e-14)[0] / unit
        fall, share = slope @ step, 1.0
        if -fall <= 1e-5 * tol * max(value, 1e-12):
            break
        while True:
            tried = at(w + share * step)
            passes += 1
            if tried[0] <= value + 1e-4 * share * fall:
                break
            share /= 2
            if share < 1e-6 or passes >= max_iter:
                return w
        w, (value, slope, bend) = w + share * step, tried
    return w


def fit_logistic(estimator: LogisticRegression, rows: DataFrame, label: str, count: int, positives: int) -> LogisticRegressionModel | None:
    """The model ``estimator`` asks for, from ``features`` and a 0/1 label of which both values occur; None where numbers run out of range."""
    stored = rows.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"))
    first = stored.first()
    width = len(first["x"])
    w = newton(stored, count, positives, width, estimator.getRegParam(), estimator.getMaxIter(), estimator.getTol())
    if w is None:
        return None
    sc = rows.sparkSession.sparkContext
    java = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(estimator.uid, _py2java(sc, Vectors.dense(w[:-1])), float(w[-1]))
    return estimator._copyValues(LogisticRegressionModel(java))
