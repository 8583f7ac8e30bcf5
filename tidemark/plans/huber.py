"""Linear classifier with the modified Huber loss, fitted by damped Newton steps.

    loss(m) = max(0, 1 - m)^2  for m >= -1,  -4 m  below,   m = y f(x), y in {-1, 1}
    minimise  mean loss + alpha / 2 |w|^2   (the intercept is free)

Where -1 < m < 1 the loss is the squared error of f against y, beyond 1 it is 0, below -1 a straight
line.  So a Newton step is one weighted least-squares fit: weight 1 and target y in the middle, weight 0
above, and below a target that gives the line's slope and a small curvature.  MLlib solves it
from one aggregation of the normal equations; a second aggregation finds the losses at
eight step lengths and the slope along the step.  When the set of rows in the middle stops
changing, so does the solution.  Margins come from the fitted models themselves: the weights between two
steps are a mix of those fitted so far.  No row leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

STEPS = (1.0, 0.5, 0.25, 0.125, 0.0625, 0.03125, 0.01, 0.001)
BEND = 0.5  # weight of rows on the straight part
# Class and probability from the margin; a stage like any other, so the model can be stored.
DECIDE = (
    "SELECT *, CAST(CASE WHEN margin > 0 THEN 1 ELSE 0 END AS DOUBLE) AS prediction, "
    "(greatest(-1D, least(1D, margin)) + 1D) / 2D AS positive_probability FROM __THIS__"
)


@dataclass(frozen=True)
class HuberFit:
    model: LinearRegressionModel
    loss: float
    slope: float  # along the last Newton step
    steps: int

    @property
    def stages(self) -> list:
        return [self.model, SQLTransformer(statement=DECIDE)]


def modified_huber(margin: Column) -> Column:
    short = F.greatest(F.lit(0.0), F.lit(1.0) - margin)
    return F.when(margin < -1, -4.0 * margin).otherwise(short * short)


def _slope(margin: Column) -> Column:
    return F.when(margin < -1, F.lit(-4.0)).otherwise(-2.0 * F.greatest(F.lit(0.0), F.lit(1.0) - margin))


def linear(x: Column, weights: Sequence[float], intercept: float) -> Column:
    """Weighted sum of an array column."""
    terms = F.zip_with(x, F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b)
    return F.aggregate(terms, F.lit(float(intercept)), lambda a, b: a + b)


def prepared(rows: DataFrame, label: str, features: str = "features") -> DataFrame:
    """Vector, array and sign of every row, written once for all steps."""
    sign = (F.col(label).cast("double") * 2 - 1).alias("y")
    return stage(rows.select(F.col(features).alias("features"), vector_to_array(features).alias("x"), sign), "margins")


def objective(rows: DataFrame, weights: Sequence[float], intercept: float, alpha: float) -> float:
    mean = rows.agg(F.avg(modified_huber(F.col("y") * linear(F.col("x"), weights, intercept)))).scalar()
    return rows.select(mean).first()[0] + alpha / 2 * float(np.dot(weights, weights))


def gradient(rows: DataFrame, weights: Sequence[float], intercept: float, alpha: float) -> np.ndarray:
    """Of the objective, by each weight and then the intercept."""
    pull = rows.select("x", (F.col("y") * _slope(F.col("y") * linear(F.col("x"), weights, intercept))).alias("r"))
    sums = pull.agg(*[F.avg(F.col("r") * F.col("x")[i]).alias(f"g{i}") for i in range(len(weights))], F.avg("r").alias("b")).first()
    return np.array(sums, dtype=float) + alpha * np.append(np.asarray(weights, dtype=float), 0.0)


def _with_margin(rows: DataFrame, mix: Sequence[tuple[float, LinearRegressionModel]]) -> DataFrame:
    """Adds ``_now``, the margin of a mix of fitted models (0 for an empty one)."""
    kept, total = rows.columns, F.lit(0.0)
    for i, (share, model) in enumerate(mix):
        rows = model.transform(rows).withColumnRenamed("margin", f"_m{i}")
        total = total + F.lit(float(share)) * F.col(f"_m{i}")
    return rows.select(*kept, total.alias("_now"))


def fit_modified_huber(rows: DataFrame, label: str, alpha: float = 1e-4, max_iter: int = 1000, tol: float = 1e-3) -> HuberFit:
    """``rows`` holds ``features`` and a 0/1 label.  Stops when the slope along the Newton step is below ``tol`` / 100 000 of the loss."""
    sign = (F.col(label).cast("double") * 2 - 1).alias("y")
    rows = stage(rows.select("features", sign), "margins")
    n, first = rows.count(), rows.first()
    if not n:
        raise ValueError("no rows to fit")
    w, y, now = np.zeros(first["features"].size), F.col("y"), F.col("_now")
    mix: list[tuple[float, LinearRegressionModel]] = []  # shares of fitted models in the weights of this step
    stored = rows
    for step in range(1, max_iter + 1):
        rows = _with_margin(stored, mix)
        margin = y * now
        target = F.when(margin < -1, now + 2.0 / BEND * y).otherwise(y)
        weight = F.when(margin < -1, F.lit(BEND)).otherwise((margin < 1).cast("double"))
        asked = rows.select("features", target.alias("target"), weight.alias("weight")).where("weight > 0")
        size = asked.agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("target")).alias("s"), F.sum(F.col("weight") * F.col("target") ** 2).alias("q")).first()
        if not size["w"]:  # every row lies beyond its margin: only the penalty pulls
            target = y
            asked = rows.select("features", target.alias("target"), F.lit(1.0).alias("weight"))
            size = {"w": float(n), "s": rows.agg(F.sum("y")).first()[0], "q": float(n)}
        # The solver measures the penalty in units of the target's weighted deviation.
        spread = np.sqrt(max(size["q"] / size["w"] - (size["s"] / size["w"]) ** 2, 0.0))
        solver = LinearRegression(
            featuresCol="features", labelCol="target", weightCol="weight", predictionCol="margin", solver="normal",
            regParam=alpha * n / (2 * size["w"]) * (spread or 1.0), elasticNetParam=0.0, standardization=False,
            tol=1e-14, maxIter=10_000,  # met on the driver, over the sums, where a column is constant
        )
        model = solver.fit(asked)
        goal = model.coefficients.toArray()
        along = model.transform(rows).select(y.alias("y"), now.alias("f"), (F.col("margin") - now).alias("d"))
        f, d, y_ = F.col("f"), F.col("d"), F.col("y")
        found = along.agg(
            F.avg(modified_huber(y_ * f)).alias("loss"), F.avg(_slope(y_ * f) * y_ * d).alias("slope"),
            *[F.avg(modified_huber(y_ * (f + t * d))).alias(f"at{i}") for i, t in enumerate(STEPS)],
        ).first()
        loss = found["loss"] + alpha / 2 * w @ w
        slope = found["slope"] + alpha * w @ (goal - w)
        at = [found[f"at{i}"] + alpha / 2 * float(np.dot(v := w + t * (goal - w), v)) for i, t in enumerate(STEPS)]
        if abs(slope) <= 1e-5 * tol * max(loss, 1e-12) and at[0] <= loss * (1 + 1e-9):
            return HuberFit(model, at[0], slope, step)
        best = min(range(len(STEPS)), key=lambda i: at[i])
        if at[best] >= loss:
            break
        t = STEPS[best]
        w = w + t * (goal - w)
        mix = [*((share * (1 - t), m) for share, m in mix if t < 1), (t, model)]
    return HuberFit(model, at[0], slope, step)
