"""Shapley values of every scored row, and how their shares move between tables and windows.

A linear model's values are weight times scaled input on top of the intercept.  A tree is a
sum of leaves: a leaf adds its value where all conditions of its path hold.  With some
inputs unknown, the path's share of training rows stands in for their conditions, so a
leaf is a product game over the distinct features of its path (at most the depth) and
its Shapley values follow from which of these conditions hold, a bit each.  All patterns of a tree's leaves are worked
out once a task from the stored node table; a row then looks up one entry a leaf.  The node table
grows with the model, never with the data.

The margin explained is the probability of class 1 for a forest, half the log-odds for boosted trees, and the linear
function otherwise; base plus values equals it on every row.
"""

from __future__ import annotations

from collections.abc import Mapping
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..session import stage_path
from .stats import with_alerts

DEEPEST = 10
TOGETHER = 2000  # rows whose conditions a task holds


class Leaves:
    """The leaves of one tree: value, and per path feature its interval and its share of training rows."""

    def __init__(self, nodes: dict[int, dict], leaf_value, weight: float):
        self.paths: list[tuple[float, dict[int, tuple[float, float, float]]]] = []
        self._walk(nodes, 0, {}, leaf_value, weight)
        self.depth = max([len(p) for _, p in self.paths] + [1])
        if self.depth > DEEPEST:
            raise ValueError(f"a path tests more than {DEEPEST} features")
        shape = (len(self.paths), self.depth)
        self.feature, self.share = np.zeros(shape, np.int64), np.ones(shape)
        self.low, self.high = np.full(shape, -np.inf), np.full(shape, np.inf)
        for i, (_, path) in enumerate(self.paths):
            for j, (f, (low, high, share)) in enumerate(path.items()):
                self.feature[i, j], self.low[i, j], self.high[i, j], self.share[i, j] = f, low, high, share
        self.value = np.array([v for v, _ in self.paths])

    def _walk(self, nodes, at, path, leaf_value, weight):
        node = nodes[at]
        if node["leftChild"] < 0:
            self.paths.append((weight * leaf_value(node), path))
            return
        split, rows = node["split"], sum(nodes[node[c]]["rawCount"] for c in ("leftChild", "rightChild"))
        if split["numCategories"] != -1:
            raise ValueError("splits on categories have no threshold")
        f, threshold = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        for child, bounds in (("leftChild", (low, min(high, threshold))), ("rightChild", (max(low, threshold), high))):
            part = nodes[node[child]]["rawCount"] / rows
            self._walk(nodes, node[child], {**path, f: (*bounds, share * part)}, leaf_value, weight)

    @property
    def base(self) -> float:
        return float((self.value * self.share.prod(axis=1)).sum())

    def table(self) -> np.ndarray:
        """Shapley values by (leaf, pattern of conditions that hold, place on the path)."""
        m = self.depth
        holds = ((np.arange(1 << m)[:, None] >> np.arange(m)) & 1).astype(float)
        out = np.zeros((len(self.value), 1 << m, m))
        for i in range(m):
            # Coefficients of the product of (share + holds t) over the other features: sums over known sets by size.
            sums = np.zeros((len(self.value), 1 << m, m))
            sums[:, :, 0] = 1
            for j in range(m):
                if j != i:
                    grown = sums * self.share[:, j, None, None]
                    grown[:, :, 1:] += sums[:, :, :-1] * holds[None, :, j, None]
                    sums = grown
            by_size = np.array([factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)])
            out[:, :, i] = (sums @ by_size) * (holds[None, :, i] - self.share[:, i, None]) * self.value[:, None]
        return out

    def values(self, x: np.ndarray, table: np.ndarray, total: np.ndarray) -> None:
        """Add each row's values to ``total``."""
        known = x[:, self.feature]
        pattern = ((known > self.low) & (known <= self.high)) @ (1 << np.arange(self.depth))
        found = table[np.arange(len(self.value)), pattern]
        flat = np.arange(len(x))[:, None, None] * total.shape[1] + self.feature
        total += np.bincount(flat.ravel(), weights=found.ravel(), minlength=total.size).reshape(total.shape)


def trees_of(model, spark) -> list[Leaves]:
    """The leaves of all trees of a forest or of boosted trees, read from the stored node table."""
    path = stage_path(spark, "trees")
    model.write().save(path)
    trees: dict[int, dict[int, dict]] = {}
    for row in spark.read.parquet(f"{path}/data").collect():  # as many rows as the model has nodes
        trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"].asDict(recursive=True)
    weights = list(model.treeWeights)
    if model.numClasses == 2 and type(model).__name__.startswith("RandomForest"):
        return [Leaves(trees[k], lambda n: n["impurityStats"][1] / sum(n["impurityStats"]), 1 / len(trees)) for k in sorted(trees)]
    return [Leaves(trees[k], lambda n: n["prediction"], weights[k]) for k in sorted(trees)]


def explain(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, margin, base and ``contributions`` (an array in order of the model's inputs) of every row."""
    names, last = model.stages[0].getInputCols(), model.stages[-1]
    kept = [F.col(f"`__{c}`").alias(c) for c in keep]
    typed = df.select(*[F.col(f"`{c}`").alias(f"__{c}") for c in keep], *[F.col(f"`{f}`").cast("double").alias(f) for f in names])
    scored, x = model.transform(typed), vector_to_array("features")
    linear = model.stages[-2] if "margin" in scored.columns else last
    if hasattr(linear, "coefficients"):
        margin = F.col("margin") if linear is not last else vector_to_array("rawPrediction")[1]
        weights = F.array(*[F.lit(float(w)) for w in linear.coefficients.toArray()])
        values = F.zip_with(x, weights, lambda a, b: a * b)
        return scored.select(*kept, margin.alias("margin"), F.lit(float(linear.intercept)).alias("base"), values.alias("contributions"))
    forest = type(last).__name__.startswith("RandomForest")
    margin = vector_to_array("probability" if forest else "rawPrediction")[1]
    trees = trees_of(last, df.sparkSession)
    base = sum(t.base for t in trees)
    rows = scored.select(*kept, margin.alias("margin"), F.lit(base).alias("base"), x.alias("x"))
    place, width = len(keep) + 2, len(names)

    def run(batches):
        tables = [t.table() for t in trees]
        for batch in batches:
            x = batch.column(place).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            total = np.zeros((len(x), width))
            for low in range(0, len(x), TOGETHER):
                for tree, table in zip(trees, tables):
                    tree.values(x[low : low + TOGETHER], table, total[low : low + TOGETHER])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], lists], [*keep, "margin", "base", "contributions"])

    schema = rows.drop("x").schema.add("contributions", ArrayType(DoubleType()))
    return rows.mapInArrow(run, schema)


def mean_attributions(explained: DataFrame, names: list[str], by: list[Column] | None = None) -> DataFrame:
    """(by, feature, attribution): mean absolute contribution."""
    agg = explained.groupBy(*(by or [])).agg(*[F.avg(F.abs(F.col("contributions")[i])).alias(f"a{i}") for i in range(len(names))])
    rows = [F.struct(F.lit(n).alias("feature"), F.col(f"a{i}").alias("attribution")) for i, n in enumerate(names)]
    kept = [c for c in agg.columns if c not in {f"a{i}" for i in range(len(names))}]
    return agg.select(*kept, F.inline(F.array(*rows)))


def attributions(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, attribution): mean absolute contribution to the model's margin."""
    return mean_attributions(explain(model, df, []), list(model.stages[0].getInputCols()))


def shares(found: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Each feature's share of all attribution (0 where there is none)."""
    total = F.sum("attribution").over(W.partitionBy(*(by or [F.lit(1)])))
    return found.withColumn("share", F.coalesce(F.try_divide(F.col("attribution"), total), F.lit(0.0)))


def attribution_skew(model: PipelineModel, training: DataFrame, serving: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Change of each feature's share of all attribution, against its threshold."""
    p, q = (shares(attributions(model, df)).select("feature", F.col("share").alias(n)) for df, n in ((training, "p"), (serving, "q")))
    both = p.join(q, "feature").where(F.col("feature").isin(*thresholds))
    return with_alerts(both.select("feature", F.abs(F.col("p") - F.col("q")).alias("distance")), thresholds)


def attribution_drift(
    model: PipelineModel, df: DataFrame, ts: str, thresholds: Mapping[str, float], window: str = "6 hours"
) -> DataFrame:
    """Change of each feature's share between consecutive windows of served rows, against its threshold."""
    return share_steps(window_attributions(model, df, ts, window), thresholds)


def window_attributions(model: PipelineModel, df: DataFrame, ts: str, window: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """(window_start, feature, attribution) of served rows, batch or streaming; rows later than ``late`` are dropped from a stream."""
    timed = explain(model, df, [ts]).withColumn(ts, F.col(ts).cast("timestamp"))
    if df.isStreaming:
        timed = timed.withWatermark(ts, late)
    found = mean_attributions(timed, list(model.stages[0].getInputCols()), [F.window(ts, window).alias("_window")])
    return found.select(F.col("_window.start").alias("window_start"), "feature", "attribution")


def share_steps(found: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Change of each feature's share from one window of ``found`` to the next, against its threshold."""
    found = shares(found, ["window_start"])
    before = F.lag("share").over(W.partitionBy("feature").orderBy("window_start"))  # one row a window and feature
    steps = found.where(F.col("feature").isin(*thresholds)).withColumn("before", before).where("before IS NOT NULL")
    return with_alerts(steps.select("window_start", "feature", F.abs(F.col("share") - F.col("before")).alias("distance")), thresholds)
