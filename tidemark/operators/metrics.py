"""Exact classification metrics as distributed aggregations.

Ranking metrics need cumulative counts over all scores in descending order.
Rows first collapse to one per distinct score, then `running_totals` adds the
counts up without a table-wide sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .joins import attach
from .prefix import double_levels, id_levels, running_totals

_ONE = "_all"


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A constant group stands in for no grouping, so joins stay equi-joins."""
    return (df, list(by)) if by else (df.withColumn(_ONE, F.lit(1)), [_ONE])


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _levels(scored: DataFrame, label: str, score: str) -> DataFrame:
    """One row per group ``_key`` and distinct score, written once for all metrics: the counts of `threshold_counts`, and rows without a label."""
    known = F.col(label).isNotNull()
    present = scored.where(F.col(score).isNotNull())
    per_score = present.groupBy("_key", score).agg(
        F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).alias("pos"), F.count_if(known).alias("rows"), F.count_if(~known).alias("blank")
    )
    per_score = per_score.withColumn("neg", F.col("rows") - F.col("pos")).drop("rows")
    falling = -F.col(score).cast("double")
    out = running_totals(per_score, double_levels(falling), [falling], {n: F.col(n) for n in ("pos", "neg", "blank")}, ["_key"])
    up_to = [(F.col(f"{n}_before") + F.col(n)).alias(a) for n, a in (("pos", "tp"), ("neg", "fp"), ("blank", "unlabelled"))]
    return stage(out.select("_key", F.col(score).alias("threshold"), "pos", "neg", "blank", *up_to), "thresholds")


def threshold_counts(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score: positives and negatives at it, and at or above it.

    Rows without a score or label do not take part; a score that is no number (NaN) ranks last.
    """
    keys = list(by)
    present = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    per_score = present.groupBy(*keys, score).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("rows")
    )
    per_score = per_score.withColumn("neg", F.col("rows") - F.col("pos")).drop("rows")
    falling = -F.col(score).cast("double")
    out = running_totals(
        per_score, double_levels(falling), [falling], {"pos": F.col("pos"), "neg": F.col("neg")}, keys
    )
    return out.select(
        *keys,
        F.col(score).alias("threshold"),
        "pos",
        "neg",
        (F.col("pos_before") + F.col("pos")).alias("tp"),
        (F.col("neg_before") + F.col("neg")).alias("fp"),
    )


def confusion_metrics(scored: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F-beta in one pass; 0 where a denominator is empty."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = scored.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn")
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def f_beta(beta: float) -> Column:
        square = beta * beta
        return _ratio(tp * F.lit(1 + square), tp * F.lit(1 + square) + fn * F.lit(square) + fp)

    return counts.select(
        *by,
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        f_beta(1.0).alias("f1_score"),
        f_beta(2.0).alias("f2_score"),
        f_beta(0.5).alias("f05_score"),
    )


def ranking_metrics(scored: DataFrame, label: str, score: str, by: Sequence[str] = (), levels: DataFrame | None = None) -> DataFrame:
    """Average precision (step sum over distinct scores) and ROC AUC (ties count half).

    Average precision is 0 without positives; the AUC of one class alone is NULL.
    """
    scored, keys = _grouped(scored, by)
    # The keys travel as one struct, so a NULL group is a group like any other.
    if levels is None:
        counts = threshold_counts(scored.select(F.struct(*keys).alias("_key"), label, score), label, score, ["_key"])
    else:
        counts = levels.where("pos + neg > 0")
    # Twice the number of correctly ordered pairs; exact in 38 digits.
    pairs = F.col("neg").cast("decimal(18,0)") * (F.col("tp") * 2 - F.col("pos")).cast("decimal(19,0)")
    sums = counts.groupBy("_key").agg(
        F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("area"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
        F.sum(pairs).cast("double").alias("pairs"),
    )
    return sums.select(
        *[F.col(f"_key.`{c}`").alias(c) for c in by],
        _ratio(F.col("area"), F.col("p")).alias("average_precision"),
        F.try_divide(F.col("pairs"), F.lit(2.0) * F.col("p") * F.col("n")).alias("roc_auc"),
    )


def precision_at_k(
    scored: DataFrame, label: str, score: str, k: int = 200, by: Sequence[str] = (), tie: str | None = None, levels: DataFrame | None = None
) -> DataFrame:
    """Share of positives among the k highest scores, always divided by k.

    ``tie``, an integer column, orders equal scores; without it the negatives
    of the last score come first.  The cut is found from counts by score, then
    only rows of the score it falls on are ranked, so the plan is the same for any k.
    """
    scored, keys = _grouped(scored, by)
    scored = scored.where(F.col(score).isNotNull()).withColumn(label, F.coalesce(F.col(label).cast("bigint"), F.lit(0)))
    keyed = scored.select(F.struct(*keys).alias("_key"), label, score, *([tie] if tie else []))
    if levels is None:
        levels = threshold_counts(keyed, label, score, ["_key"])
    else:  # a row without a label is none of the positives
        levels = levels.withColumns({"neg": F.col("neg") + F.col("blank"), "fp": F.col("fp") + F.col("unlabelled")})
    levels = levels.withColumn("above", F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg"))
    levels = levels.where(F.col("above") < k)
    whole = F.col("above") + F.col("pos") + F.col("neg") <= k
    sure = levels.groupBy("_key").agg(F.coalesce(F.sum(F.when(whole, F.col("pos"))), F.lit(0)).alias("hits"))
    edge = levels.where(~whole).select("_key", F.col("threshold").alias("_edge"), (F.lit(k) - F.col("above")).alias("_room"), "neg")
    if tie is None:
        part = edge.select("_key", F.greatest(F.lit(0), F.col("_room") - F.col("neg")).alias("more"))
    else:
        rows = attach(keyed, edge.drop("neg"), ["_key"], "inner").where(F.col(score) == F.col("_edge"))
        ranked = running_totals(rows, id_levels(F.col(tie).cast("bigint")), [tie], {"_rank": F.lit(1)}, ["_key"])
        part = ranked.where(F.col("_rank_before") < F.col("_room")).groupBy("_key").agg(F.sum(label).alias("more"))
    out = attach(sure, part, ["_key"])
    share = (F.col("hits") + F.coalesce("more", F.lit(0))) / F.lit(float(k))
    return out.select(*[F.col(f"_key.`{c}`").alias(c) for c in by], share.alias(f"precision_top_{k}"))


def pr_curve(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every distinct score, plus the end point (1, 0).

    Recall is 1 everywhere when there are no positives.
    """
    scored, keys = _grouped(scored, by)
    counts = threshold_counts(scored.select(F.struct(*keys).alias("_key"), label, score), label, score, ["_key"])
    totals = counts.groupBy("_key").agg(F.sum("pos").alias("p"))
    named = [F.col(f"_key.`{c}`").alias(c) for c in keys]
    points = attach(counts, totals, ["_key"]).select(
        *named,
        F.col("threshold").cast("double").alias("threshold"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("p").cast("double")), F.lit(1.0)).alias("recall"),
    )
    end = totals.select(
        *named, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end).select(*by, "threshold", "precision", "recall")


def evaluate(
    scored: DataFrame,
    label: str = "is_fraud",
    score: str = "score",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    k: int = 200,
    tie: str | None = None,
) -> DataFrame:
    """All scalar metrics, one row per group.  The counts by score are found once."""
    scored, keys = _grouped(scored, by)
    levels = _levels(scored.select(F.struct(*keys).alias("_key"), label, score), label, score)
    out = confusion_metrics(scored, label, prediction, keys)
    out = attach(out, ranking_metrics(scored, label, score, keys, levels), keys, null_safe=keys)
    out = attach(out, precision_at_k(scored, label, score, k, keys, tie, levels), keys, null_safe=keys)
    return out if by else out.drop(_ONE)


def select_best(metrics: DataFrame, metric: str, name: str = "model", higher: bool = True, names: Sequence[str] = ()) -> DataFrame:
    """The winning row; of equal ones the first in ``names`` wins, then the first by name."""
    order = F.col(metric).desc_nulls_last() if higher else F.col(metric).asc_nulls_last()
    listed = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(name)) if names else F.lit(0)
    return metrics.orderBy(order, F.when(listed > 0, listed).otherwise(len(names) + 1), name).limit(1).select(name, metric)


def challenge(champion: DataFrame, challenger: DataFrame, metric: str, threshold: float = 0.0, higher: bool = True) -> DataFrame:
    """One row: is the challenger better by more than the threshold?  None without a champion."""
    sides = (
        champion.select(F.lit("a").alias("side"), F.col(metric).alias("m"))
        .unionByName(challenger.select(F.lit("b").alias("side"), F.col(metric).alias("m")))
        .agg(
            F.max(F.when(F.col("side") == "a", F.col("m"))).alias("champion_metric"),
            F.max(F.when(F.col("side") == "b", F.col("m"))).alias("challenger_metric"),
        )
        .where(F.col("champion_metric").isNotNull())
    )
    new, old = F.col("challenger_metric"), F.col("champion_metric")
    better = new > old + threshold if higher else new < old - threshold
    return sides.select(F.coalesce(better, F.lit(False)).alias("challenger_better"), "champion_metric", "challenger_metric")
