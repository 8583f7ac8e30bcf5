"""Metrics against the published golden vectors, MLlib and plain Python."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from tidemark.operators import metrics as M

# Fixed values: (label, score) vectors with known precision in the first k.
LABELS_1 = [0, 0, 0, 0, 0, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 1, 0, 1, 0, 1, 0, 0]
SCORES_1 = [0.001, 0.2, 0.33, 0.00001, 0.002, 0.1, 0.1, 0, 0.1, 0.2, 0.1, 0.9, 0.4, 0.0001, 0, 0, 0.3, 0.66, 0.234, 0.1212, 0.67, 0.599, 0.4, 0.0, 0.0, 0.12]
LABELS_2 = [0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 0]
SCORES_2 = [0.99, 0.0, 0, 0.4, 0.1, 0.3, 0.23, 0.1111, 0.5, 0.44, 0.7, 0.21, 0.22, 0.56, 0.56, 0.97, 0, 0, 0, 0, 0, 0, 0.1, 0.23, 0.6, 0.0001]


def frame(spark, labels, scores, group="a"):
    rows = [(i, group, y, float(s), int(s >= 0.5)) for i, (y, s) in enumerate(zip(labels, scores))]
    return spark.createDataFrame(rows, "row_id long, model string, is_fraud int, score double, prediction int")


def python_ranking(labels, scores):
    """Average precision by distinct thresholds and AUC by pairs."""
    positives = sum(labels)
    area, last = 0.0, 0.0
    for s in sorted(set(scores), reverse=True):
        tp = sum(y for y, x in zip(labels, scores) if x >= s)
        n = sum(1 for x in scores if x >= s)
        area, last = area + (tp / positives - last) * tp / n, tp / positives
    pos = [x for y, x in zip(labels, scores) if y]
    neg = [x for y, x in zip(labels, scores) if not y]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    return area, auc


@pytest.mark.parametrize("labels,scores,k,want", [(LABELS_1, SCORES_1, 10, 0.2), (LABELS_1, SCORES_1, 5, 0.4), (LABELS_2, SCORES_2, 10, 0.2), (LABELS_2, SCORES_2, 8, 0.25)])
def test_precision_at_k_goldens(spark, labels, scores, k, want):
    assert M.precision_at_k(frame(spark, labels, scores), "is_fraud", "score", k, tie="row_id").first()[0] == pytest.approx(want)


def test_precision_at_k_divides_by_k(spark):
    assert M.precision_at_k(frame(spark, [1, 1, 0], [0.9, 0.8, 0.1]), "is_fraud", "score", 200).first()[0] == pytest.approx(0.01)


@pytest.mark.parametrize("seed", [1, 2])
def test_ranking_against_python_and_mllib(spark, seed):
    rng = random.Random(seed)
    scores = [rng.choice([rng.random() * 10.0 ** -rng.randrange(9), 0.25, 0.0, -0.5, 3.0]) for _ in range(300)]
    labels = [int(rng.random() < 0.2 + 0.3 * (s > 0.2)) for s in scores]
    df = frame(spark, labels, scores)
    got = M.ranking_metrics(df, "is_fraud", "score").first()
    assert (got["average_precision"], got["roc_auc"]) == pytest.approx(python_ranking(labels, scores))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="is_fraud", numBins=0)
    assert got["roc_auc"] == pytest.approx(evaluator.evaluate(df))


def test_one_class_and_equal_scores(spark):
    none = M.evaluate(frame(spark, [0, 0, 0], [0.1, 0.7, 0.3]), tie="row_id").first()
    assert none["average_precision"] == 0.0 and none["roc_auc"] is None and none["precision"] == 0.0 and none["f1_score"] == 0.0
    equal = M.evaluate(frame(spark, [1, 0, 0, 0], [0.5] * 4), tie="row_id").first()
    assert equal["average_precision"] == 0.25 and equal["roc_auc"] == 0.5 and equal["recall"] == 1.0
    curve = M.pr_curve(frame(spark, [0, 0], [0.1, 0.2]), "is_fraud", "score").collect()
    assert sorted((r["precision"], r["recall"]) for r in curve) == [(0.0, 1.0), (0.0, 1.0), (1.0, 0.0)]


def test_confusion(spark):
    row = M.confusion_metrics(frame(spark, [1, 1, 0, 0, 1], [0.9, 0.1, 0.8, 0.2, 0.6]), "is_fraud", "prediction").first()
    assert (row["precision"], row["recall"]) == pytest.approx((2 / 3, 2 / 3))
    assert (row["f1_score"], row["f2_score"], row["f05_score"]) == pytest.approx((2 / 3, 2 / 3, 2 / 3))


def test_groups_do_not_mix(spark):
    both = frame(spark, LABELS_1, SCORES_1, "a").unionByName(frame(spark, LABELS_2, SCORES_2, "b"))
    got = {r["model"]: r for r in M.evaluate(both, by=["model"], tie="row_id").collect()}
    for name, labels, scores in (("a", LABELS_1, SCORES_1), ("b", LABELS_2, SCORES_2)):
        assert (got[name]["average_precision"], got[name]["roc_auc"]) == pytest.approx(python_ranking(labels, scores))


def test_choice_and_challenge(spark):
    m = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.3), ("d", None)], "model string, ap double")
    assert M.select_best(m, "ap").first()["model"] == "a"
    assert M.select_best(m, "ap", higher=False).first()["model"] == "c"

    def ask(old, new, **options):
        frames = [spark.createDataFrame([(v,)] if v is not None else [], "ap double") for v in (old, new)]
        rows = M.challenge(*frames, "ap", **options).collect()
        return rows[0]["challenger_better"] if rows else None

    assert ask(0.5, 0.6, threshold=0.2) is False
    assert ask(0.5, 0.75, threshold=0.2) is True
    assert ask(0.5, 0.5) is False
    assert ask(0.5, 0.2, threshold=0.1, higher=False) is True
    assert ask(None, 0.9) is None


def test_infinite_and_missing_scores(spark):
    scores = [float("inf"), 0.5, float("-inf"), float("nan"), 0.1]
    got = M.ranking_metrics(frame(spark, [1, 0, 0, 1, 0], scores), "is_fraud", "score").first()
    # Infinity leads, a score that is no number ranks last.
    assert got["average_precision"] == pytest.approx(0.7) and got["roc_auc"] == pytest.approx(0.5)


def test_a_null_group_keeps_its_metrics(spark):
    from pyspark.sql import functions as F

    both = frame(spark, [1, 0, 1], [0.9, 0.8, 0.1]).unionByName(frame(spark, [1, 0, 1], [0.9, 0.8, 0.1]).withColumn("model", F.lit(None).cast("string")))
    rows = {r["model"]: r.asDict() for r in M.evaluate(both, by=["model"], k=2, tie="row_id").collect()}
    assert {k: v for k, v in rows[None].items() if k != "model"} == {k: v for k, v in rows["a"].items() if k != "model"}
    assert rows[None]["precision_top_2"] == 0.5


@pytest.mark.parametrize("k", [1, 7, 40, 1500])
def test_precision_at_any_k_with_ties(spark, k):
    draw = random.Random(k)
    labels, scores = [draw.randint(0, 1) for _ in range(1200)], [draw.randint(0, 5) / 5 for _ in range(1200)]
    ranked = sorted(range(1200), key=lambda i: (-scores[i], i))[:k]
    got = M.precision_at_k(frame(spark, labels, scores), "is_fraud", "score", k, tie="row_id").first()[0]
    assert got == pytest.approx(sum(labels[i] for i in ranked) / k)


def test_listed_order_settles_ties(spark):
    rows = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.1)], "model string, m double")
    assert M.select_best(rows, "m", names=["c", "b", "a"]).first()["model"] == "b"
    assert M.select_best(rows, "m").first()["model"] == "a"


def test_evaluate_counts_scores_once(spark, monkeypatch):
    """Rows without a label rank but are no positives; both rankings read one table of counts."""
    rows = [(1, None, 0.9, 1), (2, 1, 0.8, 1), (3, 0, 0.7, 1), (4, 1, 0.7, 0), (5, None, 0.6, 0), (6, 0, None, 0)]
    df = spark.createDataFrame(rows, "row_id int, is_fraud int, score double, prediction int")
    want = (M.ranking_metrics(df, "is_fraud", "score").first(), M.precision_at_k(df, "is_fraud", "score", 3, tie="row_id").first())
    monkeypatch.setattr(M, "threshold_counts", None)
    got = M.evaluate(df, k=3, tie="row_id").first()
    assert (got["average_precision"], got["roc_auc"], got["precision_top_3"]) == (*want[0], *want[1])
