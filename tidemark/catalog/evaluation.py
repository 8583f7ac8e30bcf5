"""Metrics over scored payments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..sources.adapters import scored_models
from .base import query, rnd, rounded, sql_rnd

SCORED = """
e AS (SELECT event_id AS row_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value FROM events),
s AS (
  SELECT row_id, CASE WHEN k < 5 THEN 1 ELSE 0 END AS y, 'hashed' AS model, row_id * 7919 % 1000 / 1000.0::DOUBLE AS score FROM e
  UNION ALL SELECT row_id, CASE WHEN k < 5 THEN 1 ELSE 0 END, 'leaky', 1.0::DOUBLE - floor(k / 10.0) / 10.0::DOUBLE FROM e
  UNION ALL SELECT row_id, CASE WHEN k < 5 THEN 1 ELSE 0 END, 'spend', least(value / 1000.0::DOUBLE, 1.0) FROM e),
scored AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p FROM s)"""
CURVE = """
per_score AS (SELECT model, score, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY 1, 2),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn
  FROM per_score WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
RANKING = """
ranking AS (SELECT model, sum(CAST(pos AS DOUBLE) * tp / (tp + fp)) / max(np) AS average_precision,
  sum(CAST(neg AS DOUBLE) * (2 * tp - pos)) / (2.0 * max(np) * max(nn)) AS roc_auc FROM curve GROUP BY model)"""
CONFUSION = """
c AS (SELECT model, CAST(sum(y * p) AS DOUBLE) AS tp, CAST(sum((1 - y) * p) AS DOUBLE) AS fp, CAST(sum(y * (1 - p)) AS DOUBLE) AS fn FROM scored GROUP BY model),
confusion AS (SELECT model, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fn + fp, 0), 0) AS f1_score, coalesce(5 * tp / nullif(5 * tp + 4 * fn + fp, 0), 0) AS f2_score,
  coalesce(1.25 * tp / nullif(1.25 * tp + 0.25 * fn + fp, 0), 0) AS f05_score FROM c)"""
TOP = """
topk AS (SELECT model, sum(y) / 200.0 AS precision_top_200 FROM
  (SELECT *, row_number() OVER (PARTITION BY model ORDER BY score DESC, row_id) AS r FROM scored) WHERE r <= 200 GROUP BY model)"""
METRICS = "precision recall f1_score f2_score f05_score average_precision roc_auc precision_top_200".split()
NUMBERS = ", ".join(f"{sql_rnd(m)} AS {m}" for m in METRICS)


@query("confusion_metrics", f"WITH {SCORED},{CONFUSION} SELECT model, {', '.join(f'{sql_rnd(m)} AS {m}' for m in METRICS[:5])} FROM confusion")
def confusion(spark, sf):
    return rounded(M.confusion_metrics(scored_models(spark, sf), "is_fraud", "prediction", ["model"]), ["model"])


@query("ranking_metrics", f"WITH {SCORED},{CURVE},{RANKING} SELECT model, {sql_rnd('average_precision')} AS average_precision, {sql_rnd('roc_auc')} AS roc_auc FROM ranking")
def ranking(spark, sf):
    return rounded(M.ranking_metrics(scored_models(spark, sf), "is_fraud", "score", ["model"]), ["model"])


@query("precision_at_k", f"WITH {SCORED},{TOP} SELECT model, {sql_rnd('precision_top_200')} AS precision_top_200 FROM topk")
def precision_at_k(spark, sf):
    return rounded(M.precision_at_k(scored_models(spark, sf), "is_fraud", "score", 200, ["model"], "row_id"), ["model"])


@query("precision_at_5000", f"WITH {SCORED},{TOP.replace('200', '5000')} SELECT model, {sql_rnd('precision_top_5000')} AS precision_top_5000 FROM topk")
def precision_at_5000(spark, sf):
    """The same plan as for a small k."""
    return rounded(M.precision_at_k(scored_models(spark, sf), "is_fraud", "score", 5000, ["model"], "row_id"), ["model"])


@query(
    "pr_curve",
    f"""WITH {SCORED},{CURVE} SELECT model, {sql_rnd('score')} AS threshold, {sql_rnd('CAST(tp AS DOUBLE) / (tp + fp)')} AS precision, {sql_rnd('CAST(tp AS DOUBLE) / np')} AS recall FROM curve
UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), CAST(1.0 AS DOUBLE), CAST(0.0 AS DOUBLE) FROM scored""",
)
def pr_curve(spark, sf):
    return rounded(M.pr_curve(scored_models(spark, sf), "is_fraud", "score", ["model"]), ["model"])


@query("threshold_counts", f"WITH {SCORED},{CURVE} SELECT model, {sql_rnd('score')} AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp FROM curve")
def threshold_counts(spark, sf):
    out = M.threshold_counts(scored_models(spark, sf), "is_fraud", "score", ["model"])
    return out.select("model", rnd(F.col("threshold")).alias("threshold"), "tp", "fp")


@query("evaluate_models", f"WITH {SCORED},{CURVE},{RANKING},{CONFUSION},{TOP} SELECT model, {NUMBERS} FROM confusion JOIN ranking USING (model) JOIN topk USING (model)")
def evaluate_models(spark, sf):
    return rounded(M.evaluate(scored_models(spark, sf), by=["model"], tie="row_id"), ["model"])


@query("select_best", f"WITH {SCORED},{CURVE},{RANKING} SELECT model, {sql_rnd('average_precision')} AS average_precision FROM ranking ORDER BY ranking.average_precision DESC, model LIMIT 1")
def select_best(spark, sf):
    metrics = M.ranking_metrics(scored_models(spark, sf), "is_fraud", "score", ["model"])
    return rounded(M.select_best(metrics, "average_precision"), ["model"])


@query("select_worst", f"WITH {SCORED},{CURVE},{RANKING} SELECT model, {sql_rnd('roc_auc')} AS roc_auc FROM ranking ORDER BY ranking.roc_auc, model LIMIT 1")
def select_worst(spark, sf):
    """Arg-min: the direction flag turned round."""
    metrics = M.ranking_metrics(scored_models(spark, sf), "is_fraud", "score", ["model"])
    return rounded(M.select_best(metrics, "roc_auc", higher=False), ["model"])


@query(
    "champion_challenger",
    f"""WITH {SCORED},{CURVE},{RANKING}, m AS (SELECT max(average_precision) FILTER (model = 'hashed') AS a, max(average_precision) FILTER (model = 'leaky') AS b FROM ranking)
SELECT b > a + 0.1 AS challenger_better, {sql_rnd('a')} AS champion_metric, {sql_rnd('b')} AS challenger_metric FROM m""",
)
def champion_challenger(spark, sf):
    metrics = M.ranking_metrics(scored_models(spark, sf), "is_fraud", "score", ["model"])
    out = M.challenge(metrics.where("model = 'hashed'"), metrics.where("model = 'leaky'"), "average_precision", 0.1)
    return rounded(out, ["challenger_better"])
