"""Scaling, rebalancing, training and scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.resample import duplicate_minority, rose
from ..plans import features as P
from ..plans import huber
from ..plans import training as M
from ..plans.split import temporal_split
from ..schema import EPOCH, FEATURES, ROW_ID, TARGET
from ..session import stage, stage_path
from ..sources.adapters import table
from .base import merged_sql, query, rnd, rounded, sql_rnd
from .history import inputs, merged

def feature_splits(spark, sf, source="events"):
    """The time split of the whole feature table."""
    return temporal_split(stage(P.build_features(*inputs(spark, sf, source)), "features"))


def split_sql(source="events"):
    return f"""{merged_sql(source)}, cut AS (SELECT quantile_disc(sec, 0.7) AS q FROM merged),
parts AS (SELECT transaction_id, is_fraud, CASE WHEN sec < q THEN 'training' WHEN abs(transaction_id % 100) < 50 THEN 'validation' ELSE 'testing' END AS split FROM merged, cut)"""


def report_sql(model, source="events"):
    """Sizes of the scored splits; the flags say what must hold of any trained model."""
    return f"""{split_sql(source)} SELECT '{model}' AS model, split, count(*) AS "rows", CAST(sum(is_fraud) AS BIGINT) AS positives,
  TRUE AS probabilities_hold, TRUE AS metrics_hold, TRUE AS learned FROM parts GROUP BY split"""


def report(scored):
    """Sizes of the splits, whether probabilities and metrics lie in their ranges, and whether training rows are ranked better than by chance."""
    p = F.col("fraud_probability")
    sizes = scored.where("split <> 'training_resampled'").groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(TARGET).cast("bigint").alias("positives"),
        F.coalesce(F.bool_and(p.between(0, 1)), F.lit(False)).alias("probabilities_hold"),
    )
    metrics = M.candidate_metrics(scored)
    names = [c for c in metrics.columns if c not in ("model", "split")]
    hold = F.lit(True)
    for c in names:
        hold = hold & F.coalesce(F.col(c).between(0, 1), F.lit(False))
    flags = metrics.select("model", "split", hold.alias("metrics_hold"), ((F.col("split") != "training") | (F.col("roc_auc") > 0.5)).alias("learned"))
    return sizes.join(flags, ["model", "split"])


def _scaled(spark, sf, scaling):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("key"))
    df = VectorAssembler(inputCols=["o_totalprice", "key"], outputCol="assembled").transform(df)
    out = M.make_scaler(scaling).fit(df).transform(df)
    values = vector_to_array("features")
    return out.select("o_orderkey", rnd(values[0]).alias("price"), rnd(values[1]).alias("customer"))


def _scaling_sql(text):
    price, key = text.format(x="o_totalprice"), text.format(x="o_custkey")
    return f"SELECT o_orderkey, {sql_rnd(price)} AS price, {sql_rnd(key)} AS customer FROM orders"


@query("standard_scaling", _scaling_sql("({x} - avg({x}) OVER ()) / stddev_samp({x}) OVER ()"))
def standard_scaling(spark, sf):
    return _scaled(spark, sf, "standard")


@query("min_max_scaling", _scaling_sql("CAST({x} - min({x}) OVER () AS DOUBLE) / (max({x}) OVER () - min({x}) OVER ())"))
def min_max_scaling(spark, sf):
    return _scaled(spark, sf, "min_max")


@query(
    "upsampling_with_duplicates",
    f"{merged_sql('orders')} SELECT transaction_id, is_fraud FROM merged UNION ALL SELECT transaction_id, is_fraud FROM merged CROSS JOIN generate_series(1, 2) WHERE is_fraud = 1",
)
def upsampling(spark, sf):
    return duplicate_minority(merged(spark, sf, "orders").select(ROW_ID, TARGET), TARGET, 2)


@query(
    "rose_counts",
    f"""{merged_sql('orders')}, c AS (SELECT sum(is_fraud)::BIGINT AS p, count(*) - sum(is_fraud)::BIGINT AS n FROM merged)
SELECT 0 AS is_fraud, n AS "rows" FROM c UNION ALL SELECT 1, p + CAST(trunc(n * (0.3::DOUBLE / (1 - 0.3::DOUBLE)) - p) AS BIGINT) FROM c""",
)
def rose_counts(spark, sf):
    df = stage(merged(spark, sf, "orders").select(ROW_ID, "amount", "hour_sin", TARGET), "plain")
    out = rose(df, ["amount", "hour_sin"], TARGET, ROW_ID, share=0.3, shrinkage=0.5)
    return out.groupBy(TARGET).agg(F.count(F.lit(1)).alias("rows"))


@query("rose_rows")
def rose_rows(spark, sf):
    df = stage(merged(spark, sf, "orders").select(ROW_ID, "amount", "day_of_week_sin", TARGET), "plain")
    return rose(df, ["amount", "day_of_week_sin"], TARGET, ROW_ID, share=0.3, shrinkage=0.5)


def _trained(spark, sf, name, **recipe):
    train, valid, test = feature_splits(spark, sf)
    made = M.Recipe(**recipe)
    _, scored = M.train_candidates([name], train, valid, test, FEATURES, recipe=made)
    return report(scored)


@query("train_logistic_regression", report_sql("logistic_regression"))
def train_logistic_regression(spark, sf):
    return _trained(spark, sf, "logistic_regression", sampling="rose", share=0.3, shrinkage=0.5)


@query("train_linear_svm", report_sql("sgd_classifier"))
def train_linear_svm(spark, sf):
    return _trained(spark, sf, "sgd_classifier", sampling="upsampling_with_duplicates", scaling="min_max")


@query("train_random_forest", report_sql("random_forest"))
def train_random_forest(spark, sf):
    return _trained(spark, sf, "random_forest", scaling="none")


@query("train_boosting_weighted", report_sql("xgboost"))
def train_boosting_weighted(spark, sf):
    return _trained(spark, sf, "xgboost")


@query("train_boosting_balanced", report_sql("lightgbm"))
def train_boosting_balanced(spark, sf):
    return _trained(spark, sf, "lightgbm")


@query(
    "modified_huber_model",
    f"""{split_sql()} SELECT count(*) AS "rows", CAST(sum(is_fraud) AS BIGINT) AS positives, TRUE AS gradient_vanishes, TRUE AS below_hinge_model, TRUE AS stored_scores_as_live
FROM parts WHERE split = 'training'""",
)
def modified_huber_model(spark, sf):
    """The fitted model is where its objective has no slope, no worse there than a hinge-loss model, and scores alike once stored."""
    train, _, test = feature_splits(spark, sf)
    alpha = M.DEFAULT_PARAMS["sgd_classifier"]["alpha"]
    model, seen = M.train("sgd_classifier", train, FEATURES)
    fitted = model.stages[-2]
    vectors = PipelineModel(model.stages[:-2]).transform(seen)
    rows = huber.prepared(vectors, TARGET)
    slope = huber.gradient(rows, fitted.coefficients.toArray(), fitted.intercept, alpha)
    hinge = LinearSVC(featuresCol="features", labelCol=TARGET, maxIter=100, regParam=alpha, standardization=False).fit(vectors.select("features", TARGET))
    losses = [huber.objective(rows, m.coefficients.toArray(), m.intercept, alpha) for m in (fitted, hinge)]
    path = stage_path(spark, "model")
    model.write().save(path)
    a, b = (M.score(m, test, [ROW_ID]).select(ROW_ID, F.col("fraud_probability").alias(n)) for m, n in ((model, "a"), (PipelineModel.load(path), "b")))
    same = a.join(b, ROW_ID).agg(F.coalesce(F.bool_and(F.col("a") == F.col("b")), F.lit(False)).alias("stored_scores_as_live"))
    sizes = seen.agg(F.count(F.lit(1)).alias("rows"), F.sum(TARGET).cast("bigint").alias("positives"))
    flags = {"gradient_vanishes": bool(abs(slope).max() < 1e-4), "below_hinge_model": losses[0] <= losses[1]}
    return sizes.withColumns({k: F.lit(v) for k, v in flags.items()}).join(same)


FEWER = {name: {"n_estimators": 10} for name in ("random_forest", "xgboost", "lightgbm")}  # trees of the compared candidates
CANDIDATES = ", ".join(f"('{name}')" for name in M.MODELS)


def _candidates(spark, sf):
    train, valid, test = feature_splits(spark, sf)
    return M.train_side_by_side([*M.MODELS, "no_such_model"], train, valid, test, FEATURES, recipe=M.Recipe(params=FEWER))


@query(
    "candidate_selection",
    f"SELECT model, CAST(4 AS BIGINT) AS splits, TRUE AS metrics_hold, TRUE AS winner_is_best, 'no_such_model' AS failed FROM (VALUES {CANDIDATES}) AS m(model)",
)
def candidate_selection(spark, sf):
    """All five candidates at once beside one that fails; none beats the chosen one on the test rows."""
    models, scored, failed = _candidates(spark, sf)
    metrics = stage(M.candidate_metrics(scored), "metrics")
    test = metrics.where("split = 'testing'")
    best = M.select_best(test, "average_precision", names=list(models)).select(F.col("average_precision").alias("best"))
    hold = F.bool_and(F.coalesce(F.col("average_precision").between(0, 1) & F.col("roc_auc").between(0, 1), F.lit(False)))
    sizes = metrics.groupBy("model").agg(F.count(F.lit(1)).alias("splits"), hold.alias("metrics_hold"))
    top = F.coalesce(F.col("best") >= F.col("average_precision"), F.lit(False)).alias("winner_is_best")
    flags = test.join(best).select("model", top)  # one row on the right
    return sizes.join(flags, "model").withColumn("failed", F.lit(",".join(sorted(failed))))


@query(
    "candidate_curves",
    f"""SELECT model, split, TRUE AS starts_full, TRUE AS ends_empty, TRUE AS falls, TRUE AS area_is_average_precision
FROM (VALUES {CANDIDATES}) AS m(model) CROSS JOIN (VALUES ('validation'), ('testing')) AS s(split)""",
)
def candidate_curves(spark, sf):
    """Curves of all five candidates: from recall 1 to the end point, recall never rises, and the step sum is the average precision."""
    _, scored, _ = _candidates(spark, sf)
    points = stage(M.candidate_curves(scored), "curves")
    metrics = M.candidate_metrics(scored).select("model", "split", "average_precision")
    by = Window.partitionBy("model", "split").orderBy(F.col("threshold").asc_nulls_last())
    after = F.lead("recall").over(by)
    steps = points.withColumns({"fall": F.col("recall") - after, "area": (F.col("recall") - after) * F.col("precision")})
    sums = steps.groupBy("model", "split").agg(
        (F.max("recall") == 1).alias("starts_full"),
        F.bool_or(F.col("threshold").isNull() & (F.col("recall") == 0) & (F.col("precision") == 1)).alias("ends_empty"),
        F.coalesce(F.bool_and(F.col("fall") >= 0), F.lit(False)).alias("falls"), F.sum("area").alias("area"),
    )
    same = F.coalesce(F.abs(F.col("area") - F.col("average_precision")) < 1e-9, F.lit(False)).alias("area_is_average_precision")
    return sums.join(metrics, ["model", "split"]).select("model", "split", "starts_full", "ends_empty", "falls", same)


@query("train_on_features", report_sql("logistic_regression", "orders"))
def train_on_features(spark, sf):
    """Feature table, time split, rebalanced training, metrics: the whole way."""
    table_ = stage(P.build_features(*inputs(spark, sf, "orders")), "features")
    train, valid, test = temporal_split(table_)
    recipe = M.Recipe(sampling="rose", share=0.3, shrinkage=0.5)
    _, scored = M.train_candidates(["logistic_regression"], train, valid, test, FEATURES, recipe=recipe)
    return report(scored)


@query("saved_model_champion", "SELECT TRUE AS stored_scores_as_live, TRUE AS compared")
def saved_model_champion(spark, sf):
    """A model written, read back, compared with itself and defended against a challenger."""
    train, _, test = feature_splits(spark, sf)
    path = stage_path(spark, "model")
    live, _ = M.train("logistic_regression", train, FEATURES)
    live.write().save(path)
    champion = PipelineModel.load(path)
    challenger, _ = M.train("sgd_classifier", train, FEATURES)
    check = M.champion_check(champion, challenger, test)
    a, b = (M.score(m, test, [ROW_ID]).withColumnRenamed("fraud_probability", n) for m, n in ((live, "a"), (champion, "b")))
    same = a.join(b.drop("prediction"), ROW_ID).agg(F.bool_and(F.abs(F.col("a") - F.col("b")) < 1e-12).alias("stored_scores_as_live"))
    row = check.first()
    compared = row is not None and row["champion_metric"] is not None and row["challenger_metric"] is not None
    return same.withColumn("compared", F.lit(compared))


@query(
    "batch_scoring",
    f"""{split_sql()} SELECT transaction_id, is_fraud, TRUE AS in_range, TRUE AS class_fits FROM parts WHERE split = 'testing'""",
)
def batch_scoring(spark, sf):
    train, _, test = feature_splits(spark, sf)
    model, _ = M.train("logistic_regression", train, FEATURES)
    p = F.col("fraud_probability")
    out = M.score(model, test, [ROW_ID, TARGET])
    return out.select(ROW_ID, TARGET, p.between(0, 1).alias("in_range"), ((p > 0.5) == (F.col("prediction") == 1)).alias("class_fits"))


@query("evaluation_report")
def evaluation_report(spark, sf):
    """Predictions and metrics of one model as written tables."""
    train, _, test = feature_splits(spark, sf)
    model, _ = M.train("logistic_regression", train, FEATURES)
    return M.evaluation_report(model, test, stage_path(spark, "report"))
