"""Rebalancing, training, scoring, monitoring and streams on small data."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import attribution
from tidemark.operators import stats as D
from tidemark.operators.resample import duplicate_minority, resample, rose, rose_size
from tidemark.plans import huber, logistic
from tidemark.plans import training as T
from tidemark.session import stage_path
from tidemark.streaming import monitor, scoring

FEATURES = ["x1", "x2"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(19)
    data = []
    for i in range(600):
        y = int(i % 10 == 0)
        data.append((i, rng.gauss(2.0 * y, 1.0), rng.gauss(-y, 1.0), y))
    return spark.createDataFrame(data, "transaction_id long, x1 double, x2 double, is_fraud int").repartition(3).cache()


def test_rose_reaches_the_share_and_repeats(spark, rows):
    out = rose(rows, FEATURES, "is_fraud", "transaction_id", share=0.3, shrinkage=0.5)
    counts = {r["is_fraud"]: r["count"] for r in out.groupBy("is_fraud").count().collect()}
    assert counts == {0: 540, 1: int(540 * 0.3 / 0.7 - 60) + 60}
    new = out.where("transaction_id < 0")
    again = rose(rows.repartition(7), FEATURES, "is_fraud", "transaction_id", share=0.3, shrinkage=0.5).where("transaction_id < 0")
    assert sorted(map(str, new.collect())) == sorted(map(str, again.collect()))
    old = rows.where("is_fraud = 1").agg(F.avg("x1"), F.stddev("x1")).first()
    drawn = new.agg(F.avg("x1"), F.stddev("x1")).first()
    assert abs(old[0] - drawn[0]) < 0.5 and drawn[1] < 1.6 * old[1]


def test_rose_without_blur_only_repeats(spark, rows):
    out = rose(rows, FEATURES, "is_fraud", "transaction_id", share=0.3, shrinkage=0.0).where("transaction_id < 0")
    assert out.select("x1", "x2").subtract(rows.where("is_fraud = 1").select("x1", "x2")).count() == 0
    picked = out.select("x1").distinct().count()
    assert 45 <= picked <= 60  # 171 draws from 60 rows reach nearly all


def test_resample_options(spark, rows):
    assert duplicate_minority(rows, "is_fraud", 2).count() == 600 + 2 * 60
    assert duplicate_minority(rows, "is_fraud", 0).count() == 600
    assert resample(rows, FEATURES, "is_fraud", "transaction_id") is rows
    with pytest.raises(ValueError):
        resample(rows, FEATURES, "is_fraud", "transaction_id", "smote")
    with pytest.raises(ValueError):
        rose_size(100, 50, 0.01)


@pytest.mark.parametrize(
    "name,recipe",
    [
        ("logistic_regression", T.Recipe(sampling="rose", share=0.3, shrinkage=0.5)),
        ("sgd_classifier", T.Recipe(scaling="min_max", sampling="upsampling_with_duplicates", params={"sgd_classifier": {"max_iter": 20}})),
        ("random_forest", T.Recipe(scaling="none", params={"random_forest": {"n_estimators": 10}})),
        ("xgboost", T.Recipe(params={"xgboost": {"n_estimators": 3, "max_depth": 3}})),
        ("lightgbm", T.Recipe(scaling="none", params={"lightgbm": {"n_estimators": 3, "max_depth": 3}})),
    ],
)
def test_models_learn(spark, rows, name, recipe):
    train, valid = rows.where("transaction_id % 3 > 0"), rows.where("transaction_id % 3 = 0")
    model, _ = T.train(name, train, FEATURES, valid, recipe=recipe)
    scored = T.score(model, valid)
    assert scored.columns == [*rows.columns, "prediction", "fraud_probability"] and scored.count() == valid.count()
    low, high = scored.agg(F.min("fraud_probability"), F.max("fraud_probability")).first()
    assert 0 <= low <= high <= 1
    auc = T.ranking_metrics(scored, "is_fraud", "fraud_probability").first()["roc_auc"]
    assert auc > 0.8


def test_scaler_ignores_added_rows(spark, rows):
    model, seen = T.train("logistic_regression", rows, FEATURES, recipe=T.Recipe(sampling="upsampling_with_duplicates"))
    assert seen.count() == 720
    assert model.stages[1].mean[0] == pytest.approx(rows.agg(F.avg("x1")).first()[0])


def test_unknown_names_are_refused(spark, rows):
    with pytest.raises(ValueError):
        T.make_scaler("robust")
    with pytest.raises(ValueError):
        T.make_estimator("perceptron")


def test_candidates_selection_and_champion(spark, rows):
    train, valid, test = (rows.where(f"transaction_id % 3 = {i}") for i in range(3))
    folder = stage_path(spark, "models")
    recipe = T.Recipe(params={"sgd_classifier": {"max_iter": 10}})
    models, scored = T.train_candidates(
        ["logistic_regression", "sgd_classifier"], train, valid, test, FEATURES, recipe=recipe, folder=folder
    )
    metrics = T.candidate_metrics(scored).collect()
    assert {(r["model"], r["split"]) for r in metrics} == {
        (m, s) for m in models for s in ("training_resampled", "training", "validation", "testing")
    }
    assert T.best_candidate(scored).first()["model"] in models
    assert T.best_candidate(scored, metric="f1_score").count() == 1
    curves = T.candidate_curves(scored)
    assert {r["split"] for r in curves.select("split").distinct().collect()} == {"validation", "testing"}
    loaded = PipelineModel.load(f"{folder}/logistic_regression")
    verdict = T.champion_check(loaded, models["logistic_regression"], test).first()
    assert verdict["challenger_better"] is False and verdict["champion_metric"] == pytest.approx(verdict["challenger_metric"])


def test_distances(spark):
    a = spark.createDataFrame([("f", 0, 10), ("f", 1, 30)], "feature string, bin int, n long")
    b = spark.createDataFrame([("f", 1, 5), ("f", 2, 5)], "feature string, bin int, n long")
    p, q = [0.25, 0.75, 0.0], [0.0, 0.5, 0.5]
    m = [(x + y) / 2 for x, y in zip(p, q)]
    js = sum(x * math.log2(x / y) for x, y in zip(p + q, m + m) if x) / 2
    row = D.distances(a, b).first()
    assert row["js_divergence"] == pytest.approx(js) and row["l_infinity"] == pytest.approx(0.5)
    same = D.distances(a, a).first()
    assert same["js_divergence"] == 0 and same["l_infinity"] == 0


def test_stats_and_anomalies(spark, rows):
    stats = {r["feature"]: r for r in D.feature_stats(rows.drop("transaction_id")).collect()}
    assert stats["is_fraud"]["zeros"] == 540 and stats["is_fraud"]["type"] == "INT" and stats["x1"]["missing"] == 0
    expected = D.infer_schema(D.feature_stats(rows.drop("transaction_id")), "is_fraud")
    serving = rows.drop("transaction_id", "is_fraud")
    assert D.validate(serving, expected, "SERVING").count() == 0
    found = D.validate(serving, expected, "TRAINING").collect()
    assert [(r["feature"], r["anomaly"]) for r in found] == [("is_fraud", "COLUMN_MISSING")]
    text = serving.withColumn("x1", F.col("x1").cast("string"))
    assert ("x1", "TYPE_CHANGED") in {tuple(r) for r in D.validate(text, expected, "SERVING").collect()}


def test_attribution_skew(spark, rows):
    model, _ = T.train("logistic_regression", rows, FEATURES)
    shifted = rows.withColumn("x1", F.col("x1") + 10)
    same = attribution.attribution_skew(model, rows, rows, {"x1": 0.01}).first()
    moved = attribution.attribution_skew(model, rows, shifted, {"x1": 0.01}).first()
    assert same["distance"] == pytest.approx(0.0) and not same["alert"] and moved["alert"]


def test_stream_equals_batch_on_closed_windows(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    edges = D.bin_edges(events, ["value"])
    batch = monitor.window_histograms(events, "ts", ["value"], edges)
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    out = monitor.window_histograms(stream, "ts", ["value"], edges)
    path, mark = stage_path(spark, "h"), stage_path(spark, "c")
    monitor.write_histograms(out, path, mark).awaitTermination()
    got = spark.read.schema(out.schema).parquet(path)
    assert got.exceptAll(batch).count() == 0
    missing = batch.exceptAll(got).select("window_start").distinct().collect()
    newest = batch.agg(F.max("window_start")).first()[0]
    assert [r[0] for r in missing] == [newest]
    report = monitor.drift_report(got, {"value": 0.01})
    assert report.count() == got.select("window_start").distinct().count() - 1


def test_stream_scoring_equals_batch(spark, rows):
    model, _ = T.train("logistic_regression", rows, FEATURES)
    source, path, mark = (stage_path(spark, n) for n in ("in", "out", "c"))
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    out = scoring.score_stream(stream, model, ["transaction_id"])
    scoring.append_log(scoring.sampled(out, "transaction_id"), path, mark).awaitTermination()
    got = spark.read.schema(out.schema).parquet(path)
    want = T.score(model, rows, ["transaction_id"])
    assert got.exceptAll(want).count() == 0 and got.count() == 600


def test_log_sample_is_stable(spark, rows):
    a = scoring.sampled(rows, "transaction_id", 0.25)
    b = scoring.sampled(rows.repartition(5), "transaction_id", 0.25)
    assert 100 < a.count() < 200 and a.exceptAll(b).count() == 0
    assert scoring.sampled(rows, "transaction_id", 0).count() == 0
    with pytest.raises(ValueError):
        scoring.sampled(rows, "transaction_id", 2)


@pytest.mark.parametrize("alpha,noise,shift", [(1e-4, 2.0, -2.0), (1e-2, 0.0, 1.0)])
def test_modified_huber_solution_has_no_slope(spark, alpha, noise, shift):
    """Constant and repeated columns, outliers and separable classes; compared with the loss near the solution."""
    draw = np.random.default_rng(7)
    x = draw.normal(size=(400, 4))
    x = np.hstack([x, np.zeros((400, 1)), x[:, :1]])
    label = ((x[:, 0] - 2 * x[:, 1] + noise * draw.normal(size=400) + shift) > 0).astype(int)
    rows = spark.createDataFrame([(Vectors.dense(a), int(b)) for a, b in zip(x, label)], ["features", "label"])
    found = huber.fit_modified_huber(rows, "label", alpha)
    w, b, y = found.model.coefficients.toArray(), found.model.intercept, 2 * label - 1

    def loss(w, b):
        m = y * (x @ w + b)
        return np.where(m < -1, -4 * m, np.maximum(0, 1 - m) ** 2).mean() + alpha / 2 * w @ w

    assert abs(found.loss - loss(w, b)) < 1e-9
    table = huber.prepared(rows, "label")
    assert abs(huber.objective(table, w, b, alpha) - loss(w, b)) < 1e-9
    assert np.abs(huber.gradient(table, w, b, alpha)).max() < 1e-4
    for _ in range(200):
        assert loss(w + draw.normal(size=6) * 0.01, b + draw.normal() * 0.01) >= loss(w, b) - 1e-9


def test_shapley_values_of_trees_equal_the_definition(spark, rows):
    """All subsets of the features, a tree's unknown conditions weighed by its training rows."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 4))
    label = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5) | (x[:, 2] > 1)).astype(int)
    table = spark.createDataFrame([(i, *map(float, a), int(b)) for i, (a, b) in enumerate(zip(x, label))], "id long, a double, b double, c double, d double, is_fraud int")
    for name in ("xgboost", "random_forest"):
        model, _ = T.train(name, table, list("abcd"), row_id="id", recipe=T.Recipe(scaling="none", params={name: {"n_estimators": 4, "max_depth": 4}}))
        trees = attribution.trees_of(model.stages[-1], spark)

        def value(known, row):
            total = 0.0
            for tree in trees:
                for leaf, path in tree.paths:
                    for f, (low, high, share) in path.items():
                        leaf *= float(low < row[f] <= high) if f in known else share
                    total += leaf
            return total

        explained = attribution.explain(model, table.where("id < 8"), ["id"]).collect()
        assert len(explained) == 8
        for r in explained:
            row = x[r.id]
            assert abs(r.base - value(set(), row)) < 1e-9 and abs(r.margin - value(set(range(4)), row)) < 1e-9
            for f in range(4):
                others, want = [g for g in range(4) if g != f], 0.0
                for size in range(4):
                    for known in itertools.combinations(others, size):
                        weight = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                        want += weight * (value({*known, f}, row) - value(set(known), row))
                assert abs(r.contributions[f] - want) < 1e-9


def test_trees_that_are_too_deep_or_split_on_categories_are_refused():
    def node(left, right, rows, categories=-1, feature=0):
        return {"leftChild": left, "rightChild": right, "rawCount": rows, "prediction": 1.0, "split": {"featureIndex": feature, "leftCategoriesOrThreshold": [0.0], "numCategories": categories}}

    with pytest.raises(ValueError, match="categories"):
        attribution.Leaves({0: node(1, 2, 4, 3), 1: node(-1, -1, 2), 2: node(-1, -1, 2)}, lambda n: n["prediction"], 1.0)
    deep = {0: node(1, 2, 100)}
    for i in range(11):
        deep[2 * i] = node(2 * i + 2, 2 * i + 1, 50, feature=i)
        deep[2 * i + 1] = node(-1, -1, 10)
    deep[22] = node(-1, -1, 10)
    with pytest.raises(ValueError, match="more than"):
        attribution.Leaves(deep, lambda n: n["prediction"], 1.0)


def test_alerts_survive_a_failed_batch(spark):
    """A batch that fails after its writes runs again under the same id; nothing is written or compared twice."""
    draw, path, folder = random.Random(5), stage_path(spark, "arriving"), stage_path(spark, "alerts")
    rows = spark.createDataFrame([(h * 3600, draw.gauss(h // 12, 1.0)) for h in range(72) for _ in range(5)], "sec long, value double")
    rows = rows.select(F.timestamp_seconds("sec").alias("ts"), "value")
    for day in range(3):
        rows.where(F.floor(F.unix_seconds("ts") / 86400) == day).coalesce(1).write.mode("append").parquet(path)
    edges = D.bin_edges(rows, ["value"])
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    limits, seen = {"value": 0.1}, []
    write = monitor.alert_writer(folder, limits)

    def breaks_once(df, batch_id):
        seen.append(batch_id)
        write(df, batch_id)
        if seen == [0, 1]:
            raise RuntimeError("lost after the writes")

    closed = monitor.window_histograms(stream, "ts", ["value"], edges)
    with pytest.raises(Exception, match="lost after the writes"):
        monitor.watch(closed, folder, limits, writer=breaks_once).awaitTermination()
    monitor.watch(closed, folder, limits, writer=breaks_once).awaitTermination()
    assert seen[:3] == [0, 1, 1] and len(seen) >= 4
    monitor.watch(closed, folder, limits).awaitTermination()  # nothing new: no further alert
    got = sorted(map(tuple, monitor.read_alerts(spark, folder).select("window_start", "distance", "alert").collect()))
    last = F.lit(71 * 3600 - 3600)
    batch = monitor.window_histograms(rows, "ts", ["value"], edges).where(F.unix_seconds("window_start") + 21600 <= last)
    want = sorted(map(tuple, monitor.drift_report(batch, limits).select("window_start", "distance", "alert").collect()))
    assert len(got) == len(want) == 10 and [g[0] for g in got] == [w[0] for w in want] and [g[2] for g in got] == [w[2] for w in want]
    assert all(abs(g[1] - w[1]) < 1e-12 for g, w in zip(got, want)) and any(g[2] for g in got)


def test_training_rows_are_dealt_evenly_whatever_the_files(spark, monkeypatch):
    """One file and one partition must not become one task's cache."""
    lumps = spark.range(4000).coalesce(1).selectExpr("id", "id * 1.0D AS x")
    monkeypatch.setattr(T, "TASK_BYTES", 1600)
    sizes = [n for n in T.balanced(lumps, 4000, 2).rdd.glom().map(len).collect()]
    assert len(sizes) == 40 and max(sizes) <= 2 * 4000 / 40


def test_candidates_share_their_vectors(spark, rows, monkeypatch):
    """The splits are assembled once, not once a candidate."""
    names, made = ["logistic_regression", "random_forest"], []
    plain = T.assembled
    monkeypatch.setattr(T, "assembled", lambda *a: made.append(a[0]) or plain(*a))
    recipe = T.Recipe(params={"random_forest": {"n_estimators": 2}})
    models, scored = T.train_candidates(names, rows, rows, rows, FEATURES, recipe=recipe)
    assert len(made) == 3 and set(models) == set(names)
    whole = T.score_splits(models, {"testing": rows}).select("model", "transaction_id", F.col("fraud_probability").alias("p"))
    both = scored.where("split = 'testing'").join(whole, ["model", "transaction_id"])
    assert both.count() == 1200 and both.where("abs(fraud_probability - p) > 1e-12").count() == 0


def test_huber_margins_need_no_row_expressions(spark, monkeypatch):
    """Steps take margins from the fitted models, also after a shortened one."""
    rng = random.Random(5)
    data = [(Vectors.dense([rng.gauss(2 * y, 1.5), rng.gauss(0, 1)]), y) for y in (0, 1) for _ in range(300)]
    rows = spark.createDataFrame(data, ["features", "label"])
    monkeypatch.setattr(huber, "linear", None)
    monkeypatch.setattr(huber, "STEPS", (0.7, *huber.STEPS[1:]))
    found = huber.fit_modified_huber(rows, "label", 1e-4, 60)
    monkeypatch.undo()
    table = huber.prepared(rows, "label")
    assert found.steps > 2
    assert abs(huber.gradient(table, found.model.coefficients.toArray(), found.model.intercept, 1e-4)).max() < 1e-3


def test_a_large_micro_batch_has_several_files(spark, monkeypatch):
    from tidemark.catalog import monitoring

    monkeypatch.setattr(monitoring, "FILE_ROWS", 1000)
    at = spark.range(9000).select("id", F.timestamp_seconds("id").alias("at"))
    stream = monitoring.arriving(spark, at, "at")
    out, seen = stage_path(spark, "out"), []
    stream.writeStream.foreachBatch(lambda df, i: seen.append(df.agg(F.min("id"), F.max("id"), F.count("*")).first())).option("checkpointLocation", out).trigger(availableNow=True).start().awaitTermination()
    assert [tuple(r) for r in seen] == [(0, 2999, 3000), (3000, 5999, 3000), (6000, 8999, 3000)]
    assert monitoring.files_each([3000] * 3, 3) == 3 and monitoring.files_each([5, 9000, 9000], 3) == 1


def test_open_requests_are_kept_on_disk(spark, rows):
    """The join's state lies in one RocksDB a partition, the session's settings stay, and a log begun with another store goes on with it."""
    model, _ = T.train("logistic_regression", rows, FEATURES)
    timed = rows.withColumn("requested_at", F.timestamp_seconds(F.col("transaction_id") * 3600))
    settled = timed.where("transaction_id % 10 <> 0").select(
        "transaction_id", (F.col("requested_at") + F.expr("INTERVAL 7 DAYS")).alias("settled_at"), F.col("is_fraud").alias("label")
    )
    logs = []
    for begun in (False, True):
        requests, labels, path, mark = (stage_path(spark, n) for n in ("requests", "labels", "log", "progress"))
        timed.drop("is_fraud").write.parquet(requests)
        settled.write.parquet(labels)
        sides = (spark.readStream.schema(df.schema).parquet(p) for df, p in ((timed.drop("is_fraud"), requests), (settled, labels)))
        out = scoring.labelled_log(*sides, model, "transaction_id", "requested_at", "settled_at")
        if begun:
            out.writeStream.format("parquet").option("path", path).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
            settled.limit(0).write.mode("append").parquet(labels)
        before = {key: spark.conf.get(key, None) for key in scoring.STATE}
        query = scoring.append_log(out, path, mark)
        query.awaitTermination()
        assert {key: spark.conf.get(key, None) for key in scoring.STATE} == before
        stores = [s for p in query.recentProgress for s in p["stateOperators"]]
        if not begun:
            assert stores and all(s["numStateStoreInstances"] == 4 and "rocksdbSstFileSize" in s["customMetrics"] for s in stores)
        logs.append(sorted(tuple(r) for r in spark.read.schema(out.schema).parquet(path).select("transaction_id", "label", "fraud_probability").collect()))
    assert logs[0] == logs[1] and len(logs[0]) > 500


def test_logistic_regression_keeps_no_rows(spark, rows, monkeypatch):
    """Neither dealt anew nor cached, and resampled rows are written once; one class alone is left to MLlib."""
    dealt, written, stage = [], [], T.stage
    balanced = T.balanced
    monkeypatch.setattr(T, "balanced", lambda *a: dealt.append(a) or balanced(*a))
    monkeypatch.setattr(T, "stage", lambda df, name="stage": written.append(name) or stage(df, name))
    model, seen = T.train("logistic_regression", rows, FEATURES, recipe=T.Recipe(sampling="upsampling_with_duplicates"))
    assert not dealt and sorted(written) == ["resampled", "vectors"] and seen.count() == 720
    assert model.stages[-1].coefficients.size == len(FEATURES)
    model, _ = T.train("logistic_regression", rows.withColumn("is_fraud", F.lit(0)), FEATURES)
    assert dealt and T.score(model, rows).agg(F.max("fraud_probability")).first()[0] == 0


@pytest.mark.parametrize("noise,scale", [(1.5, [1, 1, 1, 0, 1]), (0.0, [1, 1, 1, 1, 1]), (1.5, [1e-4, 1, 1e5, 10, 1])])
def test_logistic_newton_meets_the_objective_of_mllib(spark, noise, scale):
    """Overlapping and separable classes, a constant and a repeated column, columns of very different size."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(600, 5))
    x[:, 4] = x[:, 0]
    y = (x[:, 0] - 2 * x[:, 1] + noise * draw.normal(size=600) > 1).astype(int)
    x = x * scale + [0, 5, 0, 0, 0]
    data = spark.createDataFrame([(Vectors.dense(a), int(b)) for a, b in zip(x, y)], ["features", "is_fraud"])
    estimator = T.make_estimator("logistic_regression", rows=600, params={"tol": 1e-10})
    found = logistic.fit_logistic(estimator, data, "is_fraud", 600, int(y.sum()))

    def objective(model):
        w = model.coefficients.toArray()
        f = x @ w + model.intercept
        return (np.logaddexp(0.0, f) - y * f).mean() + estimator.getRegParam() / 2 * w @ w

    assert objective(found) <= objective(estimator.fit(data)) * (1 + 1e-8)
