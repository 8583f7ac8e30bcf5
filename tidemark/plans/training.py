"""Scaling, classifiers, candidate training, scoring and model choice on MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import challenge, evaluate, pr_curve, ranking_metrics, select_best
from ..operators.resample import resample
from ..schema import ROW_ID, TARGET
from ..session import stage
from ..sources.files import read_table, save_as
from .huber import fit_modified_huber
from .logistic import fit_logistic

TASK_BYTES = 128 << 20  # of input vectors that one training task keeps
SCALINGS = ("standard", "min_max", "none")
MODELS = ("logistic_regression", "sgd_classifier", "random_forest", "xgboost", "lightgbm")

# Model parameters used when the caller gives none.
DEFAULT_PARAMS = {
    "logistic_regression": {"max_iter": 500, "C": 1.0, "tol": 1e-4},
    "sgd_classifier": {"alpha": 0.0001, "max_iter": 1000, "tol": 1e-3},
    "random_forest": {"n_estimators": 100, "max_samples": 0.3, "max_depth": 6},
    "xgboost": {"n_estimators": 100, "learning_rate": 0.3, "max_depth": 6, "scale_pos_weight": 10},
    "lightgbm": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 5},
}


@dataclass(frozen=True)
class Recipe:
    """How to prepare the training rows."""

    scaling: str = "standard"
    sampling: str = "none"
    share: float = 0.01
    shrinkage: float = 1.0
    copies: int = 2
    seed: int = 42
    use_validation: bool = True
    params: Mapping[str, Mapping] = field(default_factory=dict)


def class_weight(name: str, label: str, positives: int, rows: int, params: Mapping) -> Column:
    """Row weights that stand in for each library's imbalance option."""
    negatives = rows - positives
    if name == "random_forest":
        high, low = rows / (2.0 * max(positives, 1)), rows / (2.0 * max(negatives, 1))
    elif name == "xgboost":
        high, low = float(params["scale_pos_weight"]), 1.0
    elif name == "lightgbm":
        high, low = negatives / float(max(positives, 1)), 1.0
    else:
        high, low = 1.0, 1.0
    return F.when(F.col(label) == 1, high).otherwise(low)


def make_estimator(name: str, label: str = TARGET, params: Mapping | None = None, rows: int = 1, validation: str | None = None):
    """MLlib estimator for a model name.

    Both boosters map to gradient-boosted trees.  ``sgd_classifier`` is no MLlib
    estimator: ``train`` fits it with ``fit_modified_huber``.
    """
    if name not in MODELS or name == "sgd_classifier":
        raise ValueError(f"model must be an MLlib one of {MODELS}, not {name!r}")
    p = {**DEFAULT_PARAMS[name], **(params or {})}
    common = {"featuresCol": "features", "labelCol": label}
    if name == "logistic_regression":
        # An L2 penalty of C = 1 on a summed loss is 1 / rows on a mean loss.
        return LogisticRegression(
            maxIter=p["max_iter"], tol=p["tol"], regParam=1.0 / (p["C"] * max(rows, 1)), standardization=False, **common
        )
    if name == "random_forest":
        return RandomForestClassifier(
            numTrees=p["n_estimators"], maxDepth=p["max_depth"], subsamplingRate=p["max_samples"], bootstrap=True,
            featureSubsetStrategy="sqrt", weightCol="weight", seed=42, **common,
        )
    gbt = GBTClassifier(
        maxIter=p["n_estimators"], stepSize=p["learning_rate"], maxDepth=p["max_depth"], lossType="logistic",
        weightCol="weight", seed=42, **common,
    )
    return gbt.setValidationIndicatorCol(validation) if validation else gbt


def make_scaler(scaling: str, input_col: str = "assembled", output_col: str = "features"):
    if scaling == "standard":
        return StandardScaler(withMean=True, withStd=True, inputCol=input_col, outputCol=output_col)
    if scaling == "min_max":
        return MinMaxScaler(inputCol=input_col, outputCol=output_col)
    if scaling == "none":
        return None
    raise ValueError(f"scaling must be one of {SCALINGS}, not {scaling!r}")


def make_assembler(features: Sequence[str], scaling: str) -> VectorAssembler:
    output = "features" if scaling == "none" else "assembled"
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="error")


def assembled(df: DataFrame, features: Sequence[str], label: str, row_id: str, scaling: str, stored: bool = True) -> DataFrame:
    """Id, label and input vector of every row; ``stored`` ones are written once: later passes read one vector, not every column."""
    made = make_assembler(features, scaling)
    typed = df.select(f"`{row_id}`", f"`{label}`", *[F.col(f"`{f}`").cast("double").alias(f) for f in features])
    vectors = made.transform(typed).select(f"`{row_id}`", f"`{label}`", made.getOutputCol())
    return stage(vectors, "vectors") if stored else vectors


def balanced(rows: DataFrame, count: int, width: int) -> DataFrame:
    """Rows dealt evenly: a task keeps its rows over all iterations, and a file's size says little about them."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-count * width * 8 // TASK_BYTES))
    return rows.repartition(tasks)


def train(
    name: str,
    training: DataFrame,
    features: Sequence[str],
    valid: DataFrame | None = None,
    label: str = TARGET,
    row_id: str = ROW_ID,
    recipe: Recipe = Recipe(),
) -> tuple[PipelineModel, DataFrame]:
    """Fit one model; returns it with the resampled rows it saw.

    The scaler is fitted on the original training rows, the classifier on the
    rebalanced ones; boosters stop by the validation rows when there are any.
    """
    return _train(name, training, features, valid, label, row_id, recipe)[:2]


def _train(
    name: str,
    training: DataFrame,
    features: Sequence[str],
    valid: DataFrame | None,
    label: str,
    row_id: str,
    recipe: Recipe,
    vectors: Mapping[str, DataFrame] | None = None,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Model, rows seen, and their vectors; ``vectors`` may hold the assembled training and validation rows."""
    if name not in MODELS:
        raise ValueError(f"model must be one of {MODELS}, not {name!r}")
    scaler = make_scaler(recipe.scaling)
    doubles = [f"CAST(`{f}` AS DOUBLE) AS `{f}`" for f in features]
    steer = recipe.use_validation and valid is not None and name in ("xgboost", "lightgbm")

    def vectors_of(split: str, df: DataFrame) -> DataFrame:
        return vectors[split] if vectors else assembled(df, features, label, row_id, recipe.scaling)

    assembler = make_assembler(features, recipe.scaling)
    output = assembler.getOutputCol()
    stages = [assembler]
    typed = training.selectExpr(f"`{row_id}`", *doubles, f"CAST(`{label}` AS INT) AS `{label}`")
    seen = resample(typed, features, label, row_id, recipe.sampling, recipe.share, recipe.shrinkage, recipe.seed, recipe.copies)
    plain = vectors_of("training", training) if scaler or recipe.sampling == "none" else None
    if recipe.sampling == "none":
        ready = plain
    else:
        seen = stage(seen, "resampled")
        # Not a second copy: drawn rows are noise in every column, which no writer makes smaller.
        ready = assembled(seen, features, label, row_id, recipe.scaling, stored=False)
    if scaler:
        stages.append(scaler.fit(plain.select(output)))
    own = ready.select(output, F.col(label).cast("int").alias(label))
    counts = own.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("p"), F.count_if(F.col(label).isin(0, 1)).alias("k")).first()
    params = {**DEFAULT_PARAMS.get(name, {}), **recipe.params.get(name, {})}
    rows, count = own.withColumn("_valid", F.lit(False)), counts["n"]
    if steer:
        steering = vectors_of("validation", valid).select(output, F.col(label).cast("int").alias(label))
        rows, count = rows.unionByName(steering.withColumn("_valid", F.lit(True))), count + steering.count()
    scaled = PipelineModel(stages[1:])
    if name == "logistic_regression" and counts["k"] == counts["n"] > counts["p"] > 0:  # both classes, nothing else
        fitted = fit_logistic(make_estimator(name, label, params, counts["n"]), scaled.transform(rows), label, counts["n"], counts["p"])
        if fitted is not None:
            return PipelineModel([*stages, fitted]), seen, ready
    if name != "sgd_classifier":  # which keeps no rows
        rows = balanced(rows, count, len(features))
    rows = scaled.transform(rows).withColumn("weight", class_weight(name, label, counts["p"] or 0, counts["n"], params))
    if name == "sgd_classifier":
        found = fit_modified_huber(rows, label, params["alpha"], params["max_iter"], params["tol"])
        return PipelineModel([*stages, *found.stages]), seen, ready
    estimator = make_estimator(name, label, params, counts["n"], "_valid" if steer else None)
    fitted = estimator.fit(rows.select("features", label, "weight", "_valid"))
    return PipelineModel([*stages, fitted]), seen, ready


def _positive_probability(df: DataFrame) -> Column:
    if "probability" in df.columns:
        return vector_to_array(F.col("probability"))[1]
    return F.col("positive_probability")  # of the modified Huber model


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Class and fraud probability of every row, batch or streaming."""
    keep = list(df.columns if keep is None else keep)
    out = model.transform(df)
    return out.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col("prediction").cast("int").alias("prediction"),
        _positive_probability(out).alias("fraud_probability"),
    )


def score_splits(models: Mapping[str, PipelineModel], splits: Mapping[str, DataFrame], label: str = TARGET, row_id: str = ROW_ID) -> DataFrame:
    """Long table (model, split, id, label, prediction, probability) for shared metrics."""
    parts = [
        score(m, df, [row_id, label]).select(F.lit(name).alias("model"), F.lit(split).alias("split"), "*")
        for name, m in models.items()
        for split, df in splits.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def train_candidates(
    names: Sequence[str],
    training: DataFrame,
    valid: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str = TARGET,
    row_id: str = ROW_ID,
    recipe: Recipe = Recipe(),
    folder: str | None = None,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit every candidate and return the models with their scored splits.

    Each model is also scored on the rows it was fitted on (``training_resampled``).
    """
    models, scored, failed = train_side_by_side(names, training, valid, test, features, label, row_id, recipe, folder, 1)
    for error in failed.values():
        raise error
    return models, scored


def train_side_by_side(
    names: Sequence[str],
    training: DataFrame,
    valid: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str = TARGET,
    row_id: str = ROW_ID,
    recipe: Recipe = Recipe(),
    folder: str | None = None,
    together: int = 3,
) -> tuple[dict[str, PipelineModel], DataFrame | None, dict[str, Exception]]:
    """Fit ``together`` candidates at a time, each in a scheduler pool of its own.

    A model that fails is reported in the last result and does not stop the
    others; their models and scored splits (None if no model is left) are kept.
    With ``spark.scheduler.mode`` FAIR the pools share the cluster evenly.
    """
    spark = training.sparkSession

    def prepare() -> dict[str, DataFrame]:
        """The vectors that all candidates share."""
        parts = {"training": training, "validation": valid, "testing": test}
        return {split: assembled(df, features, label, row_id, recipe.scaling) for split, df in parts.items()}

    def one(name: str) -> tuple[PipelineModel, DataFrame]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        vectors = shared.result()
        model, _, seen = _train(name, training, features, valid, label, row_id, recipe, vectors)
        splits = {"training_resampled": seen, **vectors}
        part = stage(score_splits({name: PipelineModel(model.stages[1:])}, splits, label, row_id), "scored")
        if folder:
            model.write().overwrite().save(f"{folder.rstrip('/')}/{name}")
        return model, part

    models, parts, failed = {}, [], {}
    with ThreadPoolExecutor(max(1, together)) as pool:
        # Each thread inherits this one's properties (job group, session settings).
        shared = pool.submit(inheritable_thread_target(spark)(prepare))  # first in the queue, so no candidate waits in vain
        running = {name: pool.submit(inheritable_thread_target(spark)(one), name) for name in dict.fromkeys(names)}
        for name, future in running.items():
            try:
                models[name], part = future.result()
                parts.append(part)
            except Exception as error:  # noqa: BLE001 - reported to the caller
                failed[name] = error
    return models, reduce(DataFrame.unionByName, parts) if parts else None, failed


def candidate_metrics(scored: DataFrame, label: str = TARGET, row_id: str = ROW_ID) -> DataFrame:
    """All metrics by (model, split)."""
    return evaluate(scored, label, "fraud_probability", "prediction", ["model", "split"], tie=row_id)


def evaluation_report(model: PipelineModel, test: DataFrame, folder: str, label: str = TARGET, row_id: str = ROW_ID) -> DataFrame:
    """Score a test set once, write ``predictions`` and ``metrics`` below the folder, return the metrics."""
    folder = folder.rstrip("/")
    save_as(score(model, test, [row_id, label]), f"{folder}/predictions")
    predictions = read_table(test.sparkSession, f"{folder}/predictions")
    save_as(evaluate(predictions, label, "fraud_probability", "prediction", tie=row_id), f"{folder}/metrics")
    return read_table(test.sparkSession, f"{folder}/metrics")


def candidate_curves(scored: DataFrame, label: str = TARGET) -> DataFrame:
    """Precision-recall points of the validation and test scores by (model, split)."""
    newer = scored.where(F.col("split").isin("validation", "testing"))
    return pr_curve(newer, label, "fraud_probability", ["model", "split"])


def best_candidate(
    scored: DataFrame, label: str = TARGET, metric: str = "average_precision", higher: bool = True,
    row_id: str = ROW_ID, names: Sequence[str] = (),
) -> DataFrame:
    """Winner on the test split; of equal candidates the first of ``names``."""
    test = scored.where("split = 'testing'")
    if metric in ("average_precision", "roc_auc"):
        metrics = ranking_metrics(test, label, "fraud_probability", ["model"])
    else:
        metrics = evaluate(test, label, "fraud_probability", "prediction", ["model"], tie=row_id)
    return select_best(metrics, metric, higher=higher, names=names)


def champion_check(champion: PipelineModel, challenger: PipelineModel, test: DataFrame, label: str = TARGET, row_id: str = ROW_ID, metric: str = "average_precision", threshold: float = 0.1, higher: bool = True) -> DataFrame:
    """Both models on the same test rows, compared with a margin."""
    scored = score_splits({"champion": champion, "challenger": challenger}, {"testing": test}, label, row_id)
    metrics = evaluate(scored, label, "fraud_probability", "prediction", ["model"], tie=row_id)
    return challenge(metrics.where("model = 'champion'"), metrics.where("model = 'challenger'"), metric, threshold, higher)
