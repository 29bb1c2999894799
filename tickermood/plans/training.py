"""Fitted pipelines, experiments and training histories."""

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product
from math import isfinite

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from tickermood.functions.columns import feature_columns, label_direction
from tickermood.operators.evaluation import auc, classification_metrics, regression_metrics
from tickermood.operators.splits import chrono_split, make_sequences
from tickermood.schemas import TARGET
from tickermood.session import materialize

_VOLUME = "volume_percent_change"


def feature_stages(emotion: bool) -> list:
    """Z-score of the volume change, then one vector of all inputs.

    Being part of the pipeline, the scaler is fitted on train rows only and is
    saved with the model.
    """
    inputs = ["volume_z" if c == _VOLUME else c for c in feature_columns(emotion)]
    return [
        VectorAssembler(inputCols=[_VOLUME], outputCol="volume_vector", handleInvalid="error"),
        StandardScaler(inputCol="volume_vector", outputCol="volume_z", withMean=True, withStd=True),
        VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"),
    ]


def _fit(estimator, train: DataFrame, emotion: bool) -> PipelineModel:
    return _finite(Pipeline(stages=[*feature_stages(emotion), estimator]).fit(train))


def _finite(model: PipelineModel) -> PipelineModel:
    """Refuse a model whose solver ended in coefficients that are no numbers."""
    coefficients = getattr(model.stages[-1], "coefficients", None)
    if coefficients is not None and not all(isfinite(x) for x in coefficients.toArray()):
        raise RuntimeError(f"{type(model.stages[-1]).__name__} did not converge")
    return model


def fit_linear(train: DataFrame, emotion: bool, maxIter=1000, **params) -> PipelineModel:
    return _fit(LinearRegression(maxIter=maxIter, **params), train, emotion)


def fit_svm(train: DataFrame, emotion: bool, maxIter=200, **params) -> PipelineModel:
    return _fit(LinearSVC(maxIter=maxIter, **params), train, emotion)


def fit_forest(train: DataFrame, emotion: bool, seed=42, **params) -> PipelineModel:
    return _fit(RandomForestClassifier(seed=seed, **params), train, emotion)


def fit_gbt(train: DataFrame, emotion: bool, maxIter=100, seed=42, **params) -> PipelineModel:
    return _fit(GBTClassifier(maxIter=maxIter, seed=seed, **params), train, emotion)


def fit_logistic(train: DataFrame, emotion: bool, **params) -> PipelineModel:
    return _fit(LogisticRegression(**params), train, emotion)


def sequence_vectors(sequences: DataFrame) -> DataFrame:
    """Lay the rows of each sequence end to end as one vector."""
    return sequences.withColumn("features", array_to_vector(F.flatten("seq")))


def fit_sequence_regressor(train: DataFrame, maxIter=100, **params) -> PipelineModel:
    """Linear model on flattened sequences; ``train`` has ``features`` and ``label``."""
    return Pipeline(stages=[LinearRegression(maxIter=maxIter, **params)]).fit(train)


def fit_sequence_classifier(train: DataFrame, inputs: int, hidden=(16,), maxIter=100, seed=42, **params) -> PipelineModel:
    """Perceptron on flattened sequences of ``inputs`` numbers."""
    layers = [inputs, *hidden, 2]
    return Pipeline(
        stages=[MultilayerPerceptronClassifier(layers=layers, maxIter=maxIter, seed=seed, **params)]
    ).fit(train)


def fit_with_history(
    train: DataFrame, valid: DataFrame, inputs: int, rounds=5, iterations=20, hidden=(16,), seed=42
) -> tuple[PipelineModel, list[float], list[float]]:
    """A perceptron trained in rounds: (model, loss of each iteration, validation loss after each round).

    Each round goes on from the weights of the last one; the validation loss is the mean
    log loss on rows that no round sees.
    """
    start, losses, valid_losses, model = {}, [], [], None
    for _ in range(rounds):
        model = fit_sequence_classifier(train, inputs, hidden, iterations, seed, **start)
        start = {"initialWeights": model.stages[-1].weights}
        losses += training_history(model)
        right = F.get(vector_to_array("probability"), F.col("label").cast("int"))
        scored = model.transform(valid).select(F.avg(-F.log(F.greatest(right, F.lit(1e-15)))).alias("loss"))
        valid_losses.append(scored.first()["loss"])
    return model, losses, valid_losses


def sequence_samples(features: DataFrame, emotion: bool, length=10, fractions=(0.9,)) -> DataFrame:
    """Flattened sequences within each split, predicting the day after the window.

    The target is the same-day change of the row after the window, which makes it
    a next-day target; windows do not cross splits.
    """
    parts = chrono_split(features, fractions)
    samples = make_sequences(
        parts, feature_columns(emotion), "price_percent_change", length, by=["symbol", "split"]
    )
    return sequence_vectors(samples)


def training_history(model: PipelineModel) -> list[float]:
    """Loss of each iteration of the last stage, as far as it keeps one."""
    last = model.stages[-1]
    if not getattr(last, "hasSummary", False) and not hasattr(last, "summary"):
        return []
    summary = last.summary() if callable(last.summary) else last.summary
    return [float(x) for x in summary.objectiveHistory]


# Model name -> (fit function, label rule or None for regression).
MODELS = {
    "LinearRegression": (fit_linear, None),
    "SVM": (fit_svm, "gt0"),
    "RandomForest": (fit_forest, "gt0"),
    "GradientBoosting": (fit_gbt, "gt0"),
    "LogisticRegression": (fit_logistic, "gt0"),
}


def labelled(features: DataFrame, rule) -> DataFrame:
    """Features with a double ``label``: the target, or its direction."""
    if rule is None:
        return features.withColumn("label", F.col(TARGET).cast("double"))
    rows = label_direction(features, TARGET, rule)
    return rows.withColumn("label", F.col("label").cast("double"))


def predict(model: PipelineModel, rows: DataFrame, keep=()) -> DataFrame:
    """(symbol, date, label, prediction, score), score ranking rows by upwardness."""
    scored = model.transform(rows)
    if "rawPrediction" in scored.columns:
        score = vector_to_array("rawPrediction")[1]
    else:
        score = F.col("prediction")
    return scored.select("symbol", "date", *keep, "label", "prediction", score.alias("score"))


def experiment_predictions(features: DataFrame, symbols, models=tuple(MODELS), emotions=(False, True),
                           train_size=0.8, params=None, at_once=8) -> DataFrame:
    """Test predictions of every model, symbol and choice of inputs, written once.

    The daily feature table is written first, so that fits do not read articles. The
    fits do not depend on each other; ``at_once`` of them are submitted together, so
    that small jobs fill the cluster.
    """
    table = materialize(chrono_split(features, (train_size,)))
    by_rule = {rule: labelled(table, rule) for _, rule in MODELS.values()}

    def predicted(cell) -> DataFrame:
        name, symbol, emotion = cell
        fit, rule = MODELS[name]
        own = by_rule[rule].filter(F.col("symbol") == symbol)
        model = fit(own.filter("split = 'train'"), emotion, **(params or {}).get(name, {}))
        return predict(model, own.filter("split = 'test'")).select(
            F.lit(name).alias("model"), F.lit(symbol).alias("stock"), F.lit(str(emotion)).alias("emotion"),
            "label", "prediction", "score",
        )

    grid = list(product(models, symbols, emotions))
    with ThreadPoolExecutor(at_once) as pool:
        return materialize(reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(features.sparkSession)(predicted), grid)))


def run_experiments(features: DataFrame, symbols, models=tuple(MODELS), **options) -> DataFrame:
    """(model, stock, emotion, metric, value) on the test rows, each metric by its name."""
    predictions = experiment_predictions(features, symbols, models, **options)
    keys = ["model", "stock", "emotion"]
    long = lambda df, name: df.select(*keys, F.lit(name).alias("metric"), F.col(name).cast("float").alias("value"))
    regression = F.col("model") == "LinearRegression"
    classes, values = predictions.filter(~regression), predictions.filter(regression)
    result = long(classification_metrics(classes, by=keys), "accuracy").unionByName(long(auc(classes, by=keys), "auc"))
    if "LinearRegression" in models:
        errors = regression_metrics(values, by=keys)
        result = result.unionByName(long(errors, "rmse")).unionByName(long(errors, "r2"))
    return result


def accuracy_table(results: DataFrame) -> DataFrame:
    """(model, stock, emotion, accuracy) rows of a result table."""
    return results.filter("metric = 'accuracy'").select(
        "model", "stock", "emotion", F.col("value").cast("float").alias("accuracy")
    )
