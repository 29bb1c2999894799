import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickermood.functions.columns import direction
from tickermood.operators.splits import chrono_split
from tickermood.plans import inference, training
from tickermood.plans.catalog import QUERIES
from tickermood.schemas import TARGET


@pytest.fixture(scope="module")
def features(spark):
    """Sentiment gives tomorrow away; the market columns are noise."""
    draw = random.Random(3)
    data = []
    for symbol in ("A", "B"):
        target = [draw.gauss(0, 2) for _ in range(121)]
        for i in range(120):
            data.append((
                symbol, dt.date(2024, 1, 1) + dt.timedelta(days=i), target[i + 1] / 2, draw.uniform(-1, 1), target[i],
                draw.gauss(0, 30), target[i + 1],
            ))
    columns = ["afinn_sentiment", "pnn_sentiment", "price_percent_change", "volume_percent_change", TARGET]
    df = spark.createDataFrame(data, "symbol string, date date, " + ", ".join(f"{c} double" for c in columns))
    return df.cache()


def parts(features, rule):
    rows_ = training.labelled(chrono_split(features), rule)
    return rows_.filter("split = 'train'"), rows_.filter("split = 'test'")


@pytest.mark.parametrize("name,params", [
    ("SVM", {"maxIter": 30}), ("RandomForest", {}), ("GradientBoosting", {"maxIter": 3}), ("LogisticRegression", {}),
])
def test_classifiers_learn_from_sentiment(spark, features, name, params):
    fit, rule = training.MODELS[name]
    train, test = parts(features, rule)
    accuracy = {}
    for emotion in (False, True):
        predicted = training.predict(fit(train, emotion, **params), test)
        accuracy[emotion] = predicted.select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert accuracy[True] > 0.9 > accuracy[False]


def test_linear_model_and_train_only_scaler(spark, features):
    train, test = parts(features, None)
    model = training.fit_linear(train, True)
    predicted = training.predict(model, test)
    error = predicted.select(F.max(F.abs(F.col("label") - F.col("prediction")))).first()[0]
    assert error < 1e-6
    mean = train.agg(F.avg("volume_percent_change")).first()[0]
    assert model.stages[1].mean[0] == pytest.approx(mean)


def test_experiments(spark, features):
    result = training.run_experiments(
        features, ["A", "B"], ("LinearRegression", "SVM"), params={"SVM": {"maxIter": 20}}
    )
    found = {(r["model"], r["stock"], r["emotion"], r["metric"]): r["value"] for r in result.collect()}
    assert len(found) == 2 * 2 * 2 * 2
    assert found[("LinearRegression", "A", "True", "r2")] == pytest.approx(1.0)
    assert all(0 <= v <= 1 for (*_, metric), v in found.items() if metric in ("accuracy", "auc"))
    table = training.accuracy_table(result)
    assert table.columns == ["model", "stock", "emotion", "accuracy"] and table.count() == 4


def test_sequence_models(spark, features):
    samples = training.sequence_samples(features, emotion=True, length=5)
    assert rows(samples.groupBy("split").count(), "split") == [{"split": "test", "count": 14}, {"split": "train", "count": 206}]
    train = samples.filter("split = 'train'")
    regressor = training.fit_sequence_regressor(train.withColumn("label", F.col("target")))
    predicted = regressor.transform(samples.filter("split = 'test'"))
    assert predicted.select(F.max(F.abs(F.col("target") - F.col("prediction")))).first()[0] < 1e-3
    labelled = train.withColumn("label", direction("target", "ge0").cast("double"))
    classifier = training.fit_sequence_classifier(labelled, inputs=20, maxIter=20)
    assert len(training.training_history(classifier)) > 1
    assert set(r["prediction"] for r in classifier.transform(samples).collect()) <= {0.0, 1.0}


def test_trend(spark, features):
    train, _ = parts(features, "gt0")
    model = training.fit_logistic(train, True)
    trends = inference.predict_trend(features, model, emotion=True)
    found = rows(trends, "symbol")
    last = {r["symbol"]: r[TARGET] for r in rows(features.filter(F.col("date") == dt.date(2024, 4, 29)))}
    assert [r["trend"] for r in found] == ["bullish" if last[s] > 0 else "bearish" for s in ("A", "B")]
    assert found[0]["date"] == dt.date(2024, 4, 29) and found[0]["next_session"] == dt.date(2024, 4, 30)
    texts = rows(inference.trend_text(trends), "symbol")
    assert texts[0]["text"] == f"A, session of April 30: {found[0]['trend']} (model with news sentiment)"


@pytest.mark.parametrize("name", ["training_histories", "sequence_regressor", "predict_trend", "forest"])
def test_model_queries_run(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.01").count() > 0
