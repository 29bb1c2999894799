"""Exported models score like the fitted ones; ordered files, bounded scans."""

import datetime as dt
import random

import duckdb
import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tickermood.functions.columns import feature_columns
from tickermood.operators import market
from tickermood.plans import inference, scoring, training
from tickermood.schemas import TARGET
from tickermood.sources import tables

INPUTS = feature_columns(True)


@pytest.fixture(scope="module")
def train(spark):
    draw = random.Random(8)
    data = []
    for i in range(240):
        a, b, c, d = (draw.gauss(0, s) for s in (1, 0.5, 2, 30))
        data.append(("AB"[i % 2], dt.date(2024, 1, 1) + dt.timedelta(days=i // 2), a, b, c, d, a * b + 0.3 * c + draw.gauss(0, 0.5)))
    schema = "symbol string, date date, " + ", ".join(f"{c} double" for c in [*INPUTS, TARGET])
    return training.labelled(spark.createDataFrame(data, schema), "gt0").cache()


WALK = """
    with recursive walk(symbol, date, tree, node) as (
        select symbol, date, tree, 0 from rows, (select distinct tree from nodes)
        union all
        select w.symbol, w.date, tree, case when [i0, i1, i2, i3][feature + 1] <= threshold then left_node else right_node end
        from walk w join nodes using (tree, node) join rows r on r.symbol = w.symbol and r.date = w.date where feature >= 0)
    select symbol, date, sum(weight * down) as down, sum(weight * up) as up
    from walk join nodes using (tree, node) where feature < 0 group by 1, 2 order by 1, 2
"""


@pytest.mark.parametrize("fit, params", [
    (training.fit_forest, {}), (training.fit_forest, {"numTrees": 66, "maxDepth": 5}), (training.fit_gbt, {"maxIter": 12}),
    (training.fit_forest, {"numTrees": 1, "maxDepth": 0}),
])
def test_exported_trees_vote_like_the_model(spark, train, fit, params):
    """Three ways: the fitted model, the expression, and SQL that walks the nodes."""
    model = fit(train, True, **params)
    nodes = scoring.tree_nodes(model)
    assert nodes.columns[:3] == ["tree", "weight", "node"]
    expected = model.transform(train)
    # The model's features hold the volume change after its scaler.
    inputs = ["i0", "i1", "i2", "i3"]
    features = expected.select("symbol", "date", "prediction", vector_to_array("features").alias("x"), vector_to_array("rawPrediction").alias("raw"))
    features = features.select("symbol", "date", "prediction", "raw", *[F.col("x")[k].alias(c) for k, c in enumerate(inputs)])
    scored = rows(features.withColumn("votes", scoring.tree_votes(nodes, inputs)), "symbol", "date")
    con = duckdb.connect()
    con.register("nodes", nodes.toPandas())
    con.register("rows", features.drop("raw").toPandas())
    walked = con.execute(WALK).fetchall()
    assert len(scored) == len(walked) == 240
    for r, (symbol, _, down, up) in zip(scored, walked):
        assert r["votes"] == {"down": pytest.approx(r["raw"][0], abs=1e-9), "up": pytest.approx(r["raw"][1], abs=1e-9)}
        assert (symbol, down, up) == (r["symbol"], pytest.approx(r["raw"][0], abs=1e-9), pytest.approx(r["raw"][1], abs=1e-9))
        assert r["prediction"] == float(r["votes"]["up"] > r["votes"]["down"])


def test_nodes_with_gaps_are_refused(spark):
    from tickermood.sources.sample import trees

    with pytest.raises(ValueError, match="without gaps"):
        scoring.tree_votes(trees(spark).where("node <> 1"), INPUTS)


def test_an_exported_perceptron_has_the_models_probabilities(spark, train):
    rows_ = train.withColumn("seq", F.array(F.array(*INPUTS))).withColumn("x", F.array(*[F.col(c) / 10 for c in INPUTS]))
    samples = training.sequence_vectors(rows_.withColumn("seq", F.array("x")))
    model = training.fit_sequence_classifier(samples, 4, hidden=(5, 3), maxIter=15)
    weights = scoring.perceptron_weights(model)
    assert weights.count() == 4 * 5 + 5 + 5 * 3 + 3 + 3 * 2 + 2
    found = model.transform(samples).select(
        vector_to_array("probability").alias("expected"), scoring.perceptron_probabilities(weights, "x").alias("found"), "prediction"
    )
    for r in rows(found):
        assert r["found"] == pytest.approx(r["expected"], abs=1e-9) and sum(r["found"]) == pytest.approx(1)
        assert r["prediction"] == float(r["found"][1] > r["found"][0])


@pytest.mark.parametrize("fit", [training.fit_svm, training.fit_logistic])
def test_exported_coefficients_score_and_call_like_the_model(spark, train, fit):
    model = fit(train, True)
    table = scoring.linear_rows(model, True)
    assert [r["input"] for r in table.collect()] == ["", *INPUTS]
    score = scoring.linear_score(table)
    found = model.transform(train).select("prediction", vector_to_array("rawPrediction")[1].alias("raw"), score.alias("score"))
    for r in rows(found):
        assert r["score"] == pytest.approx(r["raw"], abs=1e-9)
    calls = lambda model: rows(inference.predict_trend(train, model, True), "symbol")
    assert calls(scoring.called(score)) == calls(model)


def test_linear_regression_without_sentiment(spark, train):
    rows_ = training.labelled(train.drop("label"), None)
    model = training.fit_linear(rows_, False)
    found = model.transform(rows_).withColumn("score", scoring.linear_score(scoring.linear_rows(model, False)))
    assert all(r["score"] == pytest.approx(r["prediction"], abs=1e-9) for r in rows(found))


def bars(spark, days=400):
    data = [(s, dt.date(2023, 1, 1) + dt.timedelta(days=i), float(i % 13 + 1), i) for s in "AB" for i in range(0, days, 1 + (s == "B"))]
    return spark.createDataFrame(data, "symbol string, date date, adjclose double, volume long")


@pytest.mark.parametrize("cut", ["after", "before"])
def test_the_scored_days_bound_the_scan(spark, tmp_path, cut):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = str(tmp_path / "bars")
    tables.write_prices(bars(spark), path)
    scored = spark.createDataFrame([("A", dt.date(2023, 6, 10)), ("A", dt.date(2023, 6, 20)), ("B", dt.date(2023, 6, 13))], "symbol string, date date")
    found = market.restrict_to_span(tables.read_prices(spark, path), scored, cut=cut)
    plan = found._jdf.queryExecution().executedPlan().toString()
    low, high = ("2023-06-08", "2023-06-22") if cut == "after" else ("2023-06-10", "2023-06-20")
    assert f"GreaterThanOrEqual(date,{low})" in plan and f"LessThanOrEqual(date,{high})" in plan
    whole = market.price_features(bars(spark)) if cut == "after" else None
    spans = {"A": ("2023-06-10", "2023-06-20"), "B": ("2023-06-13", "2023-06-13")}
    got = rows(found, "symbol", "date")
    assert {(r["symbol"], str(r["date"])) for r in got} == {
        (r["symbol"], str(r["date"])) for r in rows(bars(spark)) if spans[r["symbol"]][0] <= str(r["date"]) <= spans[r["symbol"]][1]
    }
    if whole is not None:
        keys = {(r["symbol"], r["date"]) for r in got}
        assert got == [r for r in rows(whole, "symbol", "date") if (r["symbol"], r["date"]) in keys]


def test_a_span_of_nothing_and_a_span_of_all(spark):
    scored = spark.createDataFrame([("A", dt.date(2023, 1, 1)), ("A", dt.date(2030, 1, 1))], "symbol string, date date")
    everything = rows(market.restrict_to_span(bars(spark, 20), scored))
    assert len(everything) == 20 and everything[0]["symbol"] == "A"
    assert rows(market.restrict_to_span(bars(spark, 20), scored.limit(0))) == []
    assert rows(market.restrict_to_span(bars(spark, 20), scored.limit(0), cut="before")) == []


def test_ordered_files_tell_every_place(spark, tmp_path):
    path = str(tmp_path / "ordered")
    tables.write_ordered(bars(spark), path, files=5)
    bounds = rows(tables.file_bounds(spark, path), "offset")
    assert len(bounds) > 2 and sum(r["rows"] for r in bounds) == 600
    assert all((a["last"]["date"], a["last"]["symbol"]) <= (b["first"]["date"], b["first"]["symbol"]) for a, b in zip(bounds, bounds[1:]))
    found = rows(tables.read_ordered(spark, path), "position")
    expected = sorted(rows(bars(spark)), key=lambda r: (r["date"], r["symbol"]))
    assert [(r["date"], r["symbol"]) for r in found] == [(r["date"], r["symbol"]) for r in expected]
    assert [r["position"] for r in found] == list(range(600))


def test_files_out_of_order_are_refused(spark, tmp_path):
    path, other = str(tmp_path / "a"), str(tmp_path / "b")
    bars(spark).repartition(3).sortWithinPartitions("date", "symbol").write.parquet(path)
    with pytest.raises(Exception, match="overlaps"):
        tables.read_ordered(spark, path).collect()
    bars(spark).coalesce(1).sortWithinPartitions(F.desc("date")).write.parquet(other)
    with pytest.raises(Exception, match="out of order"):
        tables.read_ordered(spark, other).collect()
