import datetime as dt
import math
import random

import pytest
from conftest import rows
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tickermood.operators import evaluation, neighbours, scaling, splits, stats


def series(spark, **symbols):
    data = [(s, dt.date(2024, 1, 1) + dt.timedelta(days=i), x) for s, xs in symbols.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(data, "symbol string, date date, x double")


def values(df, name="x"):
    return [r[name] for r in rows(df, "symbol", "date")]


WAYS = pytest.mark.parametrize("options", [{}, {"by": "symbol"}, {"by": "symbol", "per_day": True}])


@WAYS
def test_scale_like_ml(spark, options):
    df = series(spark, A=[1.0, 2.0, 4.0, None])
    clean = VectorAssembler(inputCols=["x"], outputCol="v").transform(df.dropna())
    for center in (False, True):
        scaler = StandardScaler(inputCol="v", outputCol="s", withMean=center, withStd=True)
        expected = scaler.fit(clean).transform(clean).withColumn("x", vector_to_array("s")[0])
        assert values(scaling.scale(df, "x", center, **options)) == pytest.approx([*values(expected), None])


@WAYS
def test_minmax_like_ml(spark, options):
    df = series(spark, A=[1.0, 2.0, 4.0])
    clean = VectorAssembler(inputCols=["x"], outputCol="v").transform(df)
    scaler = MinMaxScaler(inputCol="v", outputCol="s", min=-1, max=1)
    expected = scaler.fit(clean).transform(clean).withColumn("x", vector_to_array("s")[0])
    assert values(scaling.minmax(df, "x", **options)) == pytest.approx(values(expected))


def test_constant_columns(spark):
    df = series(spark, A=[3.0, 3.0], B=[5.0])
    for options in ({"by": "symbol"}, {"by": "symbol", "per_day": True}):
        assert values(scaling.scale(df, "x", False, **options)) == [0.0, 0.0, 0.0]
        assert values(scaling.scale(df, "x", True, **options)) == [0.0, 0.0, 0.0]
        assert values(scaling.minmax(df, "x", **options)) == [0.0, 0.0, 0.0]
    assert values(scaling.div_to_max(df, "x", by="symbol")) == [1.0, 1.0, 1.0]
    assert values(scaling.div_to_max(series(spark, A=[0.0, -1.0]), "x")) == [None, None]


def test_scaler_fitted_on_train_rows(spark):
    df = series(spark, A=[1.0, 3.0, 100.0]).withColumn("train", F.col("x") < 50)
    scaled = scaling.scale(df, "x", True, by="symbol", fit_on=F.col("train"), out="z")
    z = values(scaled, "z")
    assert z[0] == -z[1] and sum(z[:2]) == 0 and z[2] == pytest.approx(98 / math.sqrt(2))


@pytest.mark.parametrize("n", range(1, 13))
def test_chrono_split_sizes_and_order(spark, n):
    df = series(spark, A=[float(i) for i in range(n)], B=[1.0, 1.0])
    parts = rows(splits.chrono_split(df), "date")
    train = [r["date"] for r in parts if r["symbol"] == "A" and r["split"] == "train"]
    test = [r["date"] for r in parts if r["symbol"] == "A" and r["split"] == "test"]
    assert len(train) == int(n * 0.8) and len(train) + len(test) == n
    assert not train or max(train) < min(test)


def test_three_way_split(spark):
    parts = rows(splits.chrono_split(series(spark, A=[float(i) for i in range(100)]), (0.9, 0.9)), "date")
    assert [r["split"] for r in parts] == ["train"] * 81 + ["valid"] * 9 + ["test"] * 10


def test_except_split_loses_duplicates(spark):
    df = spark.createDataFrame(
        [("A", dt.date(2024, 1, min(d, 9)), 1.0) for d in range(1, 11)], "symbol string, date date, x double"
    )
    train, test = splits.except_split(df)
    assert train.count() == 8 and test.count() == 1
    assert rows(splits.chrono_split(df).filter("split = 'test'")).__len__() == 2


def test_sequences(spark):
    df = series(spark, A=[float(i) for i in range(5)], B=[1.0, 2.0]).withColumn("y", F.col("x") * 10)
    found = rows(splits.make_sequences(df, ["x", "y"], "x", length=3), "date")
    assert [(r["symbol"], r["seq"], r["target"]) for r in found] == [
        ("A", [[0.0, 0.0], [1.0, 10.0], [2.0, 20.0]], 3.0),
        ("A", [[1.0, 10.0], [2.0, 20.0], [3.0, 30.0]], 4.0),
    ]


def test_latest_row(spark):
    found = rows(splits.latest_row(series(spark, A=[1.0, 2.0], B=[3.0])), "symbol")
    assert [(r["symbol"], r["x"]) for r in found] == [("A", 2.0), ("B", 3.0)]


def test_class_balance_and_correlation(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 2.0, 4.0), (0, 3.0, 6.0)], "label int, a double, b double")
    assert [(r["label"], r["count"]) for r in stats.class_balance(df).collect()] == [(1, 2), (0, 1)]
    found = rows(stats.correlation_matrix(df, ["a", "b"]), "col_a", "col_b")
    assert [(r["col_a"], r["col_b"]) for r in found] == [("a", "a"), ("a", "b"), ("b", "a"), ("b", "b")]
    assert [r["corr"] for r in found] == pytest.approx([1.0] * 4)


def metrics_frame(spark, n=100):
    import random

    draw = random.Random(5)
    data = [("A", dt.date(2024, 1, 1) + dt.timedelta(days=i), float(draw.random() > 0.5), round(draw.gauss(0, 1), 1) + 0.0) for i in range(n)]
    return data, spark.createDataFrame(data, "symbol string, date date, label double, score double")


def test_auc_like_ml(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    _, df = metrics_frame(spark)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    found = rows(evaluation.auc(df))[0]["auc"]
    assert found == pytest.approx(evaluator.evaluate(df))
    assert rows(evaluation.auc(df.filter("label = 1"), by=["symbol"]))[0]["auc"] is None


def test_regression_and_batched_metrics(spark):
    data, df = metrics_frame(spark)
    y, p = [r[2] for r in data], [r[3] for r in data]
    r2 = lambda y, p: 1 - sum((a - b) ** 2 for a, b in zip(y, p)) / sum((a - sum(y) / len(y)) ** 2 for a in y)
    found = rows(evaluation.regression_metrics(df, prediction="score"))[0]
    assert found["r2"] == pytest.approx(r2(y, p))
    assert found["rmse"] == pytest.approx(math.sqrt(sum((a - b) ** 2 for a, b in zip(y, p)) / len(y)))
    found = rows(evaluation.batched_r2(df, prediction="score"))[0]
    batches = [r2(y[i : i + 32], p[i : i + 32]) for i in range(0, 100, 32)]
    assert found["batches"] == 4 and found["r2"] == pytest.approx(r2(y, p))
    assert found["mean_batch_r2"] == pytest.approx(sum(batches) / 4)


def test_accuracy(spark):
    df = spark.createDataFrame([(1.0, 1), (0.0, 1), (1.0, 1), (0.0, 0)], "prediction double, label int")
    assert rows(evaluation.classification_metrics(df)) == [{"rows": 4, "accuracy": 0.75}]


def test_knn_against_brute_force(spark):
    import random

    draw = random.Random(11)
    make = lambda n, start: [
        (s, dt.date(2024, 1, 1) + dt.timedelta(days=start + i), float(draw.randint(0, 9)), float(draw.randint(0, 9)), draw.randint(0, 2))
        for s in ("A", "B") for i in range(n)
    ]
    schema = "symbol string, date date, a double, b double, label int"
    train, test = make(40, 0), make(10, 100) + [("C", dt.date(2024, 9, 1), 1.0, 1.0, 0)]
    called = neighbours.knn_classify(
        spark.createDataFrame(train, schema), spark.createDataFrame(test, schema), ["a", "b"], k=5
    )
    found = {(r["symbol"], r["date"]): r["prediction"] for r in called.collect()}
    for s, d, a, b, _ in test:
        near = sorted(((x - a) ** 2 + (y - b) ** 2, e, v) for t, e, x, y, v in train if t == s)[:5]
        votes = [v for *_, v in near]
        expected = min(set(votes), key=lambda v: (-votes.count(v), v)) if votes else None
        assert found[(s, d)] == expected


@pytest.mark.parametrize("block_rows", [2, 1024])
def test_knn_by_blocks_gives_the_same(spark, block_rows):
    draw = random.Random(4)
    data = [("A", i, draw.random(), draw.random(), i % 2) for i in range(60)]
    frame = spark.createDataFrame(data, "symbol string, date int, x double, z double, label int")
    train, test = frame.where("date < 45"), frame.where("date >= 45")
    test = test.union(test.limit(1))
    called = neighbours.knn_classify(train, test, ["x", "z"], k=5, block_rows=block_rows).collect()
    assert len(called) == 16
    for r in called:
        near = sorted(((r["x"] - x) ** 2 + (r["z"] - z) ** 2, day, y) for _, day, x, z, y in data[:45])[:5]
        votes = [y for *_, y in near]
        assert r["prediction"] == (1 if votes.count(1) > votes.count(0) else 0)


@pytest.mark.parametrize("pivots, block_rows", [(1, 1024), (6, 3), (24, 50)])
def test_knn_by_pivots_is_exact(spark, pivots, block_rows):
    """Clustered points, ties, repeated points, points without a distance, a symbol of fewer than k rows."""
    draw = random.Random(9)
    centres = [(draw.uniform(-50, 50), draw.uniform(-50, 50)) for _ in range(9)]
    point = lambda: tuple(float(round(draw.gauss(c, 1.5))) for c in draw.choice(centres))
    train = [("A", i, *point(), draw.randint(0, 2)) for i in range(300)] + [("B", i, *point(), i % 2) for i in range(3)]
    test = [("A", 1000 + i, *point(), 0) for i in range(60)] + [("B", 2000, 0.0, 0.0, 0), ("C", 2001, 0.0, 0.0, 0), ("A", 3000, 1e6, 1e6, 0)]
    schema = "symbol string, date int, x double, z double, label int"
    frame = lambda rows_: spark.createDataFrame(rows_, schema)
    called = neighbours.knn_classify(frame(train), frame(test), ["x", "z"], k=7, block_rows=block_rows, pivots=pivots).collect()
    assert len(called) == len(test)
    for r in called:
        near = sorted(((r["x"] - x) ** 2 + (r["z"] - z) ** 2, day, y) for s, day, x, z, y in train if s == r["symbol"])[:7]
        votes = [y for *_, y in near]
        assert r["prediction"] == (min(set(votes), key=lambda v: (-votes.count(v), v)) if votes else None)


def test_pivots_leave_few_pairs_to_compare(spark):
    draw = random.Random(2)
    data = [("A", i, draw.gauss(10 * (i % 20), 1), draw.gauss(7 * (i % 13), 1)) for i in range(3000)]
    frame = spark.createDataFrame(data, "symbol string, date int, x double, z double")
    found = neighbours.compared_share(frame.where("date % 5 > 0"), frame.where("date % 5 = 0"), ["x", "z"], pivots=64).first()
    assert found["pairs"] == 2400 * 600 and found["compared"] < 0.2 * found["pairs"]


def test_scalers_by_symbol_shuffle_no_rows(spark):
    """With broadcast joins off, the only exchanges are of sums per symbol."""
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("symbol"), F.col("id").alias("v"))
    df = df.union(spark.createDataFrame([(None, 7)], "symbol string, v long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scaled = scaling.minmax(df, "v", by="symbol", out="share")
        plan = scaled._jdf.queryExecution().executedPlan().toString()
        found = {(r["symbol"], r["v"]): r["share"] for r in scaled.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" not in plan.split("Subquery")[0]
    assert found["0", 0] == -1 and found["0", 999] == 1 and found[None, 7] == 0
    flat = scaling.scale(df.where("symbol = '0'"), "v", center=True, out="z", ddof=0).agg(F.stddev_pop("z")).first()[0]
    assert flat == pytest.approx(1)
