import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickermood import session
from tickermood.schemas import RAW_NEWS
from tickermood.session import materialize, saved, scratch_path, shared_folder, spread_small
from tickermood.sources import dictionaries, news, tables


def article(text, **fields):
    return {"article": text, "published date": "Mon, 06 May 2024 07:00:00 GMT", "title": "t", "url": "u", **fields}


def test_read_news(spark, tmp_path):
    folder = tmp_path / "Meta and Facebook"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(article("text")))
    (folder / "b.json").write_text(json.dumps(article(float("nan"))))
    found = rows(news.read_news(spark, f"{tmp_path}/*"), "article")
    assert [(r["article"], r["symbol"]) for r in found] == [(None, "Meta and Facebook"), ("text", "Meta and Facebook")]
    assert [r["symbol"] for r in rows(news.read_news(spark, str(folder), symbol="FB"))] == ["FB", "FB"]


def test_shape_and_land_news(spark, tmp_path):
    data = [
        ("A", "one", None, "Mon, 01 Jan 2024 07:00:00 GMT", ("https://x", "X"), "t1", "u1"),
        ("A", "two", None, "Wed, 03 Jan 2024 07:00:00 GMT", ("https://x", "X"), "t2", "u2"),
        ("A", "three", None, "Thu, 04 Jan 2024 07:00:00 GMT", ("https://y", "Y"), "t3", "u3"),
        ("A", "four", None, "soon", ("https://y", "Y"), "t4", "u4"),
    ]
    raw = spark.createDataFrame([(d[1], d[2], d[3], d[4], d[5], d[6]) for d in data], RAW_NEWS).withColumn("symbol", F.lit("A"))
    found = rows(news.shape_news(raw, "2024-01-01"), "title")
    assert [r["file_name"] for r in found] == [
        "A_01-January-2024-03-January-2024_1.json", "A_01-January-2024-03-January-2024_2.json",
        "A_04-January-2024-06-January-2024_1.json", None,
    ]
    assert found[0]["publisher"] == "X" and found[0]["publisher_url"] == "https://x"
    path = str(tmp_path / "landing")
    news.land_news(news.flatten_news(raw), path, articles_per_file=1)
    assert len(list((tmp_path / "landing" / "symbol=A").glob("*.json"))) == 4
    assert spark.read.schema(news.NEWS).json(path).count() == 4


def test_feature_files(spark, tmp_path):
    """The positional, headerless layout; each target is the next row's change."""
    lines = [
        "2024-05-06,2.5,0.9,3.5,-5.5,-1.5", "2024-05-07,2.0,0.8,-1.5,16.0,-0.5", "2024-05-08,0.0,1.0,-0.5,-25.0,1.0",
    ]
    (tmp_path / "part.csv").write_text("\n".join(lines))
    found = rows(tables.read_features(spark, str(tmp_path), symbol="A"), "date")
    assert len(found) == 3 and found[0]["date"] == dt.date(2024, 5, 6)
    assert [r["next_day_price_percent_change_shifted"] for r in found[:-1]] == [r["price_percent_change"] for r in found[1:]]
    assert tables.read_features(spark, str(tmp_path), header=True).count() == 2
    for format in ("csv", "parquet"):
        out = str(tmp_path / format)
        tables.write_features(tables.read_features(spark, str(tmp_path / "part.csv"), symbol="A"), out, format)
        back = tables.read_features(spark, out, format=format)
        assert rows(back, "date") == found


def test_files_are_in_the_order_of_days(spark, tmp_path):
    data = [(s, dt.date(2024, 1, d), float(d), d) for d in (5, 1, 4, 2, 3) for s in ("A", "B")]
    path = str(tmp_path / "prices")
    tables.write_prices(spark.createDataFrame(data, "symbol string, date date, adjclose double, volume long"), path)
    for file in (tmp_path / "prices").glob("symbol=*/*.parquet"):
        days = [r["date"].day for r in spark.read.parquet(str(file)).collect()]
        assert days == sorted(days) and days


def test_price_files_prune_and_push_down(spark, tmp_path):
    data = [(s, dt.date(2024, 1, d), float(d), d) for s in ("A", "B") for d in range(1, 6)]
    path = str(tmp_path / "prices")
    tables.write_prices(spark.createDataFrame(data, "symbol string, date date, adjclose double, volume long"), path)
    bars = tables.read_prices(spark, path, symbols=["A"], start="2024-01-02", end="2024-01-04")
    assert [r["adjclose"] for r in rows(bars, "date")] == [2.0, 3.0, 4.0]
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "GreaterThanOrEqual(date" in plan


def test_dictionaries(spark, tmp_path):
    path = tmp_path / "d.txt"
    path.write_text("good,positive\nlack of,revert\n\nalone\n,x\n")
    assert [tuple(r) for r in dictionaries.read_lexicon(spark, str(path)).collect()] == [("good", "positive"), ("lack of", "revert")]
    path.write_text("abandon\t-2\n\nbad\tline\nalone\ncan't stand\t-3\n")
    assert [tuple(r) for r in dictionaries.read_valences(spark, str(path)).collect()] == [("abandon", -2), ("can't stand", -3)]
    path.write_text("go->went\tgoing\n\nalone\nbe->is\twas\tWAS\n")
    found = sorted(tuple(r) for r in dictionaries.read_lemmas(spark, str(path)).collect())
    assert found == [("going", "go"), ("is", "be"), ("was", "be"), ("went", "go")]


def test_histories_skip_other_files(spark, tmp_path):
    (tmp_path / "Apple_emotion_True.json").write_text(json.dumps({"loss": [3.0, 1.0], "val_loss": [2.0], "test_r_2_score": -0.5}))
    (tmp_path / "b.v2.json").write_text(json.dumps({"loss": [1.0], "accuracy": [0.5], "test_accuracy": 0.25}))
    (tmp_path / "metrics.csv").write_text("model,stock\nSVM,Apple\n")
    found = rows(tables.read_histories(spark, str(tmp_path)), "name")
    assert [(r["name"], r["metric"], r["value"]) for r in found] == [
        ("Apple_emotion_True", "test_r_2_score", -0.5), ("b", "test_accuracy", 0.25),
    ]
    assert found[0]["loss"] == [3.0, 1.0]


def test_metrics_sink(spark, tmp_path):
    path = str(tmp_path / "metrics")
    tables.write_metrics(spark.createDataFrame([("SVM", 0.5)], "model string, accuracy float"), path)
    assert rows(spark.read.option("header", True).csv(path)) == [{"model": "SVM", "accuracy": "0.5"}]


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(folder)
    df = materialize(spark.range(10))
    assert df.count() == 10 and "LogicalRDD" in df._jdf.queryExecution().logical().toString()


def test_only_a_small_input_is_dealt_out(spark, monkeypatch):
    one, two = spark.range(0, 1000, 1, 1), spark.range(0, 1000, 1, 2)
    cores = spark.sparkContext.defaultParallelism
    for small in (one, two):
        spread = spread_small(small, "id")
        assert spread.rdd.getNumPartitions() == cores
        assert max(spread.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 2 * small.count() / cores
    monkeypatch.setattr(session, "SPREAD_BYTES", 1)
    assert spread_small(two, "id") is two


class _Cluster:
    """A session on a cluster, as far as the shared folder asks."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder}
        self.sparkContext = self
        self.master = "yarn"

    def getCheckpointDir(self):
        return None


def test_a_cluster_needs_a_shared_folder():
    assert shared_folder(_Cluster("hdfs://h/x")) == "hdfs://h/x"
    for folder in (None, "file:///data", "/tmp/x"):
        with pytest.raises(RuntimeError):
            shared_folder(_Cluster(folder))


def test_saved_frames_are_read_back(spark):
    df = saved(spark.range(10).withColumn("x", F.col("id") * 2), "x")
    assert df.agg(F.sum("x")).first()[0] == 90 and "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_models_round_trip(spark, tmp_path):
    from tickermood.plans import training

    df = spark.createDataFrame(
        [("A", dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i % 5), 0.1 * i, float(i % 3 - 1), float(i % 7), float((i + 1) % 3 - 1)) for i in range(60)],
        "symbol string, date date, afinn_sentiment double, pnn_sentiment double, price_percent_change double, "
        "volume_percent_change double, next_day_price_percent_change_shifted double",
    )
    rows_ = training.labelled(df, "gt0")
    model = training.fit_logistic(rows_, True)
    tables.save_model(model, str(tmp_path / "m"))
    loaded = tables.load_model(str(tmp_path / "m"))
    assert rows(training.predict(model, rows_), "date") == rows(training.predict(loaded, rows_), "date")
