import datetime as dt
import json
import time
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickermood import session
from tickermood.functions import lookup
from tickermood.operators.sentiment import daily_sentiment
from tickermood.plans import catalog
from tickermood.plans.catalog import QUERIES
from tickermood.plans.feature_table import score_articles
from tickermood.schemas import VALENCE_LEXICON
from tickermood.sources.dictionaries import default_lexicon
from tickermood.sources.local import small_frame
from tickermood.streaming import news


def land(folder, name, day, text):
    folder.mkdir(parents=True, exist_ok=True)
    body = {"article": text, "published date": f"Mon, {day:02d} Jan 2024 07:00:00 GMT", "title": name, "url": name}
    (folder / f"{name}.json").write_text(json.dumps(body))


def run(spark, tmp_path, **options):
    valences = small_frame(spark, [("good", 3), ("bad", -3)], VALENCE_LEXICON)
    stream = news.stream_news(spark, f"{tmp_path}/landing/*", files_per_trigger=1)
    daily = news.stream_daily_sentiment(stream, valences, default_lexicon(spark), **options)
    out = str(tmp_path / "out")
    news.write_updates(daily, out, str(tmp_path / "offsets"), available_now=True).awaitTermination()
    return valences, rows(news.read_updates(spark, out), "symbol", "date")


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    landing = tmp_path / "landing"
    for i, (symbol, day, text) in enumerate(
        [("A", 1, "good good"), ("A", 1, "bad"), ("B", 2, "not good"), ("A", 2, "plain")]
    ):
        land(landing / symbol, f"n{i}", day, text)
    valences, found = run(spark, tmp_path)
    from tickermood.functions.dates import news_date
    from tickermood.sources.news import read_news

    def expected():
        articles = read_news(spark, f"{landing}/*").withColumn("date", news_date("`published date`"))
        return rows(daily_sentiment(score_articles(articles, valences, default_lexicon(spark))), "symbol", "date")

    assert found == expected()
    land(landing / "A", "later", 2, "good")
    _, found = run(spark, tmp_path)
    assert found == expected()


def test_late_articles_are_dropped(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing / "A", "n1", 20, "good")
    run(spark, tmp_path)
    land(landing / "A", "n2", 1, "bad")
    _, found = run(spark, tmp_path)
    assert [r["date"].day for r in found] == [20]


def test_compaction_keeps_the_state(spark, tmp_path):
    landing = tmp_path / "landing"
    for i, (symbol, day, text) in enumerate([("A", 1, "good"), ("A", 1, "bad"), ("B", 2, "good"), ("A", 2, "good")]):
        land(landing / symbol, f"n{i}", day, text)
    _, found = run(spark, tmp_path)
    out = str(tmp_path / "out")
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "out").glob("batch_id=*"))
    assert last >= 3
    news.compact_updates(spark, out, last)
    assert rows(news.read_updates(spark, out), "symbol", "date") == found
    only = spark.read.option("basePath", out).parquet(f"{out}/batch_id={last}")
    assert sorted((r["symbol"], r["date"]) for r in only.collect()) == sorted((r["symbol"], r["date"]) for r in found)


class _Up:
    """A model that always expects the market to rise."""

    def transform(self, df):
        return df.withColumn("prediction", F.lit(1.0))


def test_calls_of_new_symbols_and_of_days_that_change_late(spark, tmp_path):
    landing = tmp_path / "landing"
    days = [("A", 5, "good"), ("A", 6, "bad"), ("NEW", 6, "good"), ("A", 5, "bad bad")]
    for i, (symbol, day, text) in enumerate(days):
        land(landing / symbol, f"n{i}", day, text)
        time.sleep(0.05)
    changes = spark.createDataFrame(
        [(s, dt.date(2024, 1, d), 1.0, 1.0, 1.0) for s in ("A", "NEW") for d in (5, 6)],
        "symbol string, date date, price_percent_change double, volume_percent_change double, "
        "next_day_price_percent_change_shifted double",
    )
    deviation = spark.createDataFrame([("A", 2.0)], "symbol string, deviation double")
    valences = small_frame(spark, [("good", 3), ("bad", -3)], VALENCE_LEXICON)
    stream = news.stream_news(spark, f"{landing}/*", files_per_trigger=1)
    daily = news.stream_daily_sentiment(stream, valences, default_lexicon(spark), watermark="30 days")
    out = str(tmp_path / "trends")
    job = news.stream_trend(daily, changes, _Up(), True, out, str(tmp_path / "o"), deviation, available_now=True)
    job.awaitTermination()
    assert len(list((tmp_path / "trends").glob("batch_id=*"))) >= 4
    found = rows(news.read_trends(spark, out), "symbol")
    # The last batch touched an earlier day of A, whose call is still that of the 6th.
    assert [(r["symbol"], r["date"].day, r["trend"]) for r in found] == [("A", 6, "bullish"), ("NEW", 6, None)]


def test_stream_queries(spark):
    assert QUERIES["stream_trend"](spark, "/root/testdata/sf0.01").count() == 5


def test_a_large_dictionary_scores_a_stream_batch_by_batch(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    texts = [("A", 1, "good good"), ("A", 1, "bad"), ("B", 2, "not good"), ("A", 2, "plain"), ("A", 2, "good good")]
    for i, (symbol, day, text) in enumerate(texts):
        land(landing / symbol, f"n{i}", day, text)
    valences, expected = run(spark, tmp_path)
    monkeypatch.setattr(lookup, "INLINE_TERMS", 0)
    stream = news.stream_news(spark, f"{landing}/*", files_per_trigger=2)
    with pytest.raises(ValueError, match="write_scored"):
        news.stream_daily_sentiment(stream, valences, default_lexicon(spark))
    scored, out = str(tmp_path / "scored"), str(tmp_path / "daily")
    news.write_scored(
        stream, valences, default_lexicon(spark), scored, str(tmp_path / "scored-offsets"), available_now=True
    ).awaitTermination()
    daily = news.daily_of_scored(news.stream_scored(spark, scored))
    news.write_updates(daily, out, str(tmp_path / "daily-offsets"), available_now=True).awaitTermination()
    assert rows(news.read_updates(spark, out), "symbol", "date") == expected


def test_landing_tasks_grow_in_number(spark, tmp_path, monkeypatch):
    """One task lands no more than a bounded share of the articles, and there are still six triggers or more."""
    days = spark.range(4000).selectExpr(
        "id doc_id", "concat('S', id % 2) symbol", "date_add(date'2024-01-01', cast(id % 9 as int)) date", "'x' article"
    )
    days.write.parquet(str(tmp_path / "news"))
    articles = spark.read.parquet(str(tmp_path / "news"))
    for least, bound in ((6, session.SPREAD_BYTES), (20, session.plan_bytes(articles) // 20)):
        monkeypatch.setattr(session, "SPREAD_BYTES", bound)
        stream = catalog._landed_stream(spark, None, articles)
        landed = str(max(Path(session.shared_folder(spark)).glob("landing-*"), key=lambda p: p.stat().st_mtime))
        writers = spark.read.text(f"{landed}/*").select(F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)).distinct()
        assert stream.isStreaming and least <= writers.count() <= least + 2
        assert spark.read.json(f"{landed}/*").count() == 4000


def test_late_articles_read_each_text_once(spark, tmp_path):
    """Counting arrivals computes no text, and each landing has a folder of its own to read."""
    land(tmp_path / "landing" / "A", "n1", 1, "good")
    stream = news.stream_news(spark, f"{tmp_path}/landing/*").withColumn("article", F.raise_error(F.lit("a text was read")))
    out = str(tmp_path / "arrivals")
    news.write_arrivals(stream, out, str(tmp_path / "offsets"), available_now=True).awaitTermination()
    assert [r["landed"] for r in rows(spark.read.parquet(out))] == [1]
    assert QUERIES["stream_late_articles"](spark, "/root/testdata/sf0.001").count() == 150
    staged = max(Path(session.shared_folder(spark)).glob("late-news-*"), key=lambda p: p.stat().st_mtime)
    assert sorted(p.name for p in staged.glob("landing=*")) == [f"landing={k}" for k in range(6)]
