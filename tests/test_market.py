import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickermood.functions.columns import direction, polarity, trend_label
from tickermood.functions.dates import assign_window, fetch_windows, month_name, news_date, next_session_date
from tickermood.operators import features, market
from tickermood.operators.ordinal import article_ordinal, ranged
from tickermood.schemas import TARGET, TICKERS
from tickermood.sources.dictionaries import default_tickers
from tickermood.sources.local import small_frame


def day(n):
    return dt.date(2024, 1, n)


def bars(spark, *data):
    return spark.createDataFrame(
        [(s, day(d), p, v) for s, d, p, v in data], "symbol string, date date, adjclose double, volume long"
    )


def test_changes_targets_and_edges(spark):
    df = bars(
        spark, ("A", 1, 10.0, 100), ("A", 2, 11.0, 0), ("A", 3, None, 50), ("A", 4, 22.0, 100), ("A", 5, 11.0, 50), ("B", 1, 5.0, 1)
    )
    found = rows(market.price_features(df), "symbol", "date")
    assert [r["price_percent_change"] for r in found] == [None, pytest.approx(10.0), None, None, -50.0, None]
    # A zero before gives no change.
    assert [r["volume_percent_change"] for r in found] == [None, -100.0, None, 100.0, -50.0, None]
    assert [r[TARGET] for r in found] == [pytest.approx(10.0), None, None, -50.0, None, None]
    filled = rows(market.price_features(df, inference=True), "symbol", "date")
    assert [r[TARGET] for r in filled] == [pytest.approx(10.0), 0.0, 0.0, -50.0, 0.0, 0.0]


def test_target_is_the_next_rows_change(spark):
    df = bars(spark, *[("A", d, float(d * d + 3), d) for d in range(1, 20)])
    found = rows(market.price_features(df), "date")
    assert [r[TARGET] for r in found[:-1]] == [r["price_percent_change"] for r in found[1:]]


def test_fractional_change(spark):
    df = market.pct_change(bars(spark, ("A", 1, 10.0, 1), ("A", 2, 15.0, 1)), "adjclose", scale=1, out="r")
    assert [r["r"] for r in rows(df, "date")] == [None, 0.5]


def test_windows_share_one_shuffle(spark):
    plan = market.price_features(bars(spark, ("A", 1, 1.0, 1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1


def test_two_rows_of_a_day_fail(spark):
    twice = bars(spark, ("A", 1, 1.0, 1), ("A", 2, 2.0, 1), ("A", 2, 3.0, 1))
    with pytest.raises(Exception, match="more than one row of a day for A"):
        market.price_features(twice).collect()


def test_daily_bars_take_the_last_tick(spark):
    ticks = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 1, 9), 1, 5.0), ("A", dt.datetime(2024, 1, 1, 10), 2, 6.0),
         ("A", dt.datetime(2024, 1, 1, 10), 3, 7.0), ("A", dt.datetime(2024, 1, 2, 1), 4, 8.0)],
        "symbol string, ts timestamp, id long, value double",
    )
    found = rows(market.daily_bars(ticks, "value", "ts", "id"), "date")
    assert [(r["adjclose"], r["volume"]) for r in found] == [(7.0, 3), (8.0, 1)]


def test_span_cut_before_or_after(spark):
    df = bars(spark, *[("A", d, float(d), 1) for d in range(1, 6)])
    scores = spark.createDataFrame([("A", day(2)), ("A", day(4))], "symbol string, date date")
    after = rows(market.restrict_to_span(df, scores), "date")
    before = rows(market.restrict_to_span(df, scores, cut="before"), "date")
    assert [r["date"].day for r in after] == [r["date"].day for r in before] == [2, 3, 4]
    assert after[0]["price_percent_change"] == 100.0 and before[0]["price_percent_change"] is None
    assert after[-1][TARGET] is not None and before[-1][TARGET] is None


def test_join_drops_incomplete_rows_either_way(spark):
    scores = spark.createDataFrame([("A", day(2), 1.0, 0.5), ("A", day(4), 2.0, 0.0)], "symbol string, date date, afinn_sentiment double, pnn_sentiment double")
    prices = market.price_features(bars(spark, *[("A", d, float(d), d) for d in range(1, 5)]))
    inner = rows(features.join_features(scores, prices), "date")
    assert inner == rows(features.join_features(scores, prices, how="right"), "date")
    assert [r["date"].day for r in inner] == [2]
    inference = rows(features.join_features(scores, prices, inference=True), "date")
    assert [r["date"].day for r in inference] == [2, 4] and inference[1][TARGET] == 0.0


def test_resolve_symbol(spark):
    df = spark.createDataFrame([("Apple",), ("Nokia",)], "company string")
    assert rows(features.unknown_companies(df, default_tickers(spark))) == [{"company": "Nokia"}]
    known = features.resolve_symbol(df.filter("company = 'Apple'"), default_tickers(spark))
    assert [r["symbol"] for r in rows(known)] == ["AAPL"]
    kept = features.resolve_symbol(df, default_tickers(spark), on_unknown="null")
    assert [r["symbol"] for r in rows(kept, "company")] == ["AAPL", None]
    with pytest.raises(Exception, match="no ticker for company Nokia"):
        features.resolve_symbol(df, default_tickers(spark)).collect()


def test_publication_dates(spark):
    texts = ["Mon, 06 May 2024 07:00:00 GMT", "Mon, 6 May 2024 07:00:00 GMT", "", "yesterday", None, "Mon, 99 May 2024 07:00:00 GMT"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("d", news_date("t"))
    assert [r["d"] for r in rows(df, "i")] == [dt.date(2024, 5, 6), dt.date(2024, 5, 6), None, None, None, None]


def test_next_session(spark):
    days = [dt.date(2024, 5, 30), dt.date(2024, 5, 31), dt.date(2024, 6, 1), dt.date(2024, 6, 2)]
    df = spark.createDataFrame([(d,) for d in days], "date date").select(
        "date", next_session_date("date").alias("s"), next_session_date("date", weekends=True).alias("w"),
        month_name(next_session_date("date")).alias("m"),
    )
    found = rows(df, "date")
    assert [r["s"] for r in found] == [dt.date(2024, 5, 31)] + [dt.date(2024, 6, 3)] * 3
    assert [r["w"] for r in found] == [d + dt.timedelta(days=1) for d in days]
    assert [r["m"] for r in found] == ["May", "June", "June", "June"]


def test_fetch_windows(spark):
    df = spark.createDataFrame([("A", day(1), day(8)), ("B", day(5), day(4))], "symbol string, start date, final date")
    found = rows(fetch_windows(df), "bucket")
    assert [(r["bucket"], r["window_start"].day, r["window_end"].day) for r in found] == [(0, 1, 3), (1, 4, 6), (2, 7, 9)]
    assigned = spark.createDataFrame([(day(d),) for d in (1, 3, 4, 9)], "date date")
    found = rows(assign_window(assigned, "date", F.lit("2024-01-01").cast("date")), "date")
    assert [r["bucket"] for r in found] == [0, 0, 1, 2]


def test_ordinals_of_a_hot_group(spark):
    """A third of the rows in one group; its ranges number them as one window would."""
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("symbol"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("date"),
        ((F.col("id") * 7919) % 1000003).alias("doc_id"),
    )
    found = article_ordinal(df, by=["symbol"], order=["date"], key="doc_id").collect()
    groups = {}
    for r in found:
        groups.setdefault(r["symbol"], []).append((r["date"], r["doc_id"], r["ordinal"]))
    assert len(found) == 900 and len(groups["hot"]) == 300
    for members in groups.values():
        assert [o for *_, o in sorted(members)] == list(range(1, len(members) + 1))


def test_ordinals_with_nulls_and_one_row(spark):
    df = spark.createDataFrame([("A", None, 5), ("A", None, 3), ("A", day(1), 4)], "symbol string, date date, doc_id long")
    found = rows(article_ordinal(df, ["symbol"], ["date"], "doc_id"), "ordinal")
    assert [(r["doc_id"], r["ordinal"]) for r in found] == [(3, 1), (5, 2), (4, 3)]
    one = df.limit(1)
    assert [r["ordinal"] for r in rows(article_ordinal(one, ["symbol"], ["date"], "doc_id"))] == [1]


def test_labels(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 0.0), (2, -1.0), (3, None)], "i int, x double").select(
        "i", direction("x").alias("gt0"), direction("x", "ge0").alias("ge0")
    )
    found = rows(df, "i")
    assert [r["gt0"] for r in found] == [1, 0, 0, 0]
    assert [r["ge0"] for r in found] == [1, 1, 0, 1]
    with pytest.raises(ValueError):
        direction("x", "up")


def test_trend_and_polarity(spark):
    df = spark.createDataFrame([(1.0, 3, 1), (0.0, 0, 0)], "p double, a int, b int")
    found = rows(df.select(trend_label("p").alias("t"), polarity("a", "b").alias("s")), "t")
    assert [(r["t"], r["s"]) for r in found] == [("bearish", 0.0), ("bullish", 0.5)]


def test_small_frames_have_a_known_size(spark):
    df = small_frame(spark, [("a", "b")], TICKERS)
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert small_frame(spark, [], TICKERS).count() == 0


def test_ranges_are_even_whatever_the_keys(spark):
    """One far outlier and a crowd of keys: no range holds much more than its share."""
    keys = spark.range(20_000).select(F.when(F.col("id") == 0, 10**12).otherwise(F.col("id")).alias("key"))
    crowd = spark.range(20_000).select((F.lit(10**9) + F.col("id")).alias("key"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ranged(keys.union(crowd), "key").groupBy("_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(sizes) <= 2 * 10_000


def test_no_text_is_shuffled(spark):
    """Neither the feature table nor the shaping of news sends a text through an exchange."""
    from tickermood.plans.feature_table import feature_table
    from tickermood.sources import sample
    from tickermood.sources.news import shape_news
    from tickermood.plans.catalog import _raw_news

    sf = "/root/testdata/sf0.001"
    texts = spark.range(0, 1, 1, 2).select(F.lit("a").alias("symbol"), F.current_date().alias("date"), F.lit("good").alias("article"))
    table = feature_table(texts, sample.prices(spark, sf), sample.valences(spark), sample.classes(spark))
    shaped = shape_news(_raw_news(spark, sf), "2024-01-01", key="doc_id")
    for df in (table, shaped):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        below = [line for line in plan.split("\n") if "RepartitionByExpression" in line]
        assert not below and "article" not in [c for c in shaped.columns]
        physical = df._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in physical.split("\n") if "Exchange" in line and ("article" in line or "text" in line)]
