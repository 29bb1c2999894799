"""Landed articles as a stream, scored and averaged per day."""

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickermood.functions.dates import news_date
from tickermood.operators.features import join_features
from tickermood.plans.feature_table import score_articles
from tickermood.plans.inference import call_rows
from tickermood.schemas import NEWS
from tickermood.session import saved
from tickermood.sources.news import clean_news, folder_name


def stream_news(spark: SparkSession, landing, symbol=None, files_per_trigger=1000) -> DataFrame:
    """Article files as they land, at most ``files_per_trigger`` in a batch."""
    rows = spark.readStream.schema(NEWS).option("maxFilesPerTrigger", files_per_trigger).json(landing)
    owner = F.lit(symbol) if symbol is not None else folder_name()
    return clean_news(rows.withColumn("symbol", owner)).withColumn("date", news_date("`published date`"))


def stream_daily_sentiment(
    stream: DataFrame, valences: DataFrame, classes: DataFrame, lemmas=None, text_col="article", watermark="2 days",
    counts=False,
) -> DataFrame:
    """Daily mean of both scores per symbol, over tumbling one-day windows.

    State is one row per symbol and open day. Articles published longer than
    ``watermark`` before the newest one seen come too late and are dropped. With ``counts``
    each day says how many articles it holds (``articles``).
    """
    return daily_of_scored(score_articles(stream, valences, classes, lemmas, text_col), watermark, counts)


def write_scored(
    stream: DataFrame, valences: DataFrame, classes: DataFrame, path, checkpoint, lemmas=None, text_col="article",
    keep=("symbol", "date"), available_now=False,
):
    """Score a stream by dictionaries of any size: each batch is joined like a table and written below ``path``.

    ``stream_scored`` reads the scores as a stream again. A batch that runs again after a
    failure replaces its own folder, so let the reader follow when this query has ended
    its batches (both with ``available_now``, one after the other).
    """
    columns = [*keep, "afinn_sentiment", "pnn_sentiment"]

    def score(batch: DataFrame, batch_id: int) -> None:
        scored = score_articles(batch, valences, classes, lemmas, text_col).select(*columns)
        scored.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_scored(spark: SparkSession, path, files_per_trigger=1000) -> DataFrame:
    """The articles scored by ``write_scored``, as a stream of ``symbol, date, afinn_sentiment, pnn_sentiment``."""
    schema = "symbol string, date date, afinn_sentiment double, pnn_sentiment int"
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{path}/*")
    return rows.select("symbol", "date", "afinn_sentiment", "pnn_sentiment")


def daily_of_scored(scored: DataFrame, watermark="2 days", counts=False) -> DataFrame:
    """Daily means of scored articles, over tumbling one-day windows."""
    timed = scored.withColumn("published", F.col("date").cast("timestamp")).withWatermark("published", watermark)
    return (
        timed.groupBy(F.window("published", "1 day"), "symbol")
        .agg(
            F.avg("afinn_sentiment").alias("afinn_sentiment_mean"), F.avg("pnn_sentiment").alias("pnn_sentiment"),
            *([F.count(F.lit(1)).alias("articles")] if counts else []),
        )
        .select(
            "symbol", F.col("window.start").cast("date").alias("date"), "afinn_sentiment_mean", "pnn_sentiment",
            *(["articles"] if counts else []),
        )
    )


def write_arrivals(stream: DataFrame, path, checkpoint, available_now=False):
    """Count the articles of each symbol and day as they land, whatever any watermark says of them."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("landed"))
        counted.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    # A batch holds what the stream selects: without this, every text.
    writer = stream.select("symbol", "date").writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def late_articles(spark: SparkSession, arrivals, updates) -> DataFrame:
    """``(symbol, date, kept, dropped)``: articles of each day that came in time, and those the watermark dropped.

    ``arrivals`` is a folder of ``write_arrivals``, ``updates`` one of ``write_updates`` over daily
    scores with counts. An article without a day is in neither.
    """
    landed = spark.read.parquet(arrivals).where("date is not null").groupBy("symbol", "date").agg(F.sum("landed").alias("landed"))
    rows = spark.read.parquet(updates).groupBy(F.col("symbol").alias("s"), F.col("date").alias("d")).agg(
        F.max_by("articles", "batch_id").alias("articles")
    )
    met = landed.join(rows, F.col("symbol").eqNullSafe(F.col("s")) & (F.col("date") == F.col("d")), "left")
    kept = F.coalesce("articles", F.lit(0))
    return met.select("symbol", "date", kept.alias("kept"), (F.col("landed") - kept).alias("dropped"))


def write_updates(daily: DataFrame, path, checkpoint, available_now=False):
    """Keep each batch's changed days below ``path``, one folder per batch.

    A batch that runs again after a failure replaces its own folder.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = daily.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_updates(spark: SparkSession, path) -> DataFrame:
    """The newest state of every day written by ``write_updates``."""
    rows = spark.read.parquet(path)
    newest = F.max_by(F.struct("afinn_sentiment_mean", "pnn_sentiment"), "batch_id").alias("newest")
    return rows.groupBy("symbol", "date").agg(newest).select("symbol", "date", "newest.*")


def compact_updates(spark: SparkSession, path, upto: int) -> None:
    """Put the newest state of the batches up to ``upto`` into that batch's folder.

    Run it between queries: the folders before ``upto`` may then be dropped by the
    retention rule of the storage, and ``read_updates`` gives the same rows.
    """
    rows = spark.read.parquet(path).where(F.col("batch_id") <= upto)
    state = F.max_by(F.struct("afinn_sentiment_mean", "pnn_sentiment"), "batch_id").alias("newest")
    newest = saved(rows.groupBy("symbol", "date").agg(state).select("symbol", "date", "newest.*"), "compacted")
    newest.write.mode("overwrite").parquet(f"{path}/batch_id={upto}")


def stream_trend(
    daily: DataFrame, prices: DataFrame, model: PipelineModel | Column, emotion: bool, path, checkpoint,
    deviation: DataFrame, available_now=False,
):
    """Keep the call of a saved model (or of a prediction expression) for each symbol that a batch touches.

    Lag and lead do not run on streams, so ``prices`` are finished price features; hand
    over a written table, since every batch reads it. ``deviation`` holds each symbol's
    (symbol, deviation) by which the valence mean was scaled in training. A symbol
    without one is new since then: its call is null instead of missing. Each batch
    writes the state of its days; ``read_trends`` calls on the latest day of a symbol
    over all batches, so an update of an earlier day brings no stale call.
    """
    columns = ["symbol", "date", "next_session", "day", "month", "sentiment", "trend"]

    def score(batch: DataFrame, batch_id: int) -> None:
        known = batch.join(deviation.withColumn("known", F.lit(True)), "symbol", "left").withColumn(
            "afinn_sentiment", F.coalesce(F.try_divide("afinn_sentiment_mean", "deviation"), F.lit(0.0))
        )
        scores = known.select("symbol", "date", "afinn_sentiment", "pnn_sentiment", "known")
        joined = join_features(scores, prices, inference=True)
        called = call_rows(joined, model, emotion).join(scores.select("symbol", "date", "known"), ["symbol", "date"])
        called = called.withColumn("trend", F.when(F.col("known"), F.col("trend")))
        called.select(*columns).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = daily.writeStream.outputMode("update").foreachBatch(score).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_trends(spark: SparkSession, path) -> DataFrame:
    """One call per symbol: that of its latest day, in the newest state of that day."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c not in ("symbol", "batch_id")]
    newest = F.max_by(F.struct(*columns), F.struct("date", "batch_id")).alias("newest")
    return rows.groupBy("symbol").agg(newest).select("symbol", "newest.*")
