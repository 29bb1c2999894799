"""The call for the next session."""

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from tickermood.functions.columns import trend_label
from tickermood.functions.dates import month_name, next_session_date
from tickermood.operators.splits import latest_row


def latest_prediction(predictions: DataFrame) -> DataFrame:
    return latest_row(predictions.select("symbol", "date", "prediction"))


def call_rows(features: DataFrame, model: PipelineModel | Column, emotion: bool, weekends=False) -> DataFrame:
    """Bullish or bearish for the session after each row's day.

    ``model`` is a fitted pipeline, or an expression that gives the prediction (``plans.scoring``).
    ``emotion`` tells whether it reads sentiment.
    """
    scored = features.withColumn("prediction", model) if isinstance(model, Column) else model.transform(features)
    session = next_session_date("date", weekends)
    return scored.select(
        "symbol",
        "date",
        session.alias("next_session"),
        F.dayofmonth(session).alias("day"),
        month_name(session).alias("month"),
        F.lit("with" if emotion else "without").alias("sentiment"),
        trend_label("prediction").alias("trend"),
    )


def predict_trend(features: DataFrame, model: PipelineModel | Column, emotion: bool, weekends=False) -> DataFrame:
    """The call after each symbol's latest day; only that row is scored."""
    return call_rows(latest_row(features), model, emotion, weekends)


def trend_text(trends: DataFrame) -> DataFrame:
    """One sentence per call."""
    text = F.format_string(
        "%s, session of %s %d: %s (model %s news sentiment)",
        F.col("symbol"), F.col("month"), F.col("day"), F.col("trend"), F.col("sentiment"),
    )
    return trends.select("symbol", "sentiment", text.alias("text"))
